"""What each filter of an ordered chain removes, over all orders, by coalitions and their potentials.

Every document is reduced to the set of filters it fails. A coalition is a set of filters; its worth in the *removal game*
is the number of documents that fail at least one of its members. The potential of a coalition (Hart and Mas-Colell) is

    P(S) = (worth(S) + sum of P(S without i) over its members i) / |S|,      P(empty) = 0,

and the Shapley value of a filter is P(all) - P(all without it). What a filter removes after others have run is the
difference of two coalitions, so every step of every order is read off the same table of coalitions: nothing is computed
for an order but such differences.

Potentials are kept as whole numbers, times n! for n filters. ``P(S)`` is a sum of whole numbers over 1 to n, so n! times
it is whole, and so is every division of the recursion. The Shapley value times n! is the sum over all orders of what the
filter removes.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm import textstats
from tillscope.llm.stored import stored

MOST_FILTERS = 6


def failure_conditions(text: Column) -> Mapping[str, Column]:
    """The conditions A to D of a text that is not null, in order."""

    def of_words(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        return F.struct((n < 50).alias("short"), (100 * distinct < 65 * n).alias("repetitive"))

    words = textstats.let(textstats.word_list(text), of_words)
    capitals = textstats.count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    symbols = textstats.count_of(text, "#$%&*|")
    return {
        "A": words["short"],
        "B": words["repetitive"],
        "C": 100 * capitals.cast("long") > 5 * F.length(text),
        "D": symbols > 0,
    }


def _rows(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Equal rows counted, with the mask of what they fail: ``doc_id, part, digest, mask, n, good, toxic``."""
    bits = [F.when(F.coalesce(c, F.lit(False)), 1 << k).otherwise(0) for k, c in enumerate(conditions.values())]
    light = docs.select("doc_id", "part", F.sha2("text", 256).alias("digest"), sum(bits, F.lit(0)).alias("mask"))
    counted = light.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("good"), F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic"), F.lit(False))).alias("toxic")
    )
    return counted.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])


def _marked_repeats(rows: DataFrame, bit: int) -> DataFrame:
    """``bit`` set in the mask of rows whose text is that of a smaller id. Nothing is smaller than a null id, nor greater."""
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    found = rows.join(firsts, ["digest", "doc_id"], "left")
    repeats = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return found.withColumn("mask", F.when(repeats, F.col("mask") + bit).otherwise(F.col("mask")))


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    conditions: Mapping[str, Column],
    repeats: bool = False,
) -> DataFrame:
    """Documents of each part by the set of filters they fail: ``part, mask, n, good, toxic``.

    ``docs`` has ``doc_id, part, text``, none of the last two null; ``labels`` has ``doc_id, good, toxic`` (booleans; of
    several rows for an id any true one counts). ``conditions`` give a filter's failure by its name, in the order of the
    bits of ``mask``; ``repeats`` adds a last one for texts equal to one of a smaller id anywhere in the table.
    """
    rows = stored(_rows(docs, labels, conditions))
    if repeats:
        rows = _marked_repeats(rows, 1 << len(conditions))
    kinds = rows.select("part", "mask", "n", *[F.when(F.col(c), F.col("n")).otherwise(0).alias(c) for c in ("good", "toxic")])
    return kinds.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def coalitions(counts: DataFrame, filters: int) -> DataFrame:
    """A row for each part: ``documents`` and arrays ``lost, good, toxic`` of what each coalition, by its mask, removes."""
    every = F.array([F.lit(s) for s in range(1 << filters)])
    met = F.filter(every, lambda s: (s == 0) | (s.bitwiseAND(F.col("mask")) != 0))
    removes = [F.when((F.col("coalition") != 0), F.col(c)).otherwise(0).alias(c) for c in ("n", "good", "toxic")]
    rows = counts.select("part", "n", "good", "toxic", F.explode(met).alias("coalition"))
    total = F.when(F.col("coalition") == 0, F.col("n")).otherwise(0).alias("all")
    sums = rows.select("part", "coalition", total, *removes).groupBy("part", "coalition").agg(
        *[F.sum(c).alias(c) for c in ("all", "n", "good", "toxic")]
    )
    entry = F.struct("coalition", "n", "good", "toxic")
    gathered = sums.groupBy("part").agg(
        F.sum("all").alias("documents"), F.map_from_entries(F.collect_list(F.struct("coalition", entry))).alias("by_mask")
    )

    def array_of(name: str) -> Column:
        return F.transform(every, lambda s: F.coalesce(F.col("by_mask")[s][name], F.lit(0)))

    return gathered.select("part", "documents", array_of("n").alias("lost"), array_of("good").alias("good"), array_of("toxic").alias("toxic"))


def potentials(worth: Column, filters: int) -> Column:
    """Array of the potentials of all coalitions, by mask, times n!, from the array of their worths.

    A coalition without one member has a smaller mask, so one walk in the order of masks finds what it needs.
    """
    scale = factorial(filters)
    masks = F.array([F.lit(s) for s in range(1, 1 << filters)])

    def extended(done: Column, s: Column) -> Column:
        below = [F.when(s.bitwiseAND(1 << i) != 0, F.get(done, s - (1 << i))).otherwise(0) for i in range(filters)]
        whole = sum(below, scale * F.get(worth, s))
        return F.concat(done, F.array(F.call_function("div", whole, F.bit_count(s))))

    return F.aggregate(masks, F.array(F.lit(0).cast("long")), extended)


def _orders(names: list[str]) -> Column:
    """All steps of all orders: ``filter_order, step, filter`` (its index) and ``before`` (mask of the filters that ran)."""
    steps = []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            name = "".join(names[j] for j in order)
            steps.append(f"('{name}' AS filter_order, {step} AS step, {i} AS filter, {before} AS before)")
            before |= 1 << i
    return F.expr(f"array({', '.join(f'struct{s}' for s in steps)})")


def audit(counts: DataFrame, names: list[str]) -> DataFrame:
    """A row for each part, order of the filters and step, from ``failure_counts``.

    ``kept`` documents after the step and ``removed`` by it; ``redundant``: failing its filter, removed before;
    ``unique_fails``: failing that filter alone; ``good_lost`` and ``toxic_lost`` of the removed; ``shapley``: what the
    filter removes, summed over all orders. Names are single letters or digits; up to six filters, since all n! orders are
    listed. An empty table gives an empty result.
    """
    if not 1 <= len(names) <= MOST_FILTERS or not all(len(n) == 1 and n.isalnum() for n in names):
        raise ValueError(f"1 to {MOST_FILTERS} filters named by a letter or digit, got {names}")
    n, every = len(names), (1 << len(names)) - 1
    tables = coalitions(counts, n).withColumn("potential", potentials(F.col("lost"), n))
    rows = tables.select("*", F.explode(_orders(names)).alias("at")).select(
        "*", "at.*", F.expr("shiftleft(1, at.filter)").alias("bit")
    ).withColumn("after", F.col("before").bitwiseOR(F.col("bit")))

    def gain(table: str, larger: Column, smaller: Column) -> Column:
        return F.get(table, larger) - F.get(table, smaller)

    bit, before, after, rest = F.col("bit"), F.col("before"), F.col("after"), F.lit(every) - F.col("bit")
    removed = gain("lost", after, before)
    return rows.select(
        "part", "filter_order", "step",
        (F.col("documents") - F.get("lost", after)).alias("kept"),
        removed.alias("removed"),
        (F.get("lost", bit) - removed).alias("redundant"),
        gain("lost", F.lit(every), rest).alias("unique_fails"),
        gain("good", after, before).alias("good_lost"),
        gain("toxic", after, before).alias("toxic_lost"),
        gain("potential", F.lit(every), rest).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E by source.

    ``docs`` needs ``doc_id, source, text``; ``labels`` ``doc_id, quality, toxic``. A null text is an empty one, a null
    source the part ``''``. Each row is a document of its own, also where ids repeat; rows equal in id and text do not
    make each other fail E, and a null id neither fails E nor has a label. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    chosen = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    marks = labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    conditions = failure_conditions(F.col("text"))
    return audit(failure_counts(chosen, marks, conditions, repeats=True), [*conditions, "E"])
