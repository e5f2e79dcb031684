"""Line deduplication: exact, and within an edit distance by a segment-partition join.

Lines meet in buckets of lengths. A bucket gives all its lines the same ``threshold + 1`` segments of one size, the last
at the end of the line and the others side by side from its beginning. Of two lines within ``threshold`` edits one keeps a
segment i whole with just i edits before it, so the other has it within i places; the last one stands at the end of both.
A line near the lower end of its bucket is in the bucket below as well. Pairs that meet are compared by counts of
fifteen characters, of the line and of its beginning, and by their lengths inside the join, then verified by a banded bit-parallel automaton: one word for each number
of edits, whose bits are the places of the diagonal band.

All of it is DataFrame expressions. Hashes move; of the texts only those of candidates do, and of few others. A line
that occurs very often takes part with its first occurrence alone, so no key gets hot through copies.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm import textstats
from tillscope.llm.stored import stored

THRESHOLD = 2
NEAR_LENGTH = 20
COUNTED = " etaonihrsdlguw"
OFTEN = 32
FILTER_BITS = 20


@dataclass(frozen=True)
class LineDecisions:
    """documents: ``doc_id, text_hash, n_lines, exact, near`` (places of lines that go, from 0), ``n_links`` for each input row.

    ``n_links`` counts, for each line of the row, the different lines of the table within the threshold of it.
    links: ``later, earlier`` hashes (``h1, h2``) of lines within the threshold.
    """

    documents: DataFrame
    links: DataFrame


def within_edits(a: Column, b: Column, threshold: int) -> Column:
    """Whether the edit distance of two texts is at most ``threshold``.

    Word d holds the cells reached with at most d edits: bit r of column j is the place ``j + r - threshold`` of ``a``.
    """
    middle, full = threshold, (1 << (2 * threshold + 1)) - 1
    names = [f"r{d}" for d in range(threshold + 1)]

    def start() -> Column:
        words = [sum(1 << (middle + e) for e in range(d + 1)) for d in range(threshold + 1)]
        return F.struct(*[F.lit(w).alias(n) for w, n in zip(words, names)])

    def step(chars: Column):
        def next_column(state: Column, cell: Column) -> Column:
            same = [
                F.when(F.get(chars, cell["j"] + (r - middle)).eqNullSafe(cell["c"]), 1 << r).otherwise(0)
                for r in range(2 * threshold + 1)
            ]
            return textstats.let(
                reduce(lambda x, y: x.bitwiseOR(y), same), lambda match: advance(state, match)
            )

        return next_column

    def advance(state: Column, match: Column) -> Column:
        def after(d: int, before: Column | None) -> list[Column]:
            word = state[names[d]].bitwiseAND(match)
            if before is not None:
                less = state[names[d - 1]]
                word = word.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(before, 1)).bitwiseAND(full)
            return [word] + (after(d + 1, word) if d < threshold else [])

        return F.struct(*[w.alias(n) for w, n in zip(after(0, None), names)])

    def run(chars: Column) -> Column:
        cells = F.transform(F.slice(F.split(b, ""), 1, F.length(b)), lambda c, j: F.struct(c.alias("c"), j.alias("j")))
        return F.aggregate(cells, start(), step(chars))[names[-1]]

    reached = textstats.let(F.split(a, ""), run)
    place = F.length(a) - F.length(b) + middle
    bit = reduce(or_, [(place == r) & (reached.bitwiseAND(1 << r) != 0) for r in range(2 * threshold + 1)])
    return (F.abs(F.length(a) - F.length(b)) <= threshold) & bit


def _bucket(n: Column) -> Column:
    """The least length of the bucket that a length lies in: four buckets from a power of two to the next, of four lengths at least."""
    places = F.greatest(F.length(F.bin(n)) - 3, F.lit(2))
    return F.call_function("shiftleft", F.call_function("shiftright", n, places), places)


def _buckets(n: Column, bucket: Column, threshold: int, least: int) -> Column:
    """The buckets that a line is in: its own, and near the lower end of it the one below."""
    return F.when((n - bucket < threshold) & (bucket > least), F.array(bucket, _bucket(bucket - 1))).otherwise(F.array(bucket))


def _segment_keys(line: Column, n: Column, bucket: Column, size: Column, threshold: int) -> Column:
    """Keys of the segments, then of the other places where a line of the bucket can have them."""

    def key(i: int, start: Column) -> Column:
        return F.xxhash64(F.lit(i), bucket, F.substr(line, start + 1, size))

    own = [*[key(i, size * i) for i in range(threshold)], key(threshold, n - size)]
    moved = [key(i, size * i + shift) for i in range(1, threshold) for shift in range(-i, i + 1) if shift]
    return F.array(*own, *moved)


def _counts(line: Column, n: Column) -> Column:
    """The length and counts of a few characters, modulo 16 in 4 bits each."""
    each = [F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in COUNTED]
    return reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft((k % 16).cast("long"), 4 * at) for at, k in enumerate([n, *each])])


def _may_be_near(a: Column, b: Column, threshold: int) -> Column:
    """An edit changes one count, and another one or the length, by one each; in a beginning of fixed length as well."""

    def apart(k: int) -> Column:
        d = F.abs(F.shiftright(a, 4 * k).bitwiseAND(15) - F.shiftright(b, 4 * k).bitwiseAND(15))
        return F.least(d, 16 - d)

    return (apart(0) <= threshold) & (reduce(add, [apart(k) for k in range(len(COUNTED) + 1)]) <= 2 * threshold)


def _second(line: Column) -> Column:
    return F.xxhash64(F.lit("second"), line)


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: ``doc_id, text_hash, place, line, h1, h2``."""
    cut = docs.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    worded = cut.where(F.length(textstats.without(F.col("line"), textstats.SPACES)) > 0)
    return worded.select("*", F.xxhash64("line").alias("h1"), _second(F.col("line")).alias("h2"))


def _place() -> Column:
    return F.struct("doc_id", "text_hash", "place")


def _without_copies(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Lines less the later occurrences of those that occur often. Other copies may stay; they change no result.

    The lines that occur often are stored, so that Spark knows when they are few enough to leave the texts where they are.
    """
    often = stored(
        firsts.where(F.col("n") > OFTEN).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("first").alias("_first"))
    )
    joined = lines.join(often, (lines["h1"] == often["_h1"]) & (lines["h2"] == often["_h2"]), "left")
    return joined.where(F.col("_h1").isNull() | _place().eqNullSafe(F.col("_first"))).drop("_h1", "_h2", "_first")


def _wanted(hashes: DataFrame) -> Column:
    """A test of ``h1`` against a bitmap of fixed size of the given ones: at most 2**14 numbers, written into the plan.

    All that are given pass, and few others while the bitmap is not full.
    """
    place = F.shiftrightunsigned("h1", 64 - FILTER_BITS)
    word, bit = F.shiftrightunsigned(place, 6).cast("int"), place.bitwiseAND(63).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    table = [0] * (1 << (FILTER_BITS - 6))
    for row in hashes.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits")).collect():
        table[row["word"]] = row["bits"]
    bitmap = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    return F.get(bitmap, word).bitwiseAND(one) != 0


def _near_links(lines: DataFrame, firsts: DataFrame, threshold: int, least: int) -> DataFrame:
    """Pairs of distinct lines within the threshold: ``h1_a, h2_a, h1_b, h2_b``."""
    long_lines = lines.withColumn("n", F.length("line")).where(F.col("n") >= least)
    line, n, bucket, size = F.col("line"), F.col("n"), F.col("bucket"), F.col("size")
    # One projection after the other: what several expressions use is computed once.
    measured = _without_copies(long_lines, firsts).select("h1", "line", "n", _counts(line, n).alias("counts"), _bucket(n).alias("bucket"))
    placed = measured.withColumn("bucket", F.explode(_buckets(n, bucket, threshold, least)))
    sized = placed.withColumn("size", F.floor(F.greatest(bucket, F.lit(least)) / (threshold + 1)).cast("int"))
    begun = sized.withColumn("begin", F.substr(line, F.lit(1), size * threshold))
    keyed = stored(
        begun.select(
            "h1", "counts", _counts(F.col("begin"), size * threshold).alias("begin"),
            _segment_keys(line, n, bucket, size, threshold).alias("keys"),
        )
    )
    index = keyed.select(F.explode(F.slice("keys", 1, threshold + 1)).alias("key"), "h1", "counts", "begin")
    probe = keyed.select(
        F.explode("keys").alias("key"), F.col("h1").alias("h1_b"), F.col("counts").alias("counts_b"), F.col("begin").alias("begin_b")
    )
    meet = (index["key"] == probe["key"]) & (index["h1"] < probe["h1_b"])
    alike = _may_be_near(index["counts"], probe["counts_b"], threshold) & _may_be_near(index["begin"], probe["begin_b"], threshold)
    met = index.join(probe, meet & alike)
    pairs = stored(met.select(F.col("h1").alias("h1_a"), "h1_b").distinct())
    sides = pairs.select("*", F.explode(F.array("h1_a", "h1_b")).alias("h1"))
    said = long_lines.where(_wanted(sides)).groupBy("h1").agg(F.first("line").alias("line"))
    texts = sides.join(said, "h1").groupBy("h1_a", "h1_b").agg(
        F.max(F.when(F.col("h1") == F.col("h1_a"), F.col("line"))).alias("line_a"),
        F.max(F.when(F.col("h1") == F.col("h1_b"), F.col("line"))).alias("line_b"),
    )
    both = texts.where("line_a IS NOT NULL AND line_b IS NOT NULL")
    near = both.where(within_edits(F.col("line_a"), F.col("line_b"), threshold))
    return near.select("h1_a", _second(F.col("line_a")).alias("h2_a"), "h1_b", _second(F.col("line_b")).alias("h2_b"))


def decide(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    near_length: int = NEAR_LENGTH,
    id_column: str = "doc_id",
    text: str = "text",
) -> LineDecisions:
    """Which lines of the documents repeat earlier ones.

    Lines are cut at ``\\n`` and ordered by document id (null first), text and place. A line goes as *exact* if an equal
    one comes before it, and as *near* if it is the first of its kind and a line within ``threshold`` edits comes before
    it; for that both need ``near_length`` characters. Lines without a word stay. Null texts have no lines. Rows equal in
    id and text are one document and are reported alike. An empty table gives an empty result; other columns are not
    carried. ``threshold`` can be 0 to 3. ``near_length`` can be as low as ``threshold + 1``, so that every segment has a
    character; shorter lines are compared for equality only, as any two of them are within the threshold.
    """
    if near_length <= threshold:
        raise ValueError(f"near_length must be over the threshold of {threshold}, got {near_length}")
    docs = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    lines = _lines(docs)
    places, at = stored(lines.drop("line")), _place()
    firsts = stored(places.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")))
    links = stored(_near_links(lines, firsts, threshold, near_length))
    first_a = firsts.select(F.col("h1").alias("h1_a"), F.col("h2").alias("h2_a"), F.col("first").alias("first_a"))
    first_b = firsts.select(F.col("h1").alias("h1_b"), F.col("h2").alias("h2_b"), F.col("first").alias("first_b"))
    both = links.join(first_a, ["h1_a", "h2_a"]).join(first_b, ["h1_b", "h2_b"])
    a, b = F.struct(F.col("h1_a").alias("h1"), F.col("h2_a").alias("h2")), F.struct(F.col("h1_b").alias("h1"), F.col("h2_b").alias("h2"))
    a_later = F.col("first_a") > F.col("first_b")
    ordered = stored(both.select(F.when(a_later, a).otherwise(b).alias("later"), F.when(a_later, b).otherwise(a).alias("earlier")))
    ends = ordered.select(F.col("later").alias("line"), F.lit(1).alias("is_later")).union(ordered.select("earlier", F.lit(0)))
    near = ends.groupBy("line.h1", "line.h2").agg((F.max("is_later") == 1).alias("near"), F.count("*").alias("n_near"))
    judged = firsts.join(near, ["h1", "h2"], "left").where((F.col("n") > 1) | F.col("n_near").isNotNull())
    seen = places.join(stored(judged.drop("n")), ["h1", "h2"])
    exact = ~at.eqNullSafe(F.col("first"))
    line = F.struct(
        "place", exact.alias("exact"), (~exact & F.coalesce("near", F.lit(False))).alias("near"),
        F.coalesce("n_near", F.lit(0)).alias("n"),
    )
    told = seen.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(line)).alias("told"))

    def places_of(kind: str) -> Column:
        return F.transform(F.filter("told", lambda x: x[kind]), lambda x: x["place"]).alias(kind)

    gone = told.select(
        "doc_id", "text_hash", places_of("exact"), places_of("near"),
        F.aggregate("told", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("n_links"),
    )
    found = gone.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    counted = docs.select("doc_id", "text_hash", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    same = counted["doc_id"].eqNullSafe(found["_doc_id"]) & (counted["text_hash"] == found["_text_hash"])
    none = F.array().cast("array<int>")
    documents = counted.join(found, same, "left").select(
        "doc_id", "text_hash", F.greatest("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("exact", none).alias("exact"), F.coalesce("near", none).alias("near"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return LineDecisions(documents, ordered)


def without_repeated_lines(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` (all columns) with the repeated lines taken out of ``text``; documents left without a word go.

    A document that had no word before stays as it is.
    """
    decisions = decide(docs, threshold).documents
    gone = stored(
        decisions.select(
            F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), F.concat("exact", "near").alias("_gone")
        ).where(F.size("_gone") > 0).distinct()
    )
    same = docs["doc_id"].eqNullSafe(gone["_doc_id"]) & (F.xxhash64(docs["text"]) == gone["_text_hash"])
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("_gone", i))
    joined = docs.join(gone, same, "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    cleaned = joined.withColumn("text", text)
    blank = F.length(textstats.without(F.col("text"), textstats.SPACES)) == 0
    return cleaned.where(F.col("_gone").isNull() | ~blank).select(*docs.columns)
