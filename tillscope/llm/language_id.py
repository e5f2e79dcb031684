"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; every run of characters that are no letters is one separator. The model of a language gives the
probability of a character after the three before it. Counts of all orders come from the whole training corpus: the top
order counts characters in context, lower ones count the different characters seen before a gram. What a discount takes
from seen grams goes to the next lower order. No gram is left out: probabilities are computed in Spark and lie in tables.
Tasks hold the costs of the most frequent grams only, and the others meet theirs in a join.

A text gets the language with the lowest cross-entropy per character. Its score is the language's share under a softmax
over entropies, with a weight fitted on a part of the training rows by models that leave this part out; the same part gives
the entropy above which a text is no text of its language and is rejected. Then the part's counts are added to the models.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.stored import stored
from tillscope.llm.words import small_batches

ORDER = 4
BITS = 16
MAX_GRAMS = 500_000
HELD_CELLS = 2_000_000
PIECE = 1 << 20
WEIGHTS = (0.25, 0.5, 1.0, 2.0, 4.0, 8.0)
DEVIATIONS = 8.0
SLACK = 0.5
UNFITTED = (3.0, 3.0)
POOLED_ROWS = 200
UNKNOWN = "und"

_classes: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    """A 16-bit class for each code point: 0 for what is no letter, itself for letters of the basic plane."""
    if not _classes:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, len(points))
        folded = np.where(points < 0x10000, points, 1 + points % 0xFFFF)
        _classes.append(np.where(letter, folded, 0).astype(np.uint16))
    return _classes[0]


def _gram_codes(classes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The gram that ends at each class; ``place`` is how far it stands from the beginning of its text."""
    code = classes.copy()
    for back in range(1, ORDER):
        shifted = np.zeros_like(classes)
        shifted[back:] = classes[:-back]
        shifted[place < back] = 0
        code |= shifted << np.uint64(BITS * back)
    return code


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _codes_of_long(text: str) -> np.ndarray:
    """Grams of one text, worked through in pieces; the last classes of a piece go on into the next."""
    out, tail, before, last = [], np.zeros(0, np.uint64), 0, 1
    for at in range(0, len(text), PIECE):
        raw = _class_table()[_points(text[at : at + PIECE] if at else f"\n{text[:PIECE]}")]
        kept = raw != 0
        kept[1:] |= raw[:-1] != 0
        kept[0] |= last != 0
        last = raw[-1]
        classes = np.concatenate((tail, raw[kept].astype(np.uint64)))
        place = np.arange(len(classes)) + (before - len(tail))
        out.append(_gram_codes(classes, place)[len(tail) + (at == 0) :])
        before += len(classes) - len(tail)
        tail = classes[-(ORDER - 1) :]
    return np.concatenate(out)


def codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Grams of a text column as 64-bit codes (the last character lowest), and the row of each.

    Every character but the separator that a text begins with is the end of a gram; before the text there are separators.
    A text of more than ``PIECE`` characters is worked through in pieces, which changes no gram.
    """
    lowered = pc.utf8_lower(column).to_pylist()
    long_rows = [(row, _codes_of_long(t)) for row, t in enumerate(lowered) if t and len(t) > PIECE]
    short_rows = [row for row, t in enumerate(lowered) if t and len(t) <= PIECE]
    code, owner = _codes_of_short([lowered[row] for row in short_rows], np.asarray(short_rows, np.int64))
    return (
        np.concatenate((code, *(c for _, c in long_rows))),
        np.concatenate((owner, *(np.full(len(c), row, np.int64) for row, c in long_rows))),
    )


def _codes_of_short(texts: Sequence[str], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    points = _points("".join(f"\n{t}" for t in texts))
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    classes = _class_table()[points]
    kept = classes != 0
    kept[1:] |= classes[:-1] != 0
    kept[starts] = True
    before = np.concatenate(([0], np.cumsum(kept)))
    first, classes = before[starts], classes[kept].astype(np.uint64)
    lengths = np.diff(np.append(first, len(classes)))
    place = np.arange(len(classes)) - np.repeat(first, lengths)
    code = _gram_codes(classes, place)
    inner = place > 0
    return code[inner], np.repeat(rows, lengths)[inner]


@dataclass
class Held:
    """Codes of the top order in ascending order, and the probability of each in every language."""

    codes: np.ndarray
    probabilities: np.ndarray

    @staticmethod
    def of(table: DataFrame, width: int) -> Held:
        """From the rows ``code, p``; a column for each language comes to the driver, which holds one at a time beside the result."""
        columns = [F.element_at("p", k + 1).alias(f"p{k}") for k in range(width)]
        found = table.select("code", *columns).toArrow()
        code = found.column(0).to_numpy().view(np.uint64)
        order = np.argsort(code)
        probabilities = np.empty((len(code), max(width, 1)))
        for k in range(width):
            probabilities[:, k] = found.column(k + 1).to_numpy()[order]
        return Held(code[order], probabilities)

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are held, and the cost of each in every language; 0 for the others."""
        if not len(self.codes):
            return np.zeros(len(code), bool), np.zeros((len(code), self.probabilities.shape[1]))
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        return known, np.where(known[:, None], -np.log(self.probabilities[at]), 0.0)


@dataclass
class Model:
    """Every gram's probability and every context's share for lower orders, as tables in the shared folder.

    ``seen[order]`` has ``code, p`` and ``shares[order]`` has ``context, share``: arrays over the languages, null where a
    language has not seen it. ``base`` is the probability of a character that a language has not seen. ``held`` has the final
    probabilities of the most frequent codes, which spares a join for them; it does not change any result.
    """

    languages: list[str]
    seen: dict[int, DataFrame] = field(default_factory=dict)
    shares: dict[int, DataFrame] = field(default_factory=dict)
    base: list[float] = field(default_factory=list)
    held: Held | None = None
    ceiling: float = float("inf")
    weight: float = 1.0
    means: np.ndarray | None = None
    spreads: np.ndarray | None = None

    @property
    def grams(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """What tasks hold: codes and probabilities of the top order."""
        return {ORDER: (self.held.codes, self.held.probabilities)}

    def resolved(self, codes: DataFrame, order: int = ORDER) -> DataFrame:
        """``code, p`` for the distinct codes in ``code``: probability of the last character in each language.

        A key meets at most as many rows as there are characters, since every order resolves its distinct codes.
        """
        seen = codes.join(self.seen[order], "code", "left")
        if order == 1:
            base = F.array(*[F.lit(x) for x in self.base])
            return seen.select("code", F.coalesce(F.zip_with("p", base, lambda x, y: F.coalesce(x, y)), base).alias("p"))
        low = F.col("code").bitwiseAND((1 << (BITS * (order - 1))) - 1)
        lower = self.resolved(codes.select(low.alias("code")).distinct(), order - 1)
        joined = (
            seen.withColumn("low", low).withColumn("context", F.shiftrightunsigned("code", BITS))
            .join(self.shares[order], "context", "left")
            .join(lower.select(F.col("code").alias("low"), F.col("p").alias("lower")), "low")
        )
        backed = F.coalesce(F.zip_with("share", "lower", lambda s, x: F.coalesce(s, F.lit(1.0)) * x), F.col("lower"))
        return joined.select("code", F.coalesce(F.zip_with("p", backed, lambda x, y: F.coalesce(x, y)), backed).alias("p"))

    def probabilities(self, code: np.ndarray) -> np.ndarray:
        """Probability of each gram's last character in each language; for a few codes at the driver."""
        distinct, inverse = np.unique(code, return_inverse=True)
        known, cost = self.held.find(distinct)
        if not known.all():
            rows = [(int(x),) for x in distinct[~known].view(np.int64)]
            asked = self.seen[ORDER].sparkSession.createDataFrame(rows, "code long")
            cost[~known] = Held.of(self.resolved(asked), len(self.languages)).find(distinct[~known])[1]
        return np.exp(-cost)[inverse]

    def entropies(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Characters counted, and mean negative log probability in each language, of every row; for a few texts at the driver."""
        code, rows = codes(column)
        n = np.bincount(rows, minlength=len(column))
        total = _by_row(-np.log(self.probabilities(code)), rows, len(column)) if len(code) else np.zeros((len(column), len(self.languages)))
        return n, total / np.maximum(n, 1)[:, None]


def _by_row(cost: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, weights=cost[:, k], minlength=n).astype(float) for k in range(cost.shape[1])], axis=1)


def _count(docs: DataFrame) -> DataFrame:
    """``lang, code, n`` of the top order over all rows of ``docs``."""

    def compact(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        all_codes, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        distinct, inverse = np.unique(all_codes, return_inverse=True)
        return [(distinct, np.bincount(inverse, weights=n, minlength=len(distinct)).astype(np.int64))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in small_batches(batches, "text", most=PIECE):
            code, rows = codes(batch.column("text"))
            names, own = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            for k, name in enumerate(names):
                parts = found.setdefault(name, [])
                parts.append(np.unique(code[own[rows] == k], return_counts=True))
                if sum(len(p[0]) for p in parts) > 2_000_000:
                    found[name] = compact(parts)
                    if len(found[name][0][0]) > 1_000_000:
                        yield row_batch(name, found.pop(name))
        for name, parts in found.items():
            yield row_batch(name, parts)

    def row_batch(name: str, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        code, n = compact(parts)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(code), pa.string()), pa.array(code.view(np.int64)), pa.array(n)], names=["lang", "code", "n"]
        )

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows ``code, n`` with the largest ``n``, at most ``most`` and whole classes of about equal ``n``."""
    if counted.count() <= most:
        return counted
    step = F.floor(F.log2("n") * 4)
    room, least = most, None
    for row in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    return counted.where(step >= least) if least is not None else counted.limit(0)


def _discounts(level: DataFrame, languages: list[str]) -> np.ndarray:
    found = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
    by = {r["lang"]: r["n1"] / (r["n1"] + 2 * r["n2"]) if r["n1"] else 0.5 for r in found.collect()}
    return np.array([min(max(by.get(name, 0.5), 0.1), 0.9) for name in languages])


def _wide(rows: DataFrame, key: str, value: str, languages: list[str]) -> DataFrame:
    """``key`` and an array of the ``value`` of each language."""
    return rows.groupBy(key).agg(F.array(*[F.max(F.when(F.col("lang") == name, F.col(value))) for name in languages]).alias(value))


def train(docs: DataFrame, max_grams: int = MAX_GRAMS) -> Model:
    """Models of the languages in ``lang`` from the rows ``lang, text`` (without nulls), with every gram of every order.

    ``max_grams`` for each language, and ``HELD_CELLS`` for all, bound what is sent to every task: the most frequent grams,
    whose costs then need no join.
    """
    return _trained(stored(_count(docs)), max_grams)


def _trained(top: DataFrame, max_grams: int = MAX_GRAMS) -> Model:
    """Models from stored counts ``lang, code, n`` of the top order."""
    languages = sorted(r["lang"] for r in top.select("lang").distinct().collect())
    if not languages:
        return Model(languages)
    levels = {ORDER: top}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("code").bitwiseAND((1 << (BITS * order)) - 1)
        levels[order] = stored(levels[order + 1].groupBy("lang", shorter.alias("code")).agg(F.count("*").alias("n")))
    model, lower = Model(languages), None
    characters = levels[1].select("code").distinct().count()  # of all languages, so that their entropies compare
    floor = 1.0 / (characters + 1)
    model.ceiling = float(np.log(characters + 1))
    for order in range(1, ORDER + 1):
        level, discounts = levels[order], _discounts(levels[order], languages)
        discount = F.coalesce(*[F.when(F.col("lang") == name, F.lit(float(d))) for name, d in zip(languages, discounts)])
        context = F.shiftrightunsigned("code", BITS).alias("context")
        totals = level.groupBy("lang", context).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        totals = stored(totals.withColumn("share", discount * F.col("kinds") / F.col("total")))
        if order == 1:
            share = {r["lang"]: r["share"] for r in totals.select("lang", "share").collect()}
            model.base = [share[name] * floor for name in languages]
            joined = level.withColumn("context", context).join(totals, ["lang", "context"]).withColumn("lower", F.lit(floor))
        else:
            model.shares[order] = stored(_wide(totals, "context", "share", languages))
            low = F.col("code").bitwiseAND((1 << (BITS * (order - 1))) - 1).alias("low")
            joined = level.withColumn("context", context).withColumn("low", low).join(totals, ["lang", "context"])
            joined = joined.join(lower.select("lang", F.col("code").alias("low"), F.col("p").alias("lower")), ["lang", "low"])
        p = (F.col("n") - discount) / F.col("total") + F.col("share") * F.col("lower")
        lower = stored(joined.select("lang", "code", p.alias("p")))
        model.seen[order] = stored(_wide(lower, "code", "p", languages))
    most = min(max_grams * len(languages), HELD_CELLS // len(languages))
    chosen = stored(_most_frequent(stored(top.groupBy("code").agg(F.sum("n").alias("n"))), most).select("code"))
    model.held = Held.of(model.resolved(chosen), len(languages))
    return model


def _listed(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values))


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without ``text``, with ``n`` and ``entropies``.

    One pass adds up the costs of the codes that tasks hold, and lists the others of each row. Of these, the most frequent
    are held in a pass over the lists, and the rest meets its costs in a join.
    """
    kept = [f.name for f in docs.schema.fields if f.name != "text"]
    held, width = model.held, len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", most=PIECE):
            code, rows = codes(batch.column("text"))
            distinct, inverse = np.unique(code, return_inverse=True)
            known, cost = held.find(distinct)
            total = _by_row(cost[inverse], rows, batch.num_rows)
            other = ~known[inverse]
            pairs, count = np.unique(rows[other] * max(len(distinct), 1) + inverse[other], return_counts=True)
            row, which = np.divmod(pairs, max(len(distinct), 1))
            yield made(batch, np.bincount(rows, minlength=batch.num_rows), total, distinct[which].view(np.int64), count, row)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("codes")
            rows = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
            code, count = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            known, cost = more.find(code.view(np.uint64))
            total = batch.column("total").flatten().to_numpy().reshape(-1, width) + _by_row(cost * count[:, None], rows, batch.num_rows)
            yield made(batch, batch.column("n").to_numpy(), total, code[~known], count[~known], rows[~known])

    def made(batch: pa.RecordBatch, n: np.ndarray, total: np.ndarray, code: np.ndarray, count: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        lengths = np.bincount(rows, minlength=batch.num_rows)
        carried = [c for c in (*kept, "row") if c in batch.schema.names]
        columns = [pa.array(n), _listed(total.ravel(), np.full(batch.num_rows, width)), _listed(code, lengths), _listed(count, lengths)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carried), *columns], names=[*carried, "n", "total", "codes", "counts"]
        )

    def listed(rows: DataFrame) -> DataFrame:
        each = rows.select("row", F.explode(F.arrays_zip("codes", "counts")).alias("x"))
        return each.select("row", F.col("x.codes").alias("code"), F.col("x.counts").alias("times"))

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "text")
    made_of = "n long, total array<double>, codes array<long>, counts array<long>"
    rows = stored(docs.mapInArrow(score, schema + made_of).withColumn("row", F.monotonically_increasing_id()))
    whole, part = rows.where(F.size("codes") == 0), rows.where(F.size("codes") > 0)
    out = [*kept, "n", "total"]
    result = whole.select(out)
    if not part.isEmpty():
        counted = stored(listed(part).groupBy("code").agg(F.count("*").alias("n")))
        found = stored(model.resolved(counted.select("code")))
        more = Held.of(_most_frequent(counted, HELD_CELLS // width).select("code").join(found, "code"), width)
        part = stored(part.select(*kept, "row", "n", "total", "codes", "counts").mapInArrow(settle, f"{schema}row long, {made_of}"))
        result = result.union(part.where(F.size("codes") == 0).select(out))
        left = part.where(F.size("codes") > 0)
        if not left.isEmpty():
            cost = [F.sum(-F.log(F.element_at("p", k + 1)) * F.col("times")) for k in range(width)]
            added = listed(left).join(found, "code").groupBy("row").agg(F.array(*cost).alias("added"))
            whole = left.join(added, "row").withColumn("total", F.zip_with("total", "added", lambda a, b: a + b))
            result = result.union(whole.select(out))
    return result.select(*kept, "n", F.transform("total", lambda x: x / F.greatest("n", F.lit(1))).alias("entropies"))


def _shares(weight: float) -> Column:
    """Softmax over entropies, sharper for longer texts."""
    least = F.array_min("entropies")
    raw = F.transform("entropies", lambda h: F.exp((least - h) * F.sqrt("n") * weight))
    return F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda a, b: a + b))


def calibrate(model: Model, docs: DataFrame) -> Model:
    """Fit the weight of the scores, and mean and spread of the entropy of each language, on rows ``lang, text``.

    A language's spread is drawn to that over all languages, which counts as ``POOLED_ROWS`` rows.
    """
    languages = F.array(*[F.lit(name) for name in model.languages])
    scored = stored(_scored(docs, model).where("n > 0").withColumn("own", F.array_position(languages, F.col("lang")).cast("int")))
    scored = scored.where("own > 0")
    losses = [F.avg(-F.log(F.greatest(F.element_at(_shares(w), F.col("own")), F.lit(1e-12)))).alias(f"w{k}") for k, w in enumerate(WEIGHTS)]
    loss = scored.agg(*losses).first()
    model.weight = min(WEIGHTS, key=lambda w: loss[WEIGHTS.index(w)] if loss[WEIGHTS.index(w)] is not None else 0.0)
    own = F.element_at("entropies", F.col("own"))
    middle = {r["own"]: r["middle"] for r in scored.groupBy("own").agg(F.percentile_approx(own, 0.5).alias("middle")).collect()}
    model.means = np.array([middle.get(k + 1, UNFITTED[0]) for k in range(len(model.languages))])
    mean = F.element_at(F.array(*[F.lit(float(x)) for x in model.means]), F.col("own"))
    apart = F.abs(own - mean) * F.sqrt("n")
    ninth = F.percentile_approx(apart, 0.9).alias("spread")
    pooled = scored.agg(ninth).first()["spread"]
    pooled = UNFITTED[1] if pooled is None else pooled
    spread = {
        r["own"]: (r["rows"] * r["spread"] + POOLED_ROWS * pooled) / (r["rows"] + POOLED_ROWS)
        for r in scored.groupBy("own").agg(ninth, F.count("*").alias("rows")).collect()
    }
    model.spreads = np.array([spread.get(k + 1, pooled) for k in range(len(model.languages))])
    return model


def classify(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, lang_pred, score, cross_entropy, rejected`` for each row.

    Null texts and texts without a letter are ``und`` with score 0 and rejected. Without any learned language all are.
    Equal texts are scored alike; ties go to the language first in the alphabet. Other columns are not carried.
    """
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    if not model.languages:
        return chosen.select("doc_id", "text_hash", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                             F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    scored = _scored(chosen, model)
    known = F.col("n") > 0
    best = F.array_position("entropies", F.array_min("entropies")).cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), best)
    limit = pick(model.means.tolist()) + SLACK + DEVIATIONS * pick(model.spreads.tolist()) / F.sqrt(F.greatest("n", F.lit(1)))
    limit = F.least(limit, F.lit(model.ceiling))  # what characters drawn evenly from the alphabet cost
    return scored.select(
        "doc_id", "text_hash",
        F.when(known, pick(model.languages)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.array_max(_shares(model.weight))).otherwise(0.0).alias("score"),
        F.when(known, F.array_min("entropies")).alias("cross_entropy"),
        (~known | (F.array_min("entropies") > limit)).alias("rejected"),
    )


def fold(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % 4


def fit(docs: DataFrame, held_out: int = 2, calibration: int = 3) -> Model:
    """A calibrated model from rows ``doc_id, text, lang``: counts from all folds but the held-out one.

    Weight and limits are fitted on the calibration fold with a model of the other folds; then the counts of that fold are
    added. A language without calibration rows gets the limits of ``calibrate`` for such. Rows with a null language or text, or in the held-out fold, are not used.
    """
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("fold", F.coalesce(fold(), F.lit(0)))
    others, own = (
        stored(_count(usable.where(rows).select("lang", "text")))
        for rows in (~F.col("fold").isin(held_out, calibration), F.col("fold") == calibration)
    )
    rows = usable.where(F.col("fold") == calibration).select("lang", "text")
    weight, limits = _calibration(others, rows)
    model = _trained(stored(others.union(own).groupBy("lang", "code").agg(F.sum("n").alias("n"))))
    if not model.languages:
        return model
    model.weight = weight
    model.means, model.spreads = (np.array([limits.get(x, UNFITTED)[k] for x in model.languages]) for k in (0, 1))
    return model


def _calibration(counted: DataFrame, rows: DataFrame) -> tuple[float, dict[str, tuple[float, float]]]:
    """Weight, and mean and spread of each language, by a model that is not kept."""
    model = _trained(counted)
    if not model.languages:
        return model.weight, {}
    calibrate(model, rows)
    return model.weight, dict(zip(model.languages, zip(model.means, model.spreads)))


def without_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns) that the model does not reject."""
    gone = classify(docs, model).where("rejected").select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")
    ).distinct()
    same = docs["doc_id"].eqNullSafe(gone["_doc_id"]) & (F.xxhash64(docs["text"]) == gone["_text_hash"])
    return docs.join(gone, same, "left_anti")
