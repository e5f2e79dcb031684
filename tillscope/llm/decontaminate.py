"""Benchmark decontamination: a prefix-filtered set join between documents and the windows of benchmark items.

Every window is the set of its placed shingles (short runs of words). A document contains a window only if it holds all
of them, so of the shingles ordered by rarity the first one is a sufficient prefix: documents are probed with the rarest
shingle of each window alone. Candidates must leave room for the window before and after the shingle, and are verified
word by word.

Documents are read twice: to count the shingles that benchmark items have, and to probe. Both passes test shingles
against a bitmap of fixed size, which only thins out rows; the joins decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillscope.llm.bitmap import BITS, bitmap, within
from tillscope.llm.stored import stored
from tillscope.llm.words import Words, shingles, small_batches, split_words

WINDOW = 10
SHINGLE = 3


@dataclass(frozen=True)
class Overlaps:
    """What was found.

    documents: a row for each row of the input, with ``doc_id``, ``text_hash`` and ``n_words``.
    hits: ``doc_id``, ``text_hash``, ``start``, ``length`` (in words) and ``window`` of each occurrence.
    items: ``window`` and ``item_id``.
    """

    documents: DataFrame
    hits: DataFrame
    items: DataFrame

    def spans(self) -> DataFrame:
        """Hit words of a document as disjoint spans: ``doc_id``, ``text_hash``, ``start``, ``length``."""
        ordered = Window.partitionBy("doc_id", "text_hash").orderBy("start", "length")
        places = self.hits.select("doc_id", "text_hash", "start", "length").distinct()
        reach = F.max(F.col("start") + F.col("length")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        begun = F.coalesce((F.col("start") > reach).cast("long"), F.lit(1))
        grouped = places.withColumn("begun", begun).withColumn("span", F.sum("begun").over(ordered))
        return grouped.groupBy("doc_id", "text_hash", "span").agg(
            F.min("start").alias("start"), (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length")
        )

    def by_document(self) -> DataFrame:
        """A row for each input row: ``doc_id``, ``text_hash``, ``n_words``, ``n_hit``, ``item_ids`` (sorted as strings)."""
        key = ["doc_id", "text_hash"]
        words = self.spans().groupBy(*key).agg(F.sum("length").alias("n_hit"))
        items = (
            self.hits.select(*key, "window").distinct().join(self.items, "window").groupBy(*key)
            .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
        )
        found = _left(_left(self.documents, words), items)
        return found.select(
            *key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )


def _left(docs: DataFrame, found: DataFrame) -> DataFrame:
    renamed = found.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    same = docs["doc_id"].eqNullSafe(renamed["_doc_id"]) & (docs["text_hash"] == renamed["_text_hash"])
    return docs.join(renamed, same, "left").drop("_doc_id", "_text_hash")


def _windows(items: DataFrame, window: int) -> DataFrame:
    """Windows of the items with their shingles: ``item_id``, ``window``, ``length``, ``shingle``, ``offset``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = split_words(batch.column("text"))
            rows: list[tuple] = []
            for r, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                length = min(window, b - a)
                for i in range(a, b - length + 1) if length else ():
                    rows.append((r, words.text(i, i + length), length, i, i + length))
            width_of = lambda n: min(SHINGLE, n)
            tables = {w: dict(zip(*(x.tolist() for x in shingles(words, w)))) for w in {width_of(n[2]) for n in rows}}
            flat = [
                (r, text, n, int(np.uint64(tables[width_of(n)][k]).astype(np.int64)), k - i)
                for r, text, n, i, j in rows for k in range(i, j - width_of(n) + 1)
            ]
            if flat:
                r, text, n, shingle, offset = zip(*flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(r)), pa.array(text, pa.string()), pa.array(n, pa.int64()),
                     pa.array(shingle, pa.int64()), pa.array(offset, pa.int64())],
                    names=["item_id", "window", "length", "shingle", "offset"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(cut, f"item_id {kind}, window string, length long, shingle long, offset long")


def _counts(docs: DataFrame, seen: np.ndarray, widths: list[int]) -> DataFrame:
    """Occurrences over all documents of the shingles in the bitmap."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = split_words(batch.column("text"))
            for width in widths:
                _, hashes = shingles(words, width)
                keys, n = np.unique(hashes[within(seen, hashes)], return_counts=True)
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    counted = docs.select("text").mapInArrow(count, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def _context(words: Words, row: int, at: int, width: int, reach: int) -> tuple[str, int]:
    begin, end = max(int(words.first[row]), at - reach), min(int(words.first[row + 1]), at + width + reach)
    return words.text(begin, end), at - begin


def _probe(docs: DataFrame, seen: np.ndarray, widths: list[int], window: int) -> DataFrame:
    """A row for each document (``shingle`` null), and one for each of its shingles in the bitmap with the words around."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = split_words(batch.column("text"))
            n_words, owner = words.counts(), words.rows()
            row, place, key, context, left = [np.arange(batch.num_rows)], [], [], [], []
            for width in widths:
                at, hashes = shingles(words, width)
                found = np.flatnonzero(within(seen, hashes))
                rows = owner[at[found]] if len(found) else np.zeros(0, np.int64)
                row.append(rows)
                place.append(at[found] - words.first[rows])
                key.append(hashes[found].view(np.int64))
                for r, k in zip(rows.tolist(), at[found].tolist()):
                    text, before = _context(words, r, k, width, window - 1)
                    context.append(text)
                    left.append(before)
            row, none = np.concatenate(row), [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), batch.column("text_hash").take(pa.array(row)),
                 pa.array(n_words[row]), pa.array(none + np.concatenate(place).tolist(), pa.int64()),
                 pa.array(none + np.concatenate(key).tolist(), pa.int64()), pa.array(none + context, pa.string()),
                 pa.array(none + left, pa.int64())],
                names=["doc_id", "text_hash", "n_words", "place", "shingle", "context", "left"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        probe, f"doc_id {kind}, text_hash long, n_words long, place long, shingle long, context string, left long"
    )


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text: str = "text",
    filter_bits: int = BITS,
) -> Overlaps:
    """Occurrences of benchmark windows in documents.

    ``items`` has ``item_id`` and ``text``. A window is ``window`` consecutive words of an item, or all words of a
    shorter one. Null and blank texts have no words, hence no window and no hit; empty tables give empty results. Other
    columns are not carried. Rows of equal id and text are reported alike, rows of equal id and different text apart.
    Items with the same words share windows, so copies among the items do not multiply the work. Documents are hashed
    in pieces; one text has to fit in memory.
    """
    docs = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    cut = stored(_windows(items.select("item_id", "text"), window))
    parts = cut.select("window", "length", "shingle", "offset").distinct()
    lengths = parts.agg(F.collect_set(F.least("length", F.lit(SHINGLE)))).first()[0]
    widths = sorted(int(w) for w in lengths) or [SHINGLE]
    counts = _counts(docs, bitmap(parts, "shingle", filter_bits), widths)
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest")
    prefix = stored(
        parts.join(counts, "shingle", "left").groupBy("window", "length").agg(rarest)
        .select("window", "length", "rarest.shingle", "rarest.offset")
    )
    probed = stored(_probe(docs, bitmap(prefix, "shingle", filter_bits), widths, window))
    start: Column = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    inside = F.array_join(
        F.slice(F.split("context", " "), (F.col("left") - F.col("offset") + 1).cast("int"), F.col("length").cast("int")), " "
    )
    hits = (
        probed.where("shingle IS NOT NULL").join(prefix, "shingle").where(fits)
        .where(inside == F.col("window"))
        .select("doc_id", "text_hash", start.alias("start"), "length", "window").distinct()
    )
    documents = probed.where("shingle IS NULL").select("doc_id", "text_hash", "n_words")
    return Overlaps(documents, stored(hits), cut.select("window", "item_id").distinct())


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark window."""
    overlaps = find_overlaps(docs, items, window)
    hit = overlaps.hits.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["_doc_id"]) & (F.xxhash64(docs["text"]) == hit["_text_hash"])
    return docs.join(hit, same, "left_anti")


