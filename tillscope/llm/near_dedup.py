"""Near-duplicate documents by order MinHash and banded alignment.

1. One pass over the texts gives each document a digest of its words and the keys of its bands.
2. Exact copies (equal words) stand behind the smallest document id among them.
3. Documents that share a band key are candidates. Pairs are taken in rounds: the first documents of a bucket, those that
   meet most others, are compared with all members that are not yet in their class. So a bucket of n documents of one
   class costs about n comparisons. Buckets that hold several classes after that are cut into blocks, and each pair of
   blocks goes to a task of its own, where members not yet in one class are compared. No pair of different texts is left out.
4. A pair is a near-duplicate if the best alignment of its shingles shares at least the given part of them.
5. Classes are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillscope.llm import order_sketch
from tillscope.llm.bitmap import bitmap, within
from tillscope.llm.components import components
from tillscope.llm.stored import stored
from tillscope.llm.words import mix, small_batches, split_words

ROUNDS = 3
BLOCK = 512


@dataclass(frozen=True)
class Classes:
    """documents: ``doc_id, class_id`` for each input row. links: verified pairs ``a, b, similarity`` of different texts."""

    documents: DataFrame
    links: DataFrame


def _sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, digest of the words (two longs), ``size`` in shingles, and ``bands`` of every document with an id."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = split_words(pc.utf8_lower(batch.column("text")))
            hashes, first = order_sketch.sequence(words)
            digests = np.zeros((batch.num_rows, 2), dtype=np.uint64)
            for r in range(batch.num_rows):
                own = words.hashes[words.first[r] : words.first[r + 1]]
                at = np.arange(1, len(own) + 1, dtype=np.uint64)
                digests[r] = mix(own + mix(at)).sum(), mix(own ^ mix(at + np.uint64(1 << 40))).sum()
            keys = [
                order_sketch.band_keys(hashes[a:b], order_sketch.bands_of(b - a)).view(np.int64) if a < b else np.zeros(0, np.int64)
                for a, b in zip(first[:-1], first[1:])
            ]
            lengths = np.array([len(k) for k in keys])
            ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            values = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests[:, 0].view(np.int64)), pa.array(digests[:, 1].view(np.int64)),
                 pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(ends), values)],
                names=["doc_id", "digest1", "digest2", "size", "bands"],
            )

    return docs.mapInArrow(sketch, "doc_id long, digest1 long, digest2 long, size long, bands array<long>")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with these ``node`` ids, and a few others."""
    table = bitmap(ids.select(F.xxhash64("node").alias("key")), "key")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(within(table, batch.column("key").to_numpy())))
            if some.num_rows:
                yield some.select(["doc_id", "text"])

    return docs.withColumn("key", F.xxhash64("doc_id")).mapInArrow(chosen, "doc_id long, text string")


def _verified(docs: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs whose similarity is at least ``least``."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text_a", "text_b"):
            x, y = (order_sketch.sequence(split_words(pc.utf8_lower(batch.column(c)))) for c in ("text_a", "text_b"))
            found = np.array([
                order_sketch.similarity(x[0][x[1][r] : x[1][r + 1]], y[0][y[1][r] : y[1][r + 1]], least)
                for r in range(batch.num_rows)
            ])
            kept = np.flatnonzero(found > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(kept)), batch.column("b").take(pa.array(kept)), pa.array(found[kept])],
                names=["a", "b", "similarity"],
            )

    texts = _texts(docs, pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    of_a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(of_a, "a").join(of_b, "b").mapInArrow(align, "a long, b long, similarity double")


def _members(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets of two or more texts: all members ``band, node, size``, and the first ``band, place, node``.

    First come the texts that meet most others over all their buckets.
    """
    placed = stored(nodes.where("size > 0").select("node", "size", F.explode("bands").alias("band")))
    shared = placed.groupBy("band").agg(F.count("*").alias("held")).where("held > 1")
    members = stored(placed.join(shared, "band"))
    scores = members.groupBy("node").agg(F.sum("held").alias("score"))
    best = Window.partitionBy("band").orderBy(F.desc("score"), "node")
    heads = members.join(scores, "node").withColumn("place", F.row_number().over(best)).where(F.col("place") <= ROUNDS)
    return members.drop("held"), stored(heads.select("band", "place", "node"))


def _rooted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _candidates(members: DataFrame, heads: DataFrame, place: int, least: float) -> DataFrame:
    """Pairs of the bucket's member at ``place`` with the members that are not in its class."""
    x = members.join(heads.where(F.col("place") == place).select("band", "node"), ["band", "node"], "left_semi")
    x = x.select("band", *(F.col(c).alias(f"{c}_x") for c in ("node", "size", "root")))
    y = members.select("band", *(F.col(c).alias(f"{c}_y") for c in ("node", "size", "root")))
    close = F.least("size_x", "size_y") >= least * F.greatest("size_x", "size_y")
    pairs = x.join(y, (x["band"] == y["band"]) & (F.col("root_x") != F.col("root_y")) & close)
    return pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _blocks(members: DataFrame, heads: DataFrame, block: int) -> DataFrame:
    """Members of buckets of several classes for each pair of blocks they are in: ``band, i, j, own, node, root``.

    Members that had a place have been compared with all others. A bucket of n members has n / block blocks.
    """
    rest = members.join(heads.select("band", "node"), ["band", "node"], "left_anti")
    mixed = rest.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    parts = mixed.where("low <> high").select("band", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    placed = rest.join(parts, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return other.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root")


def _compared_blocks(blocks: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Verified pairs ``a, b, similarity`` within the blocks. A pair of several buckets is compared in the first of them."""

    def find(roots: dict[int, int], x: int) -> int:
        while roots.get(x, x) != x:
            x = roots[x]
        return x

    def compare(key: tuple, rows: list[dict]) -> list[tuple]:
        band, i, j = key
        left = [r for r in rows if r["own"] == i]
        right = left if i == j else [r for r in rows if r["own"] == j]
        if not left or not right:
            return []
        which = left[0]["bands"].index(band)  # short texts have more bands
        x, y = (np.array([r["bands"][: which + 1] for r in side], np.int64) for side in (left, right))
        meet = np.ones((len(left), len(right)), bool)
        for k in range(which):
            meet &= x[:, k][:, None] != y[:, k][None, :]
        sizes = [np.array([r["size"] for r in side], float) for side in (left, right)]
        small, large = (f(sizes[0][:, None], sizes[1][None, :]) for f in (np.minimum, np.maximum))
        meet &= small >= least * large
        if i == j:
            meet = np.triu(meet, 1)
        hashes: dict[int, np.ndarray] = {}

        def sequence(row: dict) -> np.ndarray:
            if row["node"] not in hashes:
                hashes[row["node"]] = order_sketch.sequence(split_words(pc.utf8_lower(pa.array([row["text"]], pa.string()))))[0]
            return hashes[row["node"]]

        roots: dict[int, int] = {}
        found = []
        for p, q in np.argwhere(meet).tolist():
            one, other = left[p], right[q]
            a, b = find(roots, one["root"]), find(roots, other["root"])
            if a == b:
                continue
            share = order_sketch.similarity(sequence(one), sequence(other), least)
            if share > 0:
                roots[max(a, b)] = min(a, b)
                found.append((min(one["node"], other["node"]), max(one["node"], other["node"]), share))
        return found

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in small_batches(batches, "text"):
            found = []
            for row in batch.to_pylist():
                if (own := (row["band"], row["i"], row["j"])) != key:
                    found += compare(key, rows) if rows else []
                    key, rows = own, []
                rows.append(row)
            yield pairs(found)
        yield pairs(compare(key, rows) if rows else [])

    def pairs(found: list[tuple]) -> pa.RecordBatch:
        a, b, share = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(share, pa.float64())], names=["a", "b", "similarity"]
        )

    said = texts.select(F.col("doc_id").alias("node"), "text")
    filled = blocks.join(nodes.select("node", "size", "bands"), "node").join(said, "node")
    ordered = filled.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "own", "node")
    return ordered.mapInArrow(walk, "a long, b long, similarity double")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = order_sketch.SIMILARITY
) -> Classes:
    """Classes of documents whose words are equal, or whose shingles of five words align to ``least`` or more.

    Words are compared in lower case. Texts under five words are alike only if equal; texts without words, null ones
    among them, are all alike. A class is named by its smallest document id. Rows without an id have a null class. Rows
    that repeat an id are one document: what any of them is like, all are. An empty table has no classes; other columns
    are not carried. Two texts at a similarity of 0.8 share no bucket, and so can be missed, at most once in some 1,300
    cases at any length; far less often above.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = stored(_sketches(docs.where("doc_id IS NOT NULL")))
    nodes = stored(
        sketches.groupBy("digest1", "digest2").agg(
            F.min("doc_id").alias("node"), F.first("size").alias("size"), F.first("bands").alias("bands")
        )
    )
    members, heads = _members(nodes)
    texts = stored(_texts(docs.where("doc_id IS NOT NULL"), members.select("node")))
    tested = links = roots = None
    for place in range(1, ROUNDS + 1):
        pairs = _candidates(_rooted(members, roots), heads, place, least)
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        found = stored(_verified(texts, pairs, least))
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        roots = components(links)
    blocks = stored(_blocks(_rooted(members, roots), heads, BLOCK))
    if not blocks.isEmpty():
        found = stored(_compared_blocks(blocks, nodes, texts, least))
        links = found if links is None else links.union(found)
        roots = components(links)
    if links is None:
        links = docs.sparkSession.createDataFrame([], "a long, b long, similarity double")
    own = sketches.select("doc_id", "digest1", "digest2").join(
        nodes.select("digest1", "digest2", "node"), ["digest1", "digest2"]
    )
    classed = _rooted(own.select("doc_id", "node"), roots)
    merged = classed.select("doc_id", F.col("root").alias("class_id"))
    nameless = docs.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return Classes(merged.union(nameless), links)


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their class, the one with the smallest id; rows without an id stay."""
    classes = near_duplicates(docs).documents
    others = classes.where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti")
