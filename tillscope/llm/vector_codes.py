"""Vector code compression: a codebook for each part of the vectors, fitted by Lloyd's iteration over two trees.

Components are scaled to whole numbers and vectors cut into parts. Each task gathers its vectors in blocks and builds, once,
a tree over each part of a block, with the sums of the points before each leaf; blocks are stored in the shared folder.
A round walks the pairs of nodes of these trees and of a tree over the codebook's entries (``trees.assign``): a node whose
points can only have one nearest entry adds its cached sum to that entry, the points of other leaves are compared one by one.
All arithmetic is in whole numbers, so the result depends neither on blocks nor on the order of rows.

What a task sends back of a round is a sum and a count for each entry; the driver holds the codebooks and nothing that grows
with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm import trees
from tillscope.llm.stored import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 2048
LEAF = 16


@dataclass(frozen=True)
class Codes:
    """rows: ``vec_id, label, code, error`` for each kept vector; codebooks: an array of entries for each part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for x in book.ravel()).encode()).hexdigest()


def greatest_component(width: int) -> int:
    """Up to this magnitude squared distances of vectors of ``width`` components fit 64 bits."""
    bound = 1
    while width * (4 * bound) ** 2 < 1 << 63:
        bound *= 2
    return bound


def _sound(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | F.abs(x).eqNullSafe(F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    """Equal consecutive parts; where the width is no multiple, the first ones take one component more."""
    edges = [0]
    for k in range(parts):
        edges.append(edges[-1] + width // parts + (k < width % parts))
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the narrowest type that holds them."""
    for kind in (np.int16, np.int32):
        if not values.size or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def _packed(values: np.ndarray) -> dict:
    values = _narrow(values)
    return {"size": values.itemsize, "cells": values.tobytes()}


def _unpacked(cell: dict, width: int | None = None) -> np.ndarray:
    values = np.frombuffer(cell["cells"], f"<i{cell['size']}").astype(np.int64)
    return values if width is None else values.reshape(-1, width)


CELLS = "struct<size:int,cells:binary>"
TREE = f"struct<points:{CELLS},order:{CELLS},low:{CELLS},high:{CELLS},sums:{CELLS}>"
_ARROW_CELLS = pa.struct([("size", pa.int32()), ("cells", pa.binary())])
_ARROW_TREE = pa.struct([(name, _ARROW_CELLS) for name in ("points", "order", "low", "high", "sums")])


def _block(vectors: np.ndarray, bounds: Sequence[tuple[int, int]], leaf: int) -> list[dict]:
    out = []
    for first, last in bounds:
        points = vectors[:, first:last]
        tree = trees.build(points, leaf)
        cells = (points[tree.order], tree.order, tree.low, tree.high, tree.sums)
        out.append({name: _packed(x) for name, x in zip(("points", "order", "low", "high", "sums"), cells)})
    return out


def _blocks(rows: DataFrame, bounds: Sequence[tuple[int, int]], block: int, leaf: int) -> DataFrame:
    """``vec_ids, labels, parts`` for each block of rows of ``vec_id, label, numbers``."""
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= block:
                table = pa.Table.from_batches(waiting)
                yield _block_row(table.slice(0, block), bounds, leaf)
                waiting = table.slice(block).to_batches()
        if sum(b.num_rows for b in waiting):
            yield _block_row(pa.Table.from_batches(waiting), bounds, leaf)

    return rows.mapInArrow(gathered, f"vec_ids array<{id_kind}>, labels array<{label_kind}>, parts array<{TREE}>")


def _block_row(table: pa.Table, bounds: Sequence[tuple[int, int]], leaf: int) -> pa.RecordBatch:
    numbers = table.column("numbers").combine_chunks()
    vectors = numbers.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, -1)
    ids, labels = table.column("vec_id").combine_chunks(), table.column("label").combine_chunks()
    lists = [pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), x) for x in (ids, labels)]
    return pa.RecordBatch.from_arrays(
        [*lists, pa.array([_block(vectors, bounds, leaf)], pa.list_(_ARROW_TREE))], names=["vec_ids", "labels", "parts"]
    )


def _read_part(cells: dict, width: int) -> tuple[np.ndarray, trees.Tree]:
    tree = trees.Tree(_unpacked(cells["order"]), *(_unpacked(cells[c], width) for c in ("low", "high", "sums")))
    return _unpacked(cells["points"], width), tree


def _means(blocks: DataFrame, books: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    """One round: ``part, entry, place, floored mean`` of the entries that have points."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry_trees = [trees.build(book, 1) for book in books]
        sums, counts = [np.zeros_like(book) for book in books], [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            for parts in batch.column("parts"):
                for k, cells in enumerate(parts.as_py()):
                    points, tree = _read_part(cells, books[k].shape[1])
                    found = trees.assign(points, tree, books[k], entry_trees[k])
                    cut = trees.ranges(len(points), tree.depth)[found.nodes]
                    np.add.at(sums[k], found.whole, tree.sum_of(found.nodes))
                    np.add.at(counts[k], found.whole, cut[:, 1] - cut[:, 0])
                    np.add.at(sums[k], found.single, points[found.places])
                    np.add.at(counts[k], found.single, 1)
        rows = [(k, e, int(c[e]), s[e].tolist()) for k, (s, c) in enumerate(zip(sums, counts)) for e in np.flatnonzero(c).tolist()]
        columns = list(zip(*rows)) if rows else [()] * 4
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "entry", "n", "sums"])

    told = blocks.select("parts").mapInArrow(summed, "part int, entry int, n long, sums array<long>")
    places = told.select("part", "entry", "n", F.posexplode("sums").alias("place", "value"))
    totals = places.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(20,0)")).alias("total")
    )
    return [(r["part"], r["entry"], r["place"], int(r["total"]) // r["n"]) for r in totals.collect()]


def _encoded(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of all vectors under fixed codebooks."""
    id_kind, label_kind = (blocks.schema[c].dataType.elementType.simpleString() for c in ("vec_ids", "labels"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry_trees = [trees.build(book, 1) for book in books]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = batch.column("vec_ids")[row].values, batch.column("labels")[row].values
                codes, errors = np.zeros((len(ids), len(books)), np.uint8), np.zeros(len(ids), np.int64)
                for k, cells in enumerate(batch.column("parts")[row].as_py()):
                    points, tree = _read_part(cells, books[k].shape[1])
                    found = trees.assign(points, tree, books[k], entry_trees[k])
                    entry = np.zeros(len(points), np.int64)
                    for (first, last), e in zip(trees.ranges(len(points), tree.depth)[found.nodes], found.whole):
                        entry[first:last] = e
                    entry[found.places] = found.single
                    codes[tree.order, k] = entry
                    apart = points - books[k][entry]
                    errors[tree.order] += (apart * apart).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([c.tobytes().hex() for c in codes]), pa.array(errors)],
                    names=["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(coded, f"vec_id {id_kind}, label {label_kind}, code string, error long")


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block: int = BLOCK,
    leaf: int = LEAF,
) -> Codes:
    """Codebooks and codes of all sound vectors.

    A component x becomes floor(``scale`` * x). The codebook of a part starts as that part of the vectors with the
    ``entries`` smallest ids (nulls last; of equal ids the smaller vector first), fewer if there are fewer vectors. In each
    of ``rounds`` rounds all parts are assigned to their nearest entry, ties to the lower index, and an entry becomes the
    floored mean of its points; an entry without points stays. Up to 256 entries.

    Dropped: null and empty vectors, those with a null or non-finite component, those of another length than the vector with
    the smallest id, and those with a component too large for 64-bit squared distances (``greatest_component``: over
    32,768 at 64 components and the usual scale). Null ids and labels are kept, repeated rows too; an empty table
    gives empty rows and empty codebooks; other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"1 to 256 entries, got {entries}")
    chosen = vectors.select(F.col(id_column).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    sound = chosen.where(_sound(F.col("vector")))
    numbers = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    first = sound.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("width")).first()
    if first is None:
        none = sound.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(none, [])
    bounds = _part_bounds(first["width"], parts)
    greatest = greatest_component(first["width"]) / scale
    small = ~F.exists("vector", lambda x: F.abs(x) > F.lit(greatest).cast("double"))
    rows = sound.where((F.size("vector") == first["width"]) & small).select("vec_id", "label", numbers.alias("numbers"))
    blocks = stored(_blocks(rows, bounds, block, leaf))
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).collect()
    start = np.array([r["numbers"] for r in seeds], np.int64).reshape(len(seeds), first["width"])
    books = [start[:, a:b].copy() for a, b in bounds]
    for _ in range(rounds):
        for part, entry, place, value in _means(blocks, books):
            books[part][entry, place] = value
    return Codes(_encoded(blocks, books), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with an equal label, nulls together."""
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"]), "left").drop("_label")
