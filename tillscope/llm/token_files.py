"""Token ids of a corpus in shard files compressed by Re-Pair grammars.

A shard holds consecutive documents in order of their ids. Its ids are one sequence; pairs of neighbouring symbols that
occur often are replaced by new symbols, again and again. The shard stores the rules, the expansion length of every rule,
the shortened sequence and where documents begin, so a document is decoded alone: sums over expansion lengths find the
symbols that cover it, and only these are expanded.

A round replaces many pairs at once: those that occur at least 1/64 as often as the most frequent one, by falling
frequency, such that no symbol is the left part of one and the right part of another; then occurrences cannot overlap. A
pair of equal symbols is replaced from the left of each run, beside others that do not name its symbol. Rounds go on until
no pair occurs so often that its rule pays.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillscope.llm.tokens import encoder
from tillscope.sources.shared import fresh_folder

END_ID = 0
SHARD_IDS = 1 << 20
#: A rule takes 12 bytes, an occurrence that it replaces frees 4: from four occurrences on it pays.
LEAST_COUNT = 4
#: Pairs of a round occur at least this part as often as its most frequent one. Against 2, it takes a quarter of the time
#: for files larger by half a percent.
ROUND_PART = 64
TABLE_BITS = 20
_MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sIIIII")


@dataclass(frozen=True)
class Shard:
    """base: the first symbol of a rule. rules: the two symbols of each. lengths: ids that each rule stands for.

    starts: where the documents begin, in ids, and the end of the last.
    """

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(_MAGIC, self.base, len(self.rules), len(self.symbols), len(self.starts), 0)
        parts = (self.rules.astype("<u4"), self.lengths.astype("<u4"), self.symbols.astype("<u4"), self.starts.astype("<u8"))
        return head + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def from_bytes(data: bytes) -> Shard:
        magic, base, n_rules, n_symbols, n_starts, _ = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a shard")
        at, parts = _HEAD.size, []
        for kind, n in (("<u4", 2 * n_rules), ("<u4", n_rules), ("<u4", n_symbols), ("<u8", n_starts)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        rules, lengths, symbols, starts = parts
        return Shard(base, rules.reshape(-1, 2), lengths, symbols, starts.astype(np.int64))

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol stands for."""
        sizes = np.ones(len(symbols), np.int64)
        rule = symbols >= self.base
        sizes[rule] = self.lengths[symbols[rule] - self.base]
        return sizes

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        while True:
            rule = symbols >= self.base
            if not rule.any():
                return symbols.astype(np.uint32)
            at = np.cumsum(rule + 1) - 1 - rule
            out = np.empty(at[-1] + 1 + rule[-1], symbols.dtype)
            out[at[~rule]] = symbols[~rule]
            pair = self.rules[symbols[rule] - self.base]
            out[at[rule]], out[at[rule] + 1] = pair[:, 0], pair[:, 1]
            symbols = out

    def ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def document(self, k: int) -> np.ndarray:
        """Ids of document ``k`` of the shard; only the symbols that cover it are expanded."""
        ends = np.cumsum(self.sizes(self.symbols))
        start, end = self.starts[k], self.starts[k + 1]
        first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, end, side="left")
        covered = self.expand(self.symbols[first : last + 1])
        before = int(ends[first - 1]) if first else 0
        return covered[start - before : end - before]


def _packed(symbols: np.ndarray) -> np.ndarray:
    """Each symbol with the one after it, in one number."""
    return (symbols[:-1] << np.int64(32)) | symbols[1:]


def _frequent_pairs(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed pairs that occur at least ``least`` times, most frequent first, and their counts.

    A table of hashed counts leaves out most places before pairs are counted exactly; no pair that is frequent is lost.
    Occurrences of a pair of equal symbols are counted as they can be replaced: half of a run, rounded down.
    """
    pairs = _packed(symbols)
    slot = ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    busy = np.bincount(slot, minlength=1 << TABLE_BITS) >= least
    kept = busy[slot] & _replaceable(symbols)
    found, counts = np.unique(pairs[kept], return_counts=True)
    often = counts >= least
    found, counts = found[often], counts[often]
    order = np.lexsort((found, -counts))
    return found[order], counts[order]


def _replaceable(symbols: np.ndarray) -> np.ndarray:
    """Whether the pair at each place can be replaced: all but every second one in a run of equal symbols."""
    equal = symbols[:-1] == symbols[1:]
    if not equal.any():
        return np.ones(len(equal), bool)
    place = np.arange(len(equal))
    begins = equal & ~np.concatenate(([False], equal[:-1]))
    first = np.maximum.accumulate(np.where(begins, place, 0))
    return ~equal | ((place - first) % 2 == 0)


def _compatible(pairs: np.ndarray) -> np.ndarray:
    """The pairs, in their order, such that no symbol is left in one and right in another; nor both in an equal pair and another."""
    left: set[int] = set()
    right: set[int] = set()
    chosen = []
    for k, pair in enumerate(pairs.tolist()):
        a, b = pair >> 32, pair & 0xFFFFFFFF
        free = a not in left and a not in right if a == b else a not in right and b not in left
        if free:
            left.add(a)
            right.add(b)
            chosen.append(k)
    return pairs[chosen]


def _replace(symbols: np.ndarray, pairs: np.ndarray, first: int) -> np.ndarray:
    """``symbols`` with each of the sorted ``pairs`` replaced by ``first`` plus its place."""
    packed = _packed(symbols)
    at = np.minimum(np.searchsorted(pairs, packed), len(pairs) - 1)
    where = np.flatnonzero((pairs[at] == packed) & _replaceable(symbols))
    out = symbols.copy()
    out[where] = first + at[where]
    kept = np.ones(len(symbols), bool)
    kept[where + 1] = False
    return out[kept]


def compress(ids: np.ndarray, starts: np.ndarray, least: int = LEAST_COUNT) -> Shard:
    """The grammar of a sequence, in which no pair occurs ``least`` times or more any longer."""
    symbols = ids.astype(np.int64)
    base = int(symbols.max()) + 1 if len(symbols) else 1
    rules: list[np.ndarray] = []
    n = 0
    while len(symbols) > 1:
        pairs, counts = _frequent_pairs(symbols, least)
        if not len(pairs):
            break
        chosen = np.sort(_compatible(pairs[counts >= max(least, counts[0] // ROUND_PART)]))
        symbols = _replace(symbols, chosen, base + n)
        rules.append(np.stack((chosen >> np.int64(32), chosen & np.int64(0xFFFFFFFF)), axis=1))
        n += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    lengths = np.ones(n, np.int64)
    done = 0
    for group in rules:  # a rule names symbols of earlier rounds only
        size = np.where(group >= base, lengths[np.maximum(group - base, 0)], 1).sum(axis=1)
        lengths[done : done + len(group)] = size
        done += len(group)
    return Shard(base, table, lengths, symbols, starts)


def write(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    id_column: str = "doc_id",
    text: str = "text",
) -> str:
    """Write shards of all documents in ascending order of their ids; returns the folder, by default a new shared one.

    ``tokenizer`` is a file that every worker reaches. A document is its ids and ``end_id``; a null text is an empty one.
    Null document ids come first; rows of equal id are ordered by a hash of their text, and equal rows lie side by side. A
    shard is closed at the first document end past ``shard_ids`` ids. An empty table gives a folder without shards.
    Shards are rows of Parquet files, so Spark commits them and a task that runs again leaves no trace.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    folder = folder or f"{fresh_folder(docs.sparkSession)}-tokens"

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, serial = encoder(tokenizer).ids, TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        parts, keys, hashes, size, id_type = [], [], [], 0, None

        def take() -> pa.RecordBatch:
            starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            blob = compress(np.concatenate(parts), starts).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int64()), pa.array([serial], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([keys], pa.list_(id_type)), pa.array([hashes[0]], pa.int64()), pa.array([blob], pa.binary())],
                names=["task", "serial", "n_ids", "doc_ids", "first_hash", "shard"],
            )

        for batch in batches:
            id_type = batch.column("doc_id").type
            for key, own, value in zip(batch.column("doc_id"), batch.column("text_hash"), batch.column("text")):
                ids = np.concatenate((encode(value.as_py()), end))
                parts.append(ids)
                keys.append(key.as_py())
                hashes.append(own.as_py())
                size += len(ids)
                if size >= shard_ids:
                    yield take()
                    parts, keys, hashes, size, serial = [], [], [], 0, serial + 1
        if parts:
            yield take()

    chosen = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )
    ordered = chosen.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    written = ordered.mapInArrow(
        shards, f"task long, serial long, n_ids long, doc_ids array<{kind}>, first_hash long, shard binary"
    )
    written.write.parquet(folder)
    return folder


def _shard_starts(shards: DataFrame) -> DataFrame:
    """``task, serial, before``: ids in all shards before each. One window runs over tasks, others inside a task."""
    light = shards.select("task", "serial", "n_ids", F.struct(F.get("doc_ids", F.lit(0)).alias("id"), "first_hash").alias("key"))
    tasks = light.groupBy("task").agg(F.min("key").alias("key"), F.sum("n_ids").alias("n_ids"))
    ahead = Window.orderBy("key", "task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select("task", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("task").orderBy("serial").rowsBetween(Window.unboundedPreceding, -1)
    placed = light.select("task", "serial", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
    return placed.join(offsets, "task").select("task", "serial", (F.col("offset") + F.col("inner")).alias("before"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the shards; ``ids`` are little-endian unsigned 32-bit integers."""
    shards = spark.read.parquet(folder)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard.from_bytes(batch.column("shard")[row].as_py())
                ids, starts = shard.ids().astype("<u4"), shard.starts
                keys = batch.column("doc_ids")[row].values
                before = batch.column("before")[row].as_py()
                data = [ids[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts[:-1] + before), pa.array(np.diff(starts)), pa.array(data, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    placed = shards.join(_shard_starts(shards), ["task", "serial"])
    return placed.select("before", "doc_ids", "shard").mapInArrow(
        documents, f"doc_id {kind}, start long, n_tokens long, ids binary"
    )
