"""Packing of tokenised documents into windows of near-equal length by multiway differencing.

Documents are cut into full windows and one remainder. Remainders are gathered in blocks as a task reads its rows, and
each block is parted into windows by the Karmarkar-Karp method for many ways: every remainder starts as a partial
partition with one filled place, and the two partial partitions with the largest imbalance are merged with their
imbalances opposed, until one is left. If its fullest window is over the capacity, the block gets one window more.

Blocks are built from rows in the order of reading: nothing is shuffled, no group can grow hot, and a task keeps no more
than a block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1
BLOCK = 512
TASK_BITS = 40


def partition_evenly(sizes: list[int], ways: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``ways`` lists of near-equal sums, by multiway differencing.

    A partial partition is a list of (sum, indices) with the largest sum first; places left out are empty. Merging pairs
    the largest sums of one with the smallest of the other.
    """
    if not sizes:
        return [[] for _ in range(ways)]
    heap = [(-size, i, [(size, (i,))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        shared = max(0, len(a) + len(b) - ways)
        joined = a[: len(a) - shared] + b[: len(b) - shared]
        low_a, low_b = a[len(a) - shared :], b[len(b) - shared :]
        joined += [(x[0] + y[0], x[1] + y[1]) for x, y in zip(low_a, reversed(low_b))]
        joined.sort(reverse=True)
        least = joined[-1][0] if len(joined) == ways else 0
        heapq.heappush(heap, (least - joined[0][0], serial, joined))
        serial += 1
    parts = [list(indices) for _, indices in heap[0][2]]
    return parts + [[] for _ in range(ways - len(parts))]


def pack_block(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of ``sizes``, none over ``capacity``, in the windows of a block."""
    ways = -(-sum(sizes) // capacity)
    while True:
        parts = partition_evenly(sizes, ways)
        if all(sum(sizes[i] for i in part) <= capacity for part in parts):
            return [part for part in parts if part]
        ways += 1


class _Block:
    """Rows of finished pieces, and remainders that wait for their windows."""

    def __init__(self, task: int, capacity: int) -> None:
        self.next_sequence = task << TASK_BITS
        self.capacity = capacity
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        full = len(ids) // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            piece = ids[start : start + self.capacity]
            self.rows.append((doc_id, start, len(piece), piece.tobytes(), len(ids), self.next_sequence, 0))
            self.next_sequence += 1
        if full < len(ids):
            self.waiting.append((doc_id, full, len(ids) - full, ids[full:].tobytes(), len(ids)))

    def pack(self) -> None:
        for part in pack_block([x[2] for x in self.waiting], self.capacity):
            offset = 0
            for i in part:
                self.rows.append((*self.waiting[i], self.next_sequence, offset))
                offset += self.waiting[i][2]
            self.next_sequence += 1
        self.waiting = []

    def take(self, id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 7
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents placed in sequences of at most ``capacity`` ids.

    ``tokenizer`` is a file that every worker reaches. A document is its ids and ``end_id``; a null or empty text is
    ``end_id`` alone. Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` for each piece, ``ids`` as
    little-endian unsigned 32-bit integers. Each row of the input is a document of its own, also where ids or texts repeat
    or ids are null; an empty table has no pieces; other columns are not carried. Sequence ids are unique, not dense.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, state, id_type = encoder(tokenizer).ids, _Block(TaskContext.get().partitionId(), capacity), pa.int64()
        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, value in zip(batch.column("doc_id"), batch.column("text")):
                state.add(doc_id.as_py(), np.append(encode(value.as_py()), np.uint32(end_id)))
                if len(state.waiting) >= block:
                    state.pack()
                if len(state.rows) >= 2 * block:
                    yield state.take(id_type)
        state.pack()
        yield state.take(id_type)

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(
        packed,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
