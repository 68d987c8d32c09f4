"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

Each task encodes its documents and packs them in groups of ``group_windows`` windows' worth of ids.  A
document is cut into pieces of at most ``max_piece`` ids.  Starting from one partial partition a piece, the two partials with the
largest imbalance are merged again and again, the fullest windows of one onto the emptiest of the other,
until one near-equal partition is left.  The window count starts at the least that could hold the group
and rises whenever a window would exceed the capacity.  There is no shuffle and nothing global: a window's
id is (partition of the scan, running number), the same when a lost task is run again.

Defined results: a null or empty text has only the end id.  Rows with equal or null doc_ids are packed as
separate documents.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import struct
from heapq import heapify, heappop, heappush
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, whole_text
from .tokens import default_path, encoder

CAPACITY, END_ID = 2048, 1
MAX_PIECE, GROUP_WINDOWS = 512, 128
#: Pieces that a worker's encoder keeps: beside it stand the groups, and what earlier stages keep in the same worker.
ENCODER_PIECES = 200_000
#: A group ends early when its packed ids reach this size, so that long documents do not add up.
GROUP_BYTES = 1 << 25
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Splits the items into ``ways`` near-equal groups; returns item numbers by group.

    A partial partition is its non-empty groups by falling sum; the others are empty groups.
    """
    order = count()
    heap = [(-s, next(order), [(s, k)]) for k, s in enumerate(sizes)]
    heapify(heap)
    while len(heap) > 1:
        x, y = heappop(heap)[2], heappop(heap)[2]
        both = len(x) + len(y) - ways  # groups of x and of y that have to share a window
        if both <= 0:
            merged = x + y
        else:
            alone = len(x) - both
            shared = [(a[0] + b[0], (a[1], b[1])) for a, b in zip(x[alone:], reversed(y[len(y) - both :]))]
            merged = x[:alone] + shared + y[: len(y) - both]
        merged.sort(key=lambda g: -g[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == ways else 0)
        heappush(heap, (-spread, next(order), merged))
    groups: list[list[int]] = []
    for _, tree in heap[0][2] if heap else []:
        items, stack = [], [tree]
        while stack:
            t = stack.pop()
            if isinstance(t, tuple):
                stack.extend(t)
            else:
                items.append(t)
        groups.append(sorted(items))
    return groups


def near_equal_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Differencing into as few windows as hold every group within the capacity."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, ways)
        most = max((sum(sizes[k] for k in g) for g in groups), default=0)
        if most <= capacity:
            return groups
        ways += max(1, ways * (most - capacity) // (4 * capacity))


def cut(tokens: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length) pieces of a document: whole windows, then parts of at most ``max_piece``."""
    pieces, at = [], 0
    while tokens - at >= capacity:
        pieces.append((at, capacity))
        at += capacity
    while at < tokens:
        n = min(max_piece, tokens - at)
        pieces.append((at, n))
        at += n
    return pieces


def pack(docs: DataFrame, path: str | None = None, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, max_piece: int = MAX_PIECE, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """The pieces with their packed ids (little-endian u32) and place: see ``PIECE_SCHEMA``."""
    small_batches(docs.sparkSession)
    path = path or default_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))

    def place(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        to_ids, end = encoder(path, ENCODER_PIECES), struct.pack("<I", end_id)
        part, made = TaskContext.get().partitionId(), 0
        names, packed, held, size = [], [], 0, 0

        def flush():
            nonlocal names, packed, held, size, made
            pieces = [(k, s, n) for k, ids in enumerate(packed) for s, n in cut(len(ids) // 4, capacity, max_piece)]
            whole = [p for p in pieces if p[2] == capacity]
            rest = [p for p in pieces if p[2] < capacity]
            windows = [[p] for p in whole] + [[rest[i] for i in g] for g in near_equal_windows([p[2] for p in rest], capacity)]
            columns = [[] for _ in range(7)]
            for window in windows:
                offset = 0
                for k, start, n in window:
                    row = (names[k], start, n, packed[k][4 * start : 4 * (start + n)], len(packed[k]) // 4, (part << 32) + made, offset)
                    for column, x in zip(columns, row):
                        column.append(x)
                    offset += n
                made += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names, packed, held, size = [], [], 0, 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), to_ids.encode(batch.column(1).to_pylist()), strict=True):
                names.append(name)
                packed.append(ids + end)
                held += (len(ids) // 4 + 1) % capacity
                size += len(ids)
                if held >= group_windows * capacity or size >= GROUP_BYTES:
                    yield flush()
        if names:
            yield flush()

    return rows.mapInArrow(place, PIECE_SCHEMA)
