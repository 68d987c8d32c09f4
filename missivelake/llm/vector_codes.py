"""Compressed codes of vectors: one codebook for each of ``parts`` equal parts, trained by rounds of nearest entries and means.

Components become integers, floor(``scale`` * x), so that sums and means are exact and no result depends on the order in which
tasks end.  Each round broadcasts one kd-tree a codebook (at most ``entries`` * length integers, whatever the input).  A task
searches its vectors by branch and bound and keeps one running sum an entry; these integer sums, at most parts * entries rows
a task, are added by a grouped aggregation.  Vectors do not move and are not collected.

The search visits a node whenever its box is not farther than the best entry found, equal bounds included, and an equal
distance takes the lower index.  Rows are kept together: a node is visited once for all rows that come to it first and once
for those that come to it second.

Defined results: rows with a null vector or with null or non-finite components are left out, as are those with a
component beyond +-``MOST`` (their squares would leave 64 bits) and those whose length is not that of the row with the smallest vec_id.
Parts that do not divide the length evenly are filled with zeros.  With fewer than ``entries`` rows there are as many entries as rows.
Repeated rows each count; among rows of one vec_id the smaller vector comes first; a null vec_id comes last.  Labels may be null:
they are one label.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_of_finite, sent, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest component: squares of differences of SCALE times it, summed over a part, and sums over 2^33 rows stay below 2^63.
MOST = 1 << 20
#: Entries in a leaf of a kd-tree.
LEAF = 8


class Tree:
    """A kd-tree over the entries of one codebook: inner nodes have a box each, leaves hold entries by index."""

    def __init__(self, entries, leaf: int = LEAF):
        import numpy as np

        self.entries, self.nodes = entries, []
        stack = [(np.arange(len(entries)), -1, 0)]
        while stack:
            ids, parent, side = stack.pop()
            box = entries[ids]
            lo, hi = box.min(0), box.max(0)
            if parent >= 0:
                self.nodes[parent][2][side] = len(self.nodes)
            inner = len(ids) > leaf and bool((hi > lo).any())
            self.nodes.append((lo, hi, [0, 0] if inner else None, ids))
            if inner:
                order = ids[np.argsort(box[:, int(np.argmax(hi - lo))], kind="stable")]
                half = len(order) // 2
                stack += [(order[half:], len(self.nodes) - 1, 1), (order[:half], len(self.nodes) - 1, 0)]

    def bound(self, node: int, rows):
        """Squared distance of each row to the node's box."""
        import numpy as np

        lo, hi = self.nodes[node][:2]
        away = np.maximum(np.maximum(lo - rows, rows - hi), 0)
        return (away * away).sum(1)

    def nearest(self, rows):
        """(index, squared distance) of the nearest entry of each row, the lower index where distances are equal."""
        import numpy as np

        best, index = np.full(len(rows), np.iinfo(np.int64).max), np.zeros(len(rows), np.int64)
        stack = [(0, np.arange(len(rows)))]
        while stack:
            node, at = stack.pop()
            at = at[self.bound(node, rows[at]) <= best[at]]  # equal bounds may hide a lower index
            if not len(at):
                continue
            _, _, below, ids = self.nodes[node]
            if below is None:
                for k in ids:
                    away = rows[at] - self.entries[k]
                    d = (away * away).sum(1)
                    closer = (d < best[at]) | ((d == best[at]) & (k < index[at]))
                    best[at[closer]], index[at[closer]] = d[closer], k
                continue
            left, right = below
            first = self.bound(left, rows[at]) <= self.bound(right, rows[at])
            near, far = at[first], at[~first]
            stack += [(right, near), (left, near), (left, far), (right, far)]  # the last is taken first
        return index, best


def integers(vectors: DataFrame, scale: int, most: int) -> DataFrame:
    """Rows of (vec_id, label, v): the vector as integers; unusable rows are left out."""
    usable = rows_of_finite(vectors).filter(~F.exists("embedding", lambda x: F.abs(x) > most))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), label, whole.alias("v"))


def matrix(column, parts: int):
    """An Arrow column of integer lists of one length as (rows, parts, width), filled with zeros."""
    import numpy as np

    flat, n = column.flatten().to_numpy(zero_copy_only=False), len(column)
    length = len(flat) // n if n else 0
    width = -(-length // parts)
    if width * parts == length:
        return flat.reshape(n, parts, width)
    out = np.zeros((n, parts * width), np.int64)
    out[:, :length] = flat.reshape(n, length)
    return out.reshape(n, parts, width)


def summed(rows: DataFrame, trees, parts: int) -> DataFrame:
    """(part, entry, count, sums) of the vectors by their nearest entries."""

    def partial(batches):
        import numpy as np
        import pyarrow as pa

        counts = sums = None
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(0), parts)
            if counts is None:
                k = len(trees.value[0].entries)
                counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, v.shape[2]), np.int64)
            for p, tree in enumerate(trees.value):
                index, _ = tree.nearest(v[:, p])
                counts[p] += np.bincount(index, minlength=counts.shape[1])
                np.add.at(sums[p], index, v[:, p])
        if counts is not None:
            p, e = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    each = rows.select("v").mapInArrow(partial, "part long, entry long, n long, sums array<long>")
    place = each.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    return place.groupBy("part", "entry", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """The codebooks as integers (parts, entries, width), or None without rows; ``rows`` as of :func:`integers`."""
    import numpy as np
    import pyarrow as pa

    spark = rows.sparkSession
    seeds = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()  # at most ``entries`` rows
    if not seeds:
        return None
    length = len(seeds[0].v)
    same = [r.v for r in seeds if len(r.v) == length]
    if len(same) < len(seeds):  # other lengths stood among the first
        rows = rows.filter(F.size("v") == length)
        same = [r.v for r in rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()]
    books = np.ascontiguousarray(matrix(pa.array(same, pa.list_(pa.int64())), parts).transpose(1, 0, 2))
    rows = rows.filter(F.size("v") == length)
    for _ in range(rounds):
        trees = spark.sparkContext.broadcast([Tree(b) for b in books])
        for r in summed(rows, trees, parts).collect():  # parts * entries * width sums, whatever the input
            books[r.part, r.entry, r.at] = r.x // r.n
        trees.unpersist()
    return books, length


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, object]:
    """((vec_id, label, code, error), codebooks): a byte a part, and the squared distance summed over the parts."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    rows = integers(vectors, scale, MOST * SCALE // scale)
    trained = train(rows, parts, entries, rounds)
    schema = f"vec_id long, label {dict(rows.dtypes)['label']}, code binary, error long"
    if trained is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    books, length = trained
    trees = vectors.sparkSession.sparkContext.broadcast([Tree(b) for b in books])

    def assign(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), parts)
            found = [tree.nearest(v[:, p]) for p, tree in enumerate(trees.value)]
            codes = np.stack([index.astype(np.uint8) for index, _ in found], 1)
            offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * parts)
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(codes), [None, offsets.buffers()[1], pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), binary, pa.array(sum(d for _, d in found))], names=["vec_id", "label", "code", "error"])

    return rows.filter(F.size("v") == length).mapInArrow(assign, schema), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors summed over equal labels; null labels are one.

    Sums are made before they move.  They go to the rows whole while they are few; with more labels the rows move to them, and
    adaptive execution splits a label that holds very many rows.
    """
    table = written(codes, "vector-codes")
    totals = written(table.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return table.join(sent(totals), table["label"].eqNullSafe(totals["of"]), "left").drop("of")


def digest(books) -> Column:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    text = "" if books is None else ",".join(map(str, books.ravel().tolist()))
    return F.lit(hashlib.sha256(text.encode()).hexdigest())
