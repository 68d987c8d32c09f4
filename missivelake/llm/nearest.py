"""Approximate nearest neighbours by cosine: low-dimensional stable projections indexed by kd-trees.

Unit vectors are projected onto ``DIMS`` Gaussian directions.  A squared projected distance is the squared distance times a
chi-square variable of ``DIMS`` degrees of freedom, so a query may stop once the next projected distance exceeds its distance to
the last neighbour kept times the ``SURE`` quantile: a true neighbour lies beyond with a chance of 1 - ``SURE`` only.

1. Equal vectors become one class with its ``k`` + 1 smallest ids, so that a vector that a third of all rows have is searched once.
2. The top of the kd-tree is fitted on ``SAMPLE`` classes of smallest hash and cuts all classes into at most ``CELLS`` cells; a cell
   of more than ``UNIT`` classes is dealt into several units.  Every class is indexed: counts and boxes of cells cover all of them.
3. Each unit is the lower part of the tree in one task.  Queries first search their own unit, leaf by leaf by rising distance.
4. Those whose stopping test does not hold yet go, packed in blocks, to the units of the cells that are within reach, and go on
   there from the distance they have.  Units beyond reach are not visited.  No cap is set on units or candidates.
5. The best classes of each query are merged and replaced by their ids.

Scores are cosines of the original vectors in double precision; ties go to the smaller vec_id.

Defined results: rows with a null vec_id, and vectors that are null, empty, zero or hold null or non-finite components, take no part.
Cosine needs equal lengths: vectors whose length is not the most frequent of the sample take no part either.  Equal rows
count once.  Different vectors of one vec_id are candidates, and queries, of their own; a query never finds its own vec_id, so that
such an id may find fewer than ``k``.  With fewer candidates all are found.  An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, rows_of_finite, small_batches, written

K, DIMS, SURE, SEED = 5, 8, 0.97, 11
#: Classes that the top of the tree is fitted on, classes aimed at in a cell, most cells, most classes in a unit.
SAMPLE, CELL, CELLS, UNIT = 20_000, 1024, 1024, 1 << 16
#: Queries that meet a unit in one task; with more, the unit's classes are sent once for each such block.
QUERIES = 1 << 15
#: Classes in a leaf.
LEAF = 64
#: Rounding allowed before exact scores are compared.
SLACK = 1e-9
SCHEMA = "query_id long, rank int, vec_id long, score double"
HOME = "a long, b long, home long, embedding array<double>, ca array<long>, cb array<long>, least array<long>, score array<double>"
FOUND = "a long, b long, ca long, cb long, least long, score double"


def quantile(sure: float, dims: int) -> float:
    """The chi-square quantile for an even number of degrees of freedom, by bisection of the closed form."""
    beyond = lambda x: math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if beyond(mid) > 1 - sure else (low, mid)
    return high


def directions(length: int, dims: int = DIMS, seed: int = SEED):
    """The Gaussian directions as a (length, dims) matrix."""
    import numpy as np

    return np.random.default_rng(seed).standard_normal((length, dims))


def rows_of(column):
    """A list column of one length as a matrix of doubles."""
    import numpy as np

    flat = column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def units_of(x):
    """Unit vectors; scaled first where squares would overflow or vanish."""
    import numpy as np

    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosine(x, y):
    """Cosines of rows, in one order of operations whatever stands beside them."""
    import numpy as np

    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        score = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
    odd = ~np.isfinite(score)
    if odd.any():
        score[odd] = (units_of(x[odd]) * units_of(y[odd])).sum(1)
    return score


class Top:
    """The top of the kd-tree as a complete binary tree: node i has a coordinate and a threshold, and children 2i + 1 and 2i + 2."""

    def __init__(self, points, cells: int):
        import numpy as np

        self.depth = max(0, math.ceil(math.log2(max(1, cells))))
        inner = 2**self.depth - 1
        self.axis, self.at = np.zeros(inner, np.int64), np.full(inner, np.inf)
        held = {0: points}
        for i in range(inner):
            p = held.pop(i)
            if len(p) > 1:
                self.axis[i] = int(np.argmax(p.max(0) - p.min(0)))
                self.at[i] = np.median(p[:, self.axis[i]])
            right = p[:, self.axis[i]] > self.at[i]
            held[2 * i + 1], held[2 * i + 2] = p[~right], p[right]

    def cell(self, points):
        import numpy as np

        i = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            i = 2 * i + 1 + (points[np.arange(len(points)), self.axis[i]] > self.at[i])
        return i - (2**self.depth - 1)


def boxes(low, high, points):
    """Squared distances of points (rows) to boxes (columns)."""
    import numpy as np

    total = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        x = points[:, j : j + 1]
        away = np.maximum(np.maximum(low[:, j] - x, x - high[:, j]), 0)
        total += away * away
    return total


class Index:
    """The lower kd-tree of one unit: leaves of at most ``leaf`` rows with their boxes."""

    def __init__(self, vectors, unit, points, least, leaf: int = LEAF):
        import numpy as np

        self.vectors, self.unit, self.least, self.leaves = vectors, unit, least, []
        stack = [np.arange(len(points))]
        while stack:
            ids = stack.pop()
            if len(ids) <= leaf:
                self.leaves.append(ids)
                continue
            p = points[ids]
            ids = ids[np.argsort(p[:, int(np.argmax(p.max(0) - p.min(0)))], kind="stable")]
            stack += [ids[len(ids) // 2 :], ids[: len(ids) // 2]]
        self.low = np.stack([points[i].min(0) for i in self.leaves])
        self.high = np.stack([points[i].max(0) for i in self.leaves])

    def search(self, vectors, unit, points, reached, keep: int, stretch: float):
        """(query, row, score): the ``keep`` best rows of each query that are no worse than the score ``reached`` before.

        Leaves come by rising projected distance, one, then two, four and so on, and before each such step a query whose next leaf is
        farther than its ``keep``-th distance times ``stretch`` stops.
        """
        import numpy as np

        near = boxes(self.low, self.high, points)
        order = np.argsort(near, 1, kind="stable")
        worst = reached.copy()  # score of the keep-th best so far
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        live, at, step = np.arange(len(points)), 0, 1
        while len(live) and at < len(self.leaves):
            reach = np.maximum(2 - 2 * worst, 0) * stretch + SLACK
            live = live[near[live, order[live, at]] <= reach[live]]
            end = min(at + step, len(self.leaves))
            q = np.repeat(live, end - at)
            leaf = order[live, at:end].ravel()
            within = near[q, leaf] <= reach[q]
            q, leaf = q[within], leaf[within]
            by_leaf = np.argsort(leaf, kind="stable")
            q, leaf = q[by_leaf], leaf[by_leaf]
            new = [found]
            for some in np.split(np.arange(len(q)), np.flatnonzero(np.diff(leaf)) + 1) if len(q) else ():
                rows, qs = self.leaves[leaf[some[0]]], q[some]
                i, j = np.nonzero(unit[qs] @ self.unit[rows].T >= worst[qs, None] - SLACK)
                new.append((qs[i], rows[j], cosine(vectors[qs[i]], self.vectors[rows[j]])))
            q, row, score = (np.concatenate(x) for x in zip(*new))
            best = np.lexsort((self.least[row], -score, q))
            q, row, score = q[best], row[best], score[best]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            found = tuple(x[place < keep] for x in (q, row, score))
            last = place == keep - 1
            worst[q[last]] = np.maximum(worst[q[last]], score[last])
            at, step = end, step * 2
        return found


def search(vectors: DataFrame, asked: Column, k: int = K, dims: int = DIMS, sure: float = SURE, sample: int = SAMPLE, cell: int = CELL, unit: int = UNIT, queries: int = QUERIES, leaf: int = LEAF) -> DataFrame:
    """The ``k`` nearest rows of each row for which ``asked`` holds, among all others: see ``SCHEMA``."""
    spark = vectors.sparkSession
    small_batches(spark)
    keep, stretch = k + 1, quantile(sure, dims)
    usable = rows_of_finite(vectors).filter(F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull())
    rows = usable.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(asked, F.lit(False)).alias("asked"), "embedding",
        F.xxhash64("embedding").alias("a"), F.xxhash64(F.lit("second"), "embedding").alias("b"),
    )
    by_class = Window.partitionBy("a", "b").orderBy("vec_id")
    ids = rows.select("a", "b", "vec_id").distinct().withColumn("place", F.row_number().over(by_class)).filter(F.col("place") <= keep)
    merged = rows.groupBy("a", "b").agg(F.first("embedding").cast("array<double>").alias("embedding"), F.min("vec_id").alias("least"), F.max("asked").alias("asked"))
    classes = written(merged, "vector-classes")
    fitted = classes.orderBy("a", "b").limit(sample).select("embedding").collect()  # at most ``sample`` vectors
    if not fitted:
        return spark.createDataFrame([], SCHEMA)
    placed, edges = cells_of(classes, [r.embedding for r in fitted], dims, cell, unit)
    home = written(placed.groupBy("unit").applyInArrow(at_home(dims, keep, stretch, leaf), HOME), "queries-at-home")
    blocks = max(1, -(-home.count() // queries))
    packed = home.mapInArrow(packer(edges, dims, keep, stretch, blocks), "unit long, block int, a binary, b binary, score binary, embedding binary")
    everywhere = placed.select("unit", "a", "b", "least", "embedding", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    away = everywhere.groupBy("unit", "block").cogroup(packed.groupBy("unit", "block")).applyInArrow(elsewhere(dims, keep, stretch, leaf), FOUND)
    own = home.select("a", "b", F.explode(F.arrays_zip("ca", "cb", "least", "score")).alias("x")).select("a", "b", "x.*")
    best = Window.partitionBy("a", "b").orderBy(F.desc("score"), "least")
    nearest = own.union(away).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep)
    named = nearest.join(ids.select(F.col("a").alias("ca"), F.col("b").alias("cb"), "vec_id"), ["ca", "cb"])
    first = Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id")
    few = named.select("a", "b", "score", "vec_id", F.row_number().over(first).alias("place")).filter(F.col("place") <= keep)
    lists = few.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    asking = rows.filter("asked").select("vec_id", "a", "b").distinct().withColumnRenamed("vec_id", "query_id")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = written(asking.join(lists, ["a", "b"]).select("query_id", F.posexplode(others).alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"), "nearest")
    discard(classes, home)
    return out


def cells_of(classes: DataFrame, fitted: list, dims: int, cell: int, unit: int):
    """(classes with the unit they are in, {"low", "high", "first", "units"} of the cells that have classes)."""
    from collections import Counter

    import numpy as np

    lengths = Counter(len(v) for v in fitted)
    length = max(lengths, key=lambda n: (lengths[n], n))
    rows = classes.filter(F.size("embedding") == length)
    turn = directions(length, dims)
    top = Top(units_of(np.array([v for v in fitted if len(v) == length])) @ turn, min(CELLS, -(-classes.count() // cell)))

    def measure(batches):
        import pyarrow as pa

        n = np.zeros(2**top.depth, np.int64)
        low, high = np.full((len(n), dims), np.inf), np.full((len(n), dims), -np.inf)
        for batch in batches:
            if batch.num_rows:
                points = units_of(rows_of(batch.column(0))) @ turn
                c = top.cell(points)
                n += np.bincount(c, minlength=len(n))
                np.minimum.at(low, c, points)
                np.maximum.at(high, c, points)
        (c,) = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n[c]), pa.array(low[c].tolist(), pa.list_(pa.float64())), pa.array(high[c].tolist(), pa.list_(pa.float64()))], names=["cell", "n", "low", "high"])

    each = rows.select("embedding").mapInArrow(measure, "cell long, n long, low array<double>, high array<double>")
    side = lambda f, name: F.array(*[f(F.col(name)[j]) for j in range(dims)]).alias(name)
    cells = each.groupBy("cell").agg(F.sum("n").alias("n"), side(F.min, "low"), side(F.max, "high")).orderBy("cell").collect()  # at most CELLS rows
    units = np.array([-(-r.n // unit) for r in cells], np.int64)
    edges = {"low": np.array([r.low for r in cells]), "high": np.array([r.high for r in cells]), "units": units, "first": np.cumsum(units) - units, "cell": np.array([r.cell for r in cells])}

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                c = np.searchsorted(edges["cell"], top.cell(units_of(rows_of(batch.column("embedding"))) @ turn))
                dealt = edges["first"][c] + batch.column("b").to_numpy() % edges["units"][c]
                yield pa.RecordBatch.from_arrays([pa.array(dealt), *batch.columns], names=["unit", *batch.schema.names])

    return rows.select("a", "b", "least", "asked", "embedding").mapInArrow(place, "unit long, a long, b long, least long, asked boolean, embedding array<double>"), edges


def at_home(dims: int, keep: int, stretch: float, leaf: int):
    """Searches a unit for its own queries."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        x = rows_of(table.column("embedding"))
        unit = units_of(x)
        points = unit @ directions(x.shape[1], dims)
        a, b, least = (table.column(c).to_numpy() for c in ("a", "b", "least"))
        (asked,) = np.nonzero(table.column("asked").to_numpy(zero_copy_only=False))
        index = Index(x, unit, points, least, leaf)
        q, row, score = index.search(x[asked], unit[asked], points[asked], np.full(len(asked), -np.inf), keep, stretch)
        ends = pa.array(np.searchsorted(q, np.arange(len(asked) + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (a[row], b[row], least[row], score)]
        own = pa.ListArray.from_arrays(pa.array(np.arange(len(asked) + 1, dtype=np.int32) * x.shape[1]), pa.array(x[asked].ravel()))
        home = np.full(len(asked), table.column("unit")[0].as_py(), np.int64)
        return pa.table([pa.array(a[asked]), pa.array(b[asked]), pa.array(home), own, *lists], names=["a", "b", "home", "embedding", "ca", "cb", "least", "score"])

    return run


def packer(edges: dict, dims: int, keep: int, stretch: float, blocks: int):
    """Packs the queries that may still find something in a unit, a row for each unit and batch of queries."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = rows_of(batch.column("embedding"))
            a, b, home = (batch.column(c).to_numpy() for c in ("a", "b", "home"))
            reached = np.array([s[-1] if len(s) == keep else -np.inf for s in batch.column("score").to_pylist()])
            reach = np.maximum(2 - 2 * reached, 0) * stretch + SLACK
            within = boxes(edges["low"], edges["high"], units_of(x) @ directions(x.shape[1], dims)) <= reach[:, None]
            out = []
            for c in np.flatnonzero(within.any(0)):
                for u in range(edges["first"][c], edges["first"][c] + edges["units"][c]):
                    for block in range(blocks):
                        some = within[:, c] & (home != u) & (a % blocks == block)
                        if some.any():
                            out.append((u, block, *[v[some].tobytes() for v in (a, b, reached, x)]))
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["unit", "block", "a", "b", "score", "embedding"])

    return run


def elsewhere(dims: int, keep: int, stretch: float, leaf: int):
    """Searches a unit for a block of queries from other units."""

    def run(classes, asking):
        import numpy as np
        import pyarrow as pa

        if not classes.num_rows or not asking.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5 + [pa.array([], pa.float64())], names=["a", "b", "ca", "cb", "least", "score"])
        x = rows_of(classes.column("embedding"))
        unit = units_of(x)
        turn = directions(x.shape[1], dims)
        a, b, least = (classes.column(c).to_numpy() for c in ("a", "b", "least"))
        index = Index(x, unit, unit @ turn, least, leaf)
        bytes_of = lambda name, kind: np.frombuffer(b"".join(asking.column(name).to_pylist()), kind)
        qa, qb, reached = bytes_of("a", np.int64), bytes_of("b", np.int64), bytes_of("score", np.float64)
        wanted = bytes_of("embedding", np.float64).reshape(len(qa), -1)
        asked = units_of(wanted)
        q, row, score = index.search(wanted, asked, asked @ turn, reached, keep, stretch)
        return pa.table([pa.array(v) for v in (qa[q], qb[q], a[row], b[row], least[row], score)], names=["a", "b", "ca", "cb", "least", "score"])

    return run
