"""Nearest neighbours against all pairs; vector codes against plain loops."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from missivelake.llm import nearest, vector_codes
from missivelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, key string, code string, unit long, cell long"


@pytest.fixture(scope="module")
def vectors_of(spark):
    """Builds an embeddings table with extra columns whose names operators also use."""

    def build(rows):
        return spark.createDataFrame([(i, v, label, "x", "y", 1, 2) for i, v, label in rows], SCHEMA)

    return build


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def all_pairs(rows, k=5):
    """Every query against every candidate, scored in double precision."""
    known = sorted({(i, tuple(float(np.float32(x)) for x in v)) for i, v, _ in rows if i is not None and usable(v) and any(v)})
    out = {}
    for i, v in known:
        if i % 50 == 0:
            x = np.array(v)
            scored = [(-(x * np.array(w)).sum() / (np.sqrt((x * x).sum()) * np.sqrt((np.array(w) ** 2).sum())), j) for j, w in known if j != i]
            out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def recall(expected, got):
    """Share of true neighbours, by score, that were found."""
    hit = sum(len({j for j, _ in near} & {j for _, j, _ in got.get(i, [])}) for i, near in expected.items())
    return hit / max(1, sum(map(len, expected.values())))


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_on_whole_tables(spark, size):
    folder = f"/root/testdata/{size}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got, expected = found(QUERIES["op11_nearest"](spark, folder)), all_pairs(rows)
    assert recall(expected, got) >= 0.9
    assert got.keys() == expected.keys()
    x = {i: np.array(v, float) for i, v, _ in rows}
    for i, near in got.items():
        assert [r for r, _, _ in near] == [1, 2, 3, 4, 5] and [(-s, j) for _, j, s in near] == sorted((-s, j) for _, j, s in near)
        for _, j, s in near:
            assert s == pytest.approx(float(x[i] @ x[j] / math.sqrt(x[i] @ x[i]) / math.sqrt(x[j] @ x[j])), abs=1e-12)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((12, 16)) * 4
    return [(i, (middles[i % 12] + rng.standard_normal(16)).astype(float).tolist(), i % 3) for i in range(n)]


def test_many_cells_units_and_blocks(vectors_of):
    """Small cells, units and blocks of queries: most cells are out of reach, and none that matters is missed."""
    rows = clustered(1500, 3)
    got = found(nearest.search(vectors_of(rows), F.col("vec_id") % 50 == 0, sample=200, cell=32, unit=20, queries=7, leaf=4))
    assert recall(all_pairs(rows), got) >= 0.9
    assert all(len(x) == 5 for x in got.values()) and len(got) == 30


def test_sure_search_is_exact(vectors_of):
    rows = clustered(400, 5)
    got = found(nearest.search(vectors_of(rows), F.col("vec_id") % 50 == 0, sure=1 - 1e-12, cell=16, leaf=4))
    assert {i: [j for _, j, _ in x] for i, x in got.items()} == {i: [j for j, _ in x] for i, x in all_pairs(rows).items()}


def test_a_third_of_equal_vectors(vectors_of):
    """Copies are searched once, and each query gets the smallest other ids of its own copies."""
    rows = [(i, [1.0, 2.0, 0.5] if i % 3 == 0 else v[:3], 0) for i, v, _ in clustered(600, 7)]
    got = found(nearest.search(vectors_of(rows), F.col("vec_id") % 50 == 0, cell=32, leaf=4))
    assert [j for _, j, _ in got[0]] == [3, 6, 9, 12, 15] and [j for _, j, _ in got[300]] == [0, 3, 6, 9, 12]
    assert recall(all_pairs(rows), got) >= 0.9


def test_ties_and_unusable_vectors(vectors_of):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (50, None, 0), (100, [0.0, 0.0], 0), (1, [2.0, 0.0], 0), (2, [4.0, 0.0], 0), (7, [0.0, 1.0], 0), (3, [8.0, 0.0], 0), (4, [0.5, 0.0], 0)]
    rows += [(5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (8, [None, 1.0], 0), (None, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (150, [], 0), (1, [2.0, 0.0], 0), (10, [1e30, 1e30], 0)]
    got = found(nearest.search(vectors_of(rows), F.col("vec_id") % 50 == 0))
    assert got == {0: [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (4, 4, 1.0), (5, 10, pytest.approx(math.sqrt(0.5), abs=1e-12))]}


def test_few_candidates_and_empty_tables(vectors_of):
    assert found(nearest.search(vectors_of([(0, [1.0], 0), (3, [-1.0], 0)]), F.col("vec_id") % 50 == 0)) == {0: [(1, 3, -1.0)]}
    assert found(nearest.search(vectors_of([(0, [1.0], 0)]), F.col("vec_id") % 50 == 0)) == {}
    assert found(nearest.search(vectors_of([(1, [1.0], 0), (2, [1.0], 0)]), F.col("vec_id") % 50 == 0)) == {}
    empty = nearest.search(vectors_of([]), F.col("vec_id") % 50 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0


def test_quantile():
    assert nearest.quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert nearest.quantile(0.9, 2) == pytest.approx(-2 * math.log(0.1))


def plain_codes(rows, parts, entries, rounds, scale):
    """Every part against every entry of its codebook, in plain loops."""
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v], label) for i, v, label in rows if usable(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    away = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    pick = lambda p, c: min((away(c[p], e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(pick(p, c)[1], []).append(c[p])
            for k, xs in members.items():
                books[p][k] = [sum(x) // len(xs) for x in zip(*xs)]
    out = []
    for (i, _, label), c in zip(kept, cut):
        best = [pick(p, c) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    total = {}
    for _, label, _, error in out:
        total[label] = total.get(label, 0) + error
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, label, code, error, total[label]) for i, label, code, error in out), key=str), hashlib.sha256(text.encode()).hexdigest()


def codes_of(df, **options):
    codes, books = vector_codes.encode(df, **options)
    got = vector_codes.with_label_error(codes).select("vec_id", "label", F.lower(F.hex("code")), "error", "label_error", vector_codes.digest(books)).collect()
    return sorted((tuple(r)[:5] for r in got), key=str), {r[5] for r in got}


def test_codes_against_plain_loops(vectors_of):
    """Few distinct values give many equal distances; a label may be null."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-3, 4, 12) / 4).tolist(), [0, 1, None][i % 3]) for i in range(400)]
    rows += [(401, None, 0), (402, [float("nan")] * 12, 0), (403, [None] + [0.0] * 11, 1), (404, [float("inf")] * 12, 1)]
    expected, digest = plain_codes(rows, 4, 32, 2, 256)
    assert codes_of(vectors_of(rows), parts=4, entries=32) == (expected, {digest})


@pytest.mark.parametrize("n", [1, 5, 40])
def test_few_and_repeated_vectors_and_uneven_parts(vectors_of, n):
    rng = np.random.default_rng(n)
    rows = [(i // 2, rng.standard_normal(7).tolist() if i % 4 else [0.5] * 7, 0) for i in range(n)]
    expected, digest = plain_codes(rows, 3, 64, 2, 256)
    assert codes_of(vectors_of(rows), parts=3) == (expected, {digest})


def test_codes_of_odd_tables(vectors_of):
    assert codes_of(vectors_of([])) == ([], set())
    assert codes_of(vectors_of([(1, None, 0)])) == ([], set())
    rows = [(1, [1.0] * 16, 0), (2, [2.0] * 15, 0), (3, [1e30] * 16, 0), (None, [3.0] * 16, 0)]  # another length, too large
    got, _ = codes_of(vectors_of(rows))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, "00" * 16, 0), (None, "01" * 16, 0)]


def test_tree_visits_equal_bounds():
    """The lower index of equal entries wins wherever the split puts it."""
    rng = np.random.default_rng(4)
    for _ in range(50):
        entries = rng.integers(-2, 3, (64, 2)).astype(np.int64)
        rows = rng.integers(-4, 5, (200, 2)).astype(np.int64)
        index, distance = vector_codes.Tree(entries, leaf=2).nearest(rows)
        every = ((rows[:, None] - entries[None]) ** 2).sum(2)
        assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()
