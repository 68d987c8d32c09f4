import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from missivelake.llm import exact_dedup, line_dedup

LONG = "".join(f"word{k} and more, é\n" for k in range(3000))
ROWS = [(1, "a b"), (2, "a b"), (3, "a b "), (4, ""), (5, None), (6, LONG), (7, LONG), (8, LONG + "x"), (None, "a b"), (9, "x" * 20000), (10, "x" * 20000)]


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup_equals_brute_force(docs_of, collide):
    hashed = (lambda c: F.pmod(F.xxhash64(c), F.lit(3))) if collide else exact_dedup.chunk_hash
    got = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs_of(ROWS), hashed=hashed).collect()}
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    for i, t in ROWS:
        ids = groups[t or ""]
        most = max((x for x in ids if x is not None), default=None)
        assert got[i, sha(t)] == (most, len(ids), i == most)
    assert len(got) == len(ROWS)


def test_many_collided_hashes_compare_all_chunks(docs_of, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_LISTED", 0)
    got = exact_dedup.exact_dedup(docs_of(ROWS), hashed=lambda c: F.lit(1).cast("long"))
    assert sorted(r["group_size"] for r in got.collect()) == [1, 1, 2, 2, 2, 2, 2, 2, 3, 3, 3]


def test_chunks_join_to_the_text(spark, docs_of):
    parts = docs_of(ROWS).select("doc_id", "text", F.array_join(exact_dedup.chunks(F.coalesce("text", F.lit(""))), "").alias("back"), F.size(exact_dedup.chunks(F.coalesce("text", F.lit("")))).alias("n"))
    for r in parts.collect():
        assert r["back"] == (r["text"] or "")
        assert (r["n"] > 1) == (len(r["text"] or "") > 8192)


def test_a_shift_changes_few_chunks(docs_of):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefnorstuxyz") for _ in range(rng.randint(2, 8))) for _ in range(9000))
    a, b = (set(r[0]) for r in docs_of([(1, text), (2, "shift " + text)]).select(exact_dedup.chunks(F.col("text"))).collect())
    assert len(a & b) >= len(a) - 8


def test_drop_copies_keeps_columns_and_ids(docs_of):
    kept = exact_dedup.drop_copies(docs_of(ROWS))
    assert kept.columns == docs_of(ROWS).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 7, 8, 10]
    repeated = [(1, "a"), (1, "a"), (0, "a"), (None, "b"), (None, "b"), (2, "c"), (2, None), (2, "c"), (3, "")]
    kept = exact_dedup.drop_copies(docs_of(repeated))
    assert kept.columns == docs_of([]).columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "a"), (None, "b"), (2, "c"), (3, "")], key=str)


def test_empty_and_repeated(docs_of):
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0
    rows = exact_dedup.exact_dedup(docs_of([(1, "a"), (1, "a")])).collect()
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in rows] == [(1, 2, True)] * 2
    assert line_dedup.line_dedup(docs_of([])).count() == 0


WHITE = " \t\n\x0b\x0c\r"


def brute_lines(rows, least=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= least and max(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup_equals_brute_force(docs_of):
    rng = random.Random(3)
    lines = [f"{'ÀbC' * 13}{k}" for k in range(6)] + ["short", "", " pad " + "Q" * 40 + "\t", "q" * 40, "ſ" * 40, "é" * 39]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for k in range(60)] + [(100, None), (101, ""), (102, "\n" * 3), (103, "\n".join(["Q" * 40] * 3000))]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.line_dedup(docs_of(rows)).collect()}
    assert got == brute_lines(rows)


def test_bitmaps_are_runs(docs_of):
    line = "z" * 40
    rows = [(k, f"a\n{line}\n{line}\nb") for k in range(5)]
    maps = {r["doc_id"]: (r["n_dropped"], [tuple(x) for x in r["keep_runs"]]) for r in line_dedup.keep_bitmaps(docs_of(rows)).collect()}
    assert maps == {k: (2, [(1, 1), (4, 1)]) for k in range(4)}


def test_lines_with_null_ids(docs_of):
    line = "z" * 41
    rows = [(k, line) for k in range(5)] + [(None, line)]
    got = [(r["doc_id"], r["n_dropped"]) for r in line_dedup.line_dedup(docs_of(rows)).collect()]
    assert sorted(got, key=str) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 0), (None, 0)]
    assert {r["n_dropped"] for r in line_dedup.line_dedup(docs_of(rows[1:])).collect()} == {0}


LINE = "y" * 44
REPEATED = {
    "one id, different texts": [(1, f"{LINE}\n{k}") for k in range(5)] + [(0, LINE)],
    "identical rows": [(1, LINE)] * 6 + [(0, LINE)],
    "five ids, some repeated": [(k % 5, f"{LINE}\n{k}") for k in range(12)] + [(4, f"{LINE}\n4")],
}


@pytest.mark.parametrize("name", REPEATED)
def test_lines_of_repeated_rows_agree_with_the_sql(spark, docs_of, tmp_path, name):
    import duckdb

    from missivelake.llm import queries

    docs_of(REPEATED[name]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = sorted(db.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({queries.ORACLES['op6_line_dedup']})").fetchall())
    got = queries.QUERIES["op6_line_dedup"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == wanted
    assert (sum(x[2] for x in wanted) > 0) == (name == "five ids, some repeated")


def test_first_occurrences_are_streamed_from_sorted_ranges(spark, docs_of):
    rows = docs_of([(k, f"{LINE}\n{LINE}") for k in range(9)])
    with line_dedup.setting(spark, "spark.sql.execution.replaceHashWithSortAgg", "true"):
        plan = line_dedup.run_heads(line_dedup._occurrences(rows, "text", 40), 5)._jdf.queryExecution().executedPlan().toString()
    ours = plan[plan.index("hashpartitioning") : plan.index("rangepartitioning")]
    # One sort, by hash, document and position; both groupings stream its rows.
    assert ours.count("Sort [") == 1 and "pos#" in ours[ours.index("Sort [") :].split("]")[0]
    assert ours.count("SortAggregate(") == 2 and "HashAggregate(" not in ours
    heads = line_dedup.run_heads(line_dedup._occurrences(rows, "text", 40), 5).collect()
    assert [(r["first_doc"], r["first_pos"], r["n_docs"]) for r in heads] == [(8, 0, 9)]


