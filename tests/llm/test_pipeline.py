import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from missivelake.llm import simhash, tokens
from missivelake.llm.common import written


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted cases of every stage."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["the", "of", "an", "ing", "er", "re", "tion", "at"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(40)) for k in range(5)]
    base = [text(300) for _ in range(30)]
    rows = [(k, t, "en", f"s{k % 3}") for k, t in enumerate(base)]
    rows += [(100 + k, base[k], "en", "s0") for k in range(5)]  # exact copies: the larger id stays
    for k in range(5, 10):  # near copies: the smaller id stays
        words = base[k].split()
        words[150] = "changed"
        rows.append((200 + k, " ".join(words), "en", "s1"))
    rows += [(300 + k, text(60) + " " + items[k][1] + " " + text(60), "en", "s2") for k in range(5)]
    rows += [(400, None, "en", "s0"), (401, "123 456", "en", "s0"), (402, "", None, None)]
    out = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_keep_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema = docs.schema
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    clean = set(range(30)) | {300 + k for k in range(5)}
    wanted = {
        "language": ids(docs) - {400, 401, 402},
        "exact": (clean - set(range(5))) | {100 + k for k in range(5)} | {200 + k for k in range(5, 10)},
    }
    wanted["near"] = wanted["exact"] - {200 + k for k in range(5, 10)}
    wanted["benchmark_free"] = wanted["near"] - {300 + k for k in range(5)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "test-stage")
        assert docs.schema == schema
        assert ids(docs) == wanted[name], name
    e = tokens.encoder(tokens.default_path("word_bpe_49k.json"))
    sizes = {r["doc_id"]: len(e.encode([r["text"]])[0]) // 4 + 1 for r in docs.collect()}
    pieces = corpus_pipeline.run(spark, folder).groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).collect()
    assert {r["doc_id"]: r["n"] for r in pieces} == sizes == {r["doc_id"]: r["t"] for r in pieces}


def test_near_copies_are_similar(spark, folder):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for k in range(5, 10):
        a, b = (set(simhash.shingle_hashes(rows[i], 5).tolist()) for i in (k, 200 + k))
        assert len(a & b) / len(a | b) >= 0.8
    a, b = (set(simhash.shingle_hashes(rows[i], 5).tolist()) for i in (20, 21))
    assert len(a & b) / len(a | b) < 0.1


def test_empty_corpus(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    from missivelake.llm import queries

    names = [q.split("_")[0] for q in queries.QUERIES]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert np.all([callable(q) for q in queries.QUERIES.values()])
