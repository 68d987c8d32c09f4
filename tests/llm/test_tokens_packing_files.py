import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from missivelake.llm import grammar_ids, packing, tokens

TEXTS = [
    "a b, c.\nFoo\nBar, éà. ñÑ", "İstanbul Straße, ÀÉ! x", "don't it's.", " lead", "trail ", "a\n\nb", "a\r\nb", "ΣΑΣ ΣΑΣ", "", "  ", "\n", "it's  we'll don 't <|endoftext|> x",
    "é a\u0085b", "日本 語", "x\u0301 y", "A\x1cB c", "(058) 12-34 a1b2 $$$ &&& x&&& ''s 's", "ĊĠ Ċ x\x01y",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    e = tokens.PieceEncoder(tokens.default_path(name), max_pieces=50)
    rng = random.Random(0)
    texts = TEXTS + [" ".join(rng.choice("The of nd,ing. Été x9 ***\n".split(" ")) for _ in range(60)) for _ in range(30)]
    for _ in range(2):
        for text, found in zip(texts, e.encode(texts), strict=True):
            assert np.frombuffer(found, "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB é,.'!1 \n\t", max_size=30), max_size=5))
def test_encoder_on_any_text(texts):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = tokens.encoder(tokens.default_path(name))
        for text, found in zip(texts, e.encode(texts), strict=True):
            assert np.frombuffer(found, "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=60), st.integers(1, 9))
def test_differencing_is_a_partition(sizes, ways):
    groups = packing.differencing(sizes, ways)
    assert sorted(k for g in groups for k in g) == list(range(len(sizes))) and len(groups) <= ways


def test_differencing_balances():
    rng = random.Random(1)
    sizes = [rng.randint(1, 512) for _ in range(400)]
    sums = [sum(sizes[k] for k in g) for g in packing.differencing(sizes, 20)]
    assert max(sums) - min(sums) <= 20
    windows = packing.near_equal_windows(sizes, 2048)
    assert all(sum(sizes[k] for k in g) <= 2048 for g in windows)
    assert packing.near_equal_windows([], 10) == []
    assert len(packing.near_equal_windows([6, 6, 6], 10)) == 3  # two windows would exceed the capacity


ROWS = [(3, "one two three. " * 900), (1, None), (2, ""), (9, "héllo wörld"), (None, "no id"), (9, "again the same id")]


def test_packing_places_every_id_once(spark, docs_of):
    path = tokens.default_path("word_bpe_49k.json")
    e = tokens.encoder(path)
    rng = random.Random(4)
    rows = ROWS[:4] + [(100 + k, " ".join(rng.choice(["alpha", "beta", "gamma,"]) for _ in range(rng.randint(0, 700)))) for k in range(200)]
    whole = {i: np.frombuffer(e.encode([t or ""])[0] + b"\x01\0\0\0", "<u4") for i, t in rows}
    pieces = packing.pack(docs_of(rows)).collect()
    by_doc, by_window = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4")
        assert len(ids) == p["length"] and p["doc_tokens"] == len(whole[p["doc_id"]])
        by_doc.setdefault(p["doc_id"], []).append((p["start"], ids))
        by_window.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, parts in by_doc.items():
        parts.sort(key=lambda x: x[0])
        assert np.concatenate([x for _, x in parts]).tolist() == whole[i].tolist()
        assert [s for s, _ in parts] == np.cumsum([0, *[len(x) for _, x in parts]])[:-1].tolist()
    for parts in by_window.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        assert sum(n for _, n in parts) <= 2048
    assert set(by_doc) == {i for i, _ in rows}
    assert packing.pack(docs_of([])).count() == 0
    assert packing.pack(docs_of(ROWS)).select("doc_id").distinct().count() == 5


def test_shards_round_trip(spark, docs_of):
    e = tokens.encoder(tokens.default_path("byte_bpe_50k.json"))
    rng = random.Random(4)
    rows = ROWS + [(1000 - k, " ".join(rng.choice(["alpha", "beta", "gamma,"]) for _ in range(rng.randint(0, 300)))) for k in range(120)]
    table = grammar_ids.shards(docs_of(rows), shard_ids=2000)
    assert table.count() > 5
    got = grammar_ids.read_documents(table).collect()
    assert len(got) == len(rows)
    wanted = sorted((-1 if i is None else i, np.frombuffer(e.encode([t or ""])[0] + b"\0\0\0\0", "<u4").tolist()) for i, t in rows)
    at = 0
    found = sorted(got, key=lambda r: r["start"])
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in found] == [i for i, _ in wanted]
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in got) == wanted
    assert grammar_ids.round_trip(docs_of([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=80), min_size=1, max_size=8), st.sampled_from([0, 70000]))
def test_shard_random_access(documents, shift):
    ids = np.array([x + shift for d in documents for x in d], np.uint32)
    lengths = np.array([len(d) for d in documents])
    shard = grammar_ids.Shard(grammar_ids.compress(np.tile(ids, 20), np.tile(lengths, 20), np.arange(20 * len(documents)), 5))
    assert shard.all().tolist() == ids.tolist() * 20
    assert shard.ids(len(documents)).tolist() == [x + shift for x in documents[0]]
    n = len(ids) * 20
    for s, e in ((0, n), (n // 3, n // 2), (n - 1, n), (5, 5)):
        if s <= e <= n:
            assert shard.span(s, e).tolist() == (ids.tolist() * 20)[s:e]
    assert grammar_ids.crc32(b"abc") == zlib.crc32(b"abc")


def pair_counts(seq, ends):
    """Occurrences of each pair that do not overlap, within documents."""
    counts, before = Counter(), {}
    for k in range(len(seq) - 1):
        pair = (seq[k], seq[k + 1])
        if k + 1 not in ends and before.get(pair, -2) != k - 1:
            counts[pair] += 1
            before[pair] = k
    return counts


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=60), min_size=1, max_size=12), st.integers(2, 6))
def test_repair_leaves_no_frequent_pair(documents, least):
    ids = np.array([x for d in documents for x in d], np.uint32)
    ends = np.cumsum([len(d) for d in documents])
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    before = pair_counts(ids.tolist(), set(ends.tolist()))
    seq, marks, rules = grammar_ids.repair(ids.copy(), last, 5, least)
    assert max(pair_counts(seq.tolist(), set((np.flatnonzero(marks) + 1).tolist())).values(), default=0) < least
    assert marks.sum() == len(documents)
    if len(rules):  # the first rule is a most frequent pair
        assert before[tuple(rules[0].tolist())] == max(before.values()) >= least
    shard = grammar_ids.Shard(grammar_ids.compress(ids, np.diff([0, *ends]), np.arange(len(ends)), least))
    assert [shard.ids(k).tolist() for k in range(len(ends))] == documents


def test_repair_of_a_whole_shard(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = grammar_ids.shards(docs.repartition(1)).collect()
    assert sum(r["n_ids"] for r in rows) > 500_000
    for r in rows:
        shard = grammar_ids.Shard(bytes(r["blob"]))
        assert max(pair_counts(shard.seq.tolist(), set(shard.firsts[1:].tolist())).values()) < grammar_ids.LEAST_COUNT
        assert len(shard.seq) < 0.65 * r["n_ids"] and shard.size.max() > 16


def test_wide_symbols(spark):
    rng = np.random.default_rng(0)
    words = rng.integers(0, 65_000, (3000, 3)).astype(np.uint32)
    ids = words[rng.integers(0, 3000, 40_000)].ravel()
    blob = grammar_ids.compress(ids, np.array([len(ids)]), np.array([1]))
    assert blob[:4] == b"MLG3" and grammar_ids.Shard(blob).all().tolist() == ids.tolist()


def test_grammar_pays(spark):
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    blob = grammar_ids.compress(ids, np.array([len(ids)]), np.array([1]), 6)
    assert len(blob) < len(ids) and len(grammar_ids.Shard(blob).rules) > 20
