import random
from fractions import Fraction

import pytest

import corpus_pipeline
from missivelake.llm import near_copies


def texts_around(rng, n):
    return ["w%d" % rng.randrange(10**6) for _ in range(n)]


def brute(rows, similarity=Fraction(4, 5)):
    """Components over all pairs of at least the similarity, by comparing every two documents."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def groups(docs_of, rows):
    return {r["doc_id"]: r["component_id"] for r in near_copies.similar_dedup(docs_of(rows)).collect()}


def test_texts_around_one_passage_do_not_chain(spark, docs_of):
    rng = random.Random(1)
    passage = texts_around(rng, 320)
    rows = []
    for k in range(150):
        own = texts_around(rng, 70)
        rows.append((k, " ".join(passage + own)))
        rows.append((1000 + k, " ".join(passage + own[:-1] + ["changed"])))
    assert groups(docs_of, rows) == {i: i % 1000 for i, _ in rows}
    kept = corpus_pipeline.near(spark, docs_of(rows), "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(150))


def test_appended_and_block_edited_copies_are_found(docs_of):
    rng = random.Random(2)
    rows = []
    for k in range(60):
        words = texts_around(rng, 300)
        at = rng.randrange(260)
        rows.append((k, " ".join(words)))
        if k % 2:
            rows.append((1000 + k, " ".join(words + texts_around(rng, 72))))  # 296 of 368 shingles: 0.804
        else:
            rows.append((1000 + k, " ".join(words[:at] + texts_around(rng, 28) + words[at + 28 :])))
    assert groups(docs_of, rows) == brute(rows) == {i: i % 1000 for i, _ in rows}


@pytest.mark.parametrize("paired", [64, 4])
def test_large_keys_equal_brute_force(docs_of, monkeypatch, paired):
    monkeypatch.setattr(near_copies, "PAIRED", paired)
    monkeypatch.setattr(near_copies, "BLOCK", paired)
    rng = random.Random(paired)
    rows = [(900, ""), (901, None), (902, "one two"), (903, "ONE two"), (None, "one two")]
    passage = texts_around(rng, 60)
    for k in range(20):  # copies of copies around one passage, below and above the similarity
        words = passage + texts_around(rng, rng.choice([6, 8, 14, 25]))
        for j in range(6):
            rows.append((20 * k + j, " ".join(words)))
            words = list(words)
            words[rng.choice([0, 30, len(words) - 1])] = "changed%d" % rng.randrange(10**6)
    got = groups(docs_of, rows)
    assert got == brute([(i, t or "") for i, t in rows if i is not None])
    assert len(set(got.values())) > 3
