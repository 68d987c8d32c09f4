import random

import pytest

from missivelake.llm import components, simhash, substring_dedup


def brute_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("most", [64, 2])
def test_links_find_every_close_pair(spark, most):
    rng = random.Random(most)
    prints = {}
    for base in [0, (1 << 64) - 1] + [rng.getrandbits(64) for _ in range(12)]:
        for _ in range(8):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            prints[len(prints)] = x
    signed = {x if x < 1 << 63 else x - (1 << 64) for x in prints.values()}
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.links(fps, 2, most).collect()}
    values = sorted(signed)
    wanted = {(a, b) for k, a in enumerate(values) for b in values[k + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    assert got == wanted


def test_near_dedup_of_odd_texts(docs_of):
    text = "the quick brown fox jumps over the lazy dog " * 30
    rows = [(5, text), (3, text.upper()), (9, text + "x"), (4, None), (7, " \t"), (8, ""), (1, "one"), (2, "ONE"), (None, text)]
    got = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_dedup(docs_of(rows)).collect()}
    prints = {i: simhash.fingerprint_of(simhash.shingle_hashes(t or "")) for i, t in rows if i is not None}
    wanted = brute_components(prints)
    for i, t in rows:
        if i is not None:
            assert got[i, prints[i]] == wanted[i]
    assert got[None, prints[5]] == wanted[5]
    assert prints[4] == prints[7] == 0
    assert simhash.near_dedup(docs_of([])).count() == 0


def test_fingerprint_bits_by_definition():
    hashes = simhash.shingle_hashes("A b c\nd e  f")
    assert len(hashes) == 4
    bits = simhash.fingerprint_of(hashes) & (2**64 - 1)
    for k in range(64):
        assert (bits >> k & 1) == (2 * sum(int(h) >> k & 1 for h in hashes) > 4)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_substrings(rows):
    first, out = {}, {}
    cut = {i: [w.decode() for w in substring_dedup.words_of(t)] for i, t in rows}
    for i in sorted(cut):
        for k in range(len(cut[i]) - 12):
            first.setdefault(tuple(cut[i][k : k + 13]), i)
    for i, w in cut.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_substring_dedup_equals_brute_force(docs_of):
    rng = random.Random(5)
    passages = [[f"p{j}w{k}" for k in range(rng.randint(11, 40))] for j in range(8)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 9))]
            p = rng.choice(passages)
            s = rng.randint(0, 4)
            words += p[s : len(p) - rng.randint(0, 4)]
        rows.append((i, "  ".join(words)))
    rows += [(-4, None), (200, ""), (201, "a b"), (202, "x " * 500), (203, "x " * 20), (204, "\t".join(passages[0]))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.substring_dedup(docs_of(rows)).collect()}
    assert got == brute_substrings(rows)


def test_substrings_of_null_and_repeated_ids(docs_of):
    text = " ".join(f"w{k}" for k in range(20))
    got = sorted(((r["doc_id"], r["n_removed"]) for r in substring_dedup.substring_dedup(docs_of([(None, text), (2, text), (2, text), (3, text)])).collect()), key=str)
    assert got == [(2, 0), (2, 0), (3, 20), (None, 0)]
    assert substring_dedup.substring_dedup(docs_of([])).count() == 0


def test_rows_of_one_id_lose_only_their_own_words(docs_of):
    copied, other = " ".join(f"w{k}" for k in range(20)), " ".join(f"u{k}" for k in range(20))
    rows = [(1, copied), (2, copied), (2, other), (2, f"{other} {copied}"), (2, None), (3, other), (3, other)]
    got = sorted(((r["doc_id"], r["kept_text"]) for r in substring_dedup.substring_dedup(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, copied), (2, ""), (2, other), (2, other), (2, ""), (3, ""), (3, "")], key=str)


def test_ranges_follow_from_the_texts(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup, "RANGE_CHARS", 100)
    monkeypatch.setattr(substring_dedup, "TASK_ANCHORS", 40)
    rng = random.Random(9)
    base = [f"w{rng.randrange(9)}" for _ in range(400)]
    rows = [(k, " ".join(base[(s := rng.randrange(390)) : s + rng.randint(0, 90)] + [f"x{k}"] + base[k : k + 20])) for k in range(60)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.substring_dedup(docs_of(rows)).collect()}
    assert got == brute_substrings(rows) and sum(x[1] for x in got.values()) > 0


def test_every_shift_is_covered():
    cover, period = set(substring_dedup.COVER), substring_dedup.PERIOD
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))
    assert substring_dedup.ANCHOR + period - 1 == substring_dedup.WINDOW
