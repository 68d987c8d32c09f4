import hashlib
import itertools
import math
import random
import re
import statistics
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from missivelake.llm import decontaminate, langid, pii, url_filter


def brute_base(t):
    def luhn(d):
        s = 0
        for k, c in enumerate(reversed(d)):
            x = int(c) * (2 if k % 2 else 1)
            s += x - 9 * (x > 9)
        return s % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@-+ 2(9%é", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute_base(text)


@pytest.mark.parametrize("text", ["0000.1.1.1 001.002.003.0004 256.1.1.1 1.2.3.4.5.6.7.8", "a@b.c@d.e", "4111 1111 1111 1111", "+1 (555) 000-0001", "9" * 5000 + "@", "1." * 3000])
def test_base_spans_of_odd_texts(text):
    assert pii.base_spans(text) == brute_base(text)


def test_pii_spans(docs_of):
    rows = [(1, "mail a@b.com or bob [at] site [dot] org"), (2, None), (3, 'api token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'), (4, "x"), (None, "é 10.0.0.1")]
    rows += [(10 + k, f"call (555) 010-{k:04} now, the key: sk_live_{hashlib.md5(str(k).encode()).hexdigest()}") for k in range(30)]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["is_base"]) for s in r["spans"]] for r in pii.find(docs_of(rows)).collect()}
    assert got[1][0] == ("email", 5, 12, True) and got[2] == [] and got[4] == []
    assert got[None] == [("ip", 2, 10, True)]
    assert [s[0] for s in got[3]] == ["secret"]
    assert ("secret" in {s[0] for s in got[12]}) and len(got) == len(rows)
    assert pii.find(docs_of([])).count() == 0


@pytest.mark.parametrize("length", [20, 200, 201, 5000])
def test_secrets_of_any_length_are_candidates(length):
    text = "token = " + ("aB3_" * length)[:length] + "."
    assert pii.candidates(text, []) == [(8, 4, 8 + length)]


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.5
    patterns = []
    for y in truth:
        ballot = 0
        for right in (0.95, 0.9, 0.6, 0.85, 0.9):
            v = 1 if (rng.random() < right) == bool(y) else -1
            ballot = ballot * 3 + v + 1
        patterns.append((2 * 3**5 + ballot) << pii.FEATURES)
    patterns, n = np.unique(patterns, return_counts=True)
    p, right = pii.estimate(patterns, n.astype(float))
    right, others = right[2], np.delete(right, 2, axis=0)
    assert right[0] > right[2] + 0.2 and abs(right[0] - 0.95) < 0.04
    assert np.allclose(others, 0.8)  # kinds without votes learn nothing from the others
    weights = pii.fit(patterns, n.astype(float))
    assert np.corrcoef(p, 1 / (1 + np.exp(-pii._design(patterns) @ weights)))[0, 1] > 0.9


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id long, url string, host string")


def test_stated_rules_and_parts(spark):
    urls = {
        1: "https://A.Example.NET/en/x?q#f", 2: "http://b.net", 3: "http://b.net/", 4: "http://example.com/de/1", 5: "http://example.org/fr/", 6: "http://xnet/en/", 7: None,
        8: "no scheme", 9: "x://net/?a=://org/fr/", 10: "http://Ä.net:80/", 11: "http://example.net/en/",
    }
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge(pages_of(spark, urls.items()), spark.createDataFrame([], "url string, bad boolean")).collect()}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("b.net", "", None, "allow"), 3: ("b.net", "/", "net/", "block"), 4: ("example.com", "/de/1", "example.com/de/", "block"),
        5: ("example.org", "/fr/", "org/fr/", "allow"), 6: ("xnet", "/en/", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("net", "/", "net/", "block"),
        10: ("Ä.net:80", "/", None, "allow"), 11: ("example.net", "/en/", "example.net/en/", "allow"),
    }


def brute_tokens(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m else ("", "")
    found = ["h=" + x for x in host.split(".") if x] + ["host=" + host] + ["p=" + re.sub("[0-9]+", "#", x) for x in path.split("/") if x]
    q = re.match(r"(?s)^[^?#]*\?([^#]*)", url or "")
    return set(found + ["q=" + x.split("=")[0] for x in (q[1] if q else "").split("&") if x.split("=")[0]])


def brute_rules(labelled, least=5, error=0.05):
    """Every frequent combination of tokens whose lower confidence bound, for as many as were tried, exceeds the share of bad rows."""
    rows = [(brute_tokens(u), bool(b)) for u, b in labelled]
    n, bad = len(rows), sum(b for _, b in rows)
    where = {t: frozenset(k for k, (own, _) in enumerate(rows) if t in own) for own, _ in rows for t in own}
    where = {t: w for t, w in where.items() if least <= len(w) < n}
    same = {t: frozenset(x for x, v in where.items() if v == w) for t, w in where.items()}
    tried = {}
    for own, _ in rows:
        heads = sorted({min(same[t]) for t in own if t in same})
        for size in range(1, len(heads) + 1):
            for chosen in itertools.combinations(heads, size):
                held = frozenset.intersection(*[where[t] for t in chosen])
                hits = sum(rows[k][1] for k in held)
                if hits >= least:
                    tried[frozenset().union(*[same[t] for t in chosen])] = hits, len(held)
    out, z = {}, statistics.NormalDist().inv_cdf(1 - error / max(1, len(tried)))
    for items, (hits, m) in tried.items():
        p = hits / m
        if (p + z * z / (2 * m) - z * (p * (1 - p) / m + z * z / (4 * m * m)) ** 0.5) / (1 + z * z / m) > bad / n:
            out[items] = p
    return out


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(6)
    rows = [f"http://{rng.choice('abc')}.{rng.choice(['pills', 'news'])}.com/{rng.choice(['buy', 'read'])}/{rng.randrange(99)}" for _ in range(400)]
    rows = [(u, "pills" in u and "/buy/" in u) for u in rows]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    mined = {frozenset(r["antecedent"]): r["confidence"] for r in url_filter.mine(labelled).collect()}
    wanted = brute_rules(rows)
    assert mined == pytest.approx(wanted) and mined[frozenset(["h=pills", "p=buy"])] == 1.0
    kept = url_filter.prune([(tuple(sorted(x)), c) for x, c in mined.items()])
    assert len(kept) < len(mined)
    index = url_filter.index_of(kept)
    pages = pages_of(spark, [(k, u) for k, (u, _) in enumerate(rows)] + [(1000, None), (1000, None), (None, rows[0][0])])
    by_index = {r["page_id"]: (r["verdict"], r["confidence"]) for r in url_filter.judge(pages, labelled, rules=()).collect()}
    by_join = {r["page_id"]: (r["verdict"], r["confidence"]) for r in url_filter.judge(pages, labelled, rules=(), max_rules=0).collect()}
    for k, (u, bad) in enumerate(rows):
        brute = max((c for items, c in wanted.items() if items <= brute_tokens(u)), default=None)
        assert by_index[k] == by_join[k] == (("block", pytest.approx(brute)) if brute else ("allow", None))
        assert not bad or by_index[k][0] == "block"
        assert url_filter.match(index, list(brute_tokens(u))) == pytest.approx(brute or 0)
    assert by_index[1000] == by_join[1000] == ("allow", None)
    assert by_index[None] == by_index[0]
    assert url_filter.judge(pages.limit(0), labelled).count() == 0


def test_the_query_equals_brute_force(spark, tmp_path):
    from missivelake.llm import queries

    rng = random.Random(3)
    parts = lambda: "/".join(rng.choice(["a", "b", "c9"]) for _ in range(rng.randint(0, 3)))
    pages = [(k, f"http://{rng.choice(['x', 'y'])}.{rng.choice(['example.net', 'example.com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/{parts()}?{rng.choice(['', 'q=1', 'ref=x&q=2'])}") for k in range(300)]
    labels = [(k, rng.choice([0, 1, 1]) if "/a" in u else 1, int("y." in u and rng.random() < 0.4)) for k, u in pages if k % 3]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    url = dict(pages)
    wanted = brute_rules([(url[k], q == 0 or x == 1) for k, q, x in labels])
    stated = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    got = {r["page_id"]: r for r in queries.QUERIES["op1_url_filter"](spark, str(tmp_path)).collect()}
    mined = 0
    for k, u in pages:
        host, path = re.match(r"http://([^/]*)([^?]*)", u).groups()
        fits = [(len(rule), rule, act) for rule, act in stated if ("." + host).endswith("." + rule.split("/")[0]) and path.startswith(rule[rule.index("/") :])]
        sure = max((c for items, c in wanted.items() if items <= brute_tokens(u)), default=None)
        rule, verdict = max(fits)[1:] if fits else (None, "block" if sure else "allow")
        mined += not fits and bool(sure)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == (host, path, rule, verdict)
        assert got[k]["confidence"] == (pytest.approx(sure) if sure else None)
    assert len(got) == 300 and mined > 10


@pytest.mark.parametrize("parts", [16, 400])
def test_long_addresses_end(spark, parts):
    long = "http://h.com/" + "/".join(f"part{'x' * k}" for k in range(parts))
    rows = [(long, True)] * 12 + [("http://other.com/a", False)] * 12 + [("http://h.com/b", False)] * 3
    mined = url_filter.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    # The parts of the long address are one item; only the host tells more rows.
    assert 1 <= len(mined) <= 3 and max(len(r["antecedent"]) for r in mined) >= parts


def test_support_is_not_rounded_up(spark):
    """Five bad rows of one host give their rule beside any number of others."""
    for n in (100, 146, 147, 148, 149, 293, 586, 700):
        rows = [("http://bad.com/x", True)] * 5 + [(f"http://h{k}.org/{k}", False) for k in range(n - 5)]
        mined = {tuple(r["antecedent"]): r["confidence"] for r in url_filter.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()}
        assert mined.get(("h=bad", "h=com", "host=bad.com", "p=x")) == 1.0, n


def test_labels_that_tell_nothing_give_few_rules(spark):
    """Over several tables of labels drawn by lot; planted rules among them are still found."""
    rng = random.Random(21)
    tables = 0
    for _ in range(8):
        urls = [f"http://{rng.choice('abcdef')}.{rng.choice(['net', 'org', 'com'])}/{rng.choice('uvw')}/{rng.choice('xyz')}/{k}" for k in range(400)]
        tables += bool(url_filter.mine(spark.createDataFrame([(u, rng.random() < 0.3) for u in urls], "url string, bad boolean")).count())
    assert tables <= 2
    planted = [(u, rng.random() < (0.9 if "/v/" in u and ".net/" in u else 0.2)) for u in urls]
    mined = [set(r["antecedent"]) for r in url_filter.mine(spark.createDataFrame(planted, "url string, bad boolean")).collect()]
    assert {"h=net", "p=v"} in mined


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_synthetic_labels_tell_nothing(spark, sf):
    from missivelake.llm import queries

    rows = queries.QUERIES["op1_url_filter"](spark, f"/root/testdata/{sf}").collect()
    assert sum(r["confidence"] is not None for r in rows) <= 0.05 * len(rows)


def test_empty_and_repeated_pages(spark):
    labelled = spark.createDataFrame([("http://a.net/x", True)], "url string, bad boolean")
    assert url_filter.judge(pages_of(spark, []), labelled).count() == 0
    twice = url_filter.judge(pages_of(spark, [(1, "http://a.net/x"), (1, "http://a.net/x"), (1, "http://b.org/fr/")]), labelled).collect()
    assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in twice) == [(1, "net/", "block"), (1, "net/", "block"), (1, "org/fr/", "allow")]


LETTERS = {"en": "the of and to in is that with", "de": "der die und das nicht ein zu mit", "fr": "le la et les des une que pour"}


def sentence(rng, lang, n=30):
    return " ".join(rng.choice(LETTERS[lang].split()) for _ in range(n))


def test_language_evidence(spark):
    rng = random.Random(7)
    rows = [(k, sentence(rng, lang := rng.choice(["en", "de", "fr"])), lang if rng.random() < 0.95 else "en", f"host-{lang}", 1) for k in range(300)]
    truth = {k: h[5:] for k, _, _, h, _ in rows}
    rows += [(900, "", "de", "host-de", 1), (901, None, None, None, 1), (902, "12345 !!!", "en", "host-en", 1), (903, "xq", None, "host-fr", 1), (None, sentence(rng, "de"), "??", "new", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p long")
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert sum(got[k]["lang"] == truth[k] for k in truth) >= 298
    assert not any(got[k]["kept"] for k in (900, 901, 902)) and got[902]["lang"] is None
    assert got[903]["lang"] == "fr"  # the host's prior decides where the text says little
    assert got[None]["lang"] == "de" and got[None]["kept"]
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert langid.identify(docs.limit(0)).count() == 0
    few = spark.createDataFrame([(k, sentence(rng, x), x, None, 1) for k, x in enumerate(["en", "de", "fr"])], docs.schema)
    assert [r["lang"] for r in langid.identify(few).orderBy("doc_id").collect()] == ["en", "de", "fr"]
    assert not any(r["kept"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect())
    assert {r["kept"] for r in langid.identify(docs, keep_languages=["de"]).filter("lang = 'en'").collect()} == {False}


def brute_buckets(text):
    b = text.lower().encode()
    out = []
    for x, y, z in zip(b, b[1:], b[2:]):
        h = (x * 0x9E3779B1 & 0xFFFFFFFF) ^ (y * 0x85EBCA6B & 0xFFFFFFFF) ^ (z * 0xC2B2AE35 & 0xFFFFFFFF)
        out.append((h ^ h >> 15) % langid.BUCKETS)
    return out


def brute_fusion(rows):
    """(language, posterior) of each (text, declared, host, suffix) by sums over all rows."""
    names = sorted({d for _, d, _, _ in rows if d})
    grams = [brute_buckets(t) for t, _, _, _ in rows]
    counts = {c: Counter(g for (_, d, _, _), own in zip(rows, grams) if d == c for g in own) for c in names}
    pool = sum(counts.values(), Counter())
    total = sum(pool.values()) + 0.5 * langid.BUCKETS

    def p(c, g):
        return (counts[c][g] + langid.SHRINK * (pool[g] + 0.5) / total) / (sum(counts[c].values()) + langid.SHRINK)

    scores = [[sum(math.log(p(c, g)) for g in own) / langid.TEMPER for c in names] for own in grams]
    soft = lambda x: [math.exp(v - max(x)) / sum(math.exp(u - max(x)) for u in x) for v in x]
    own = [soft(x) if any(c.isalpha() for c in r[0]) else None for x, r in zip(scores, rows)]
    width = range(len(names))
    sums = lambda pick, skip=None: [sum(q[k] for i, (q, r) in enumerate(zip(own, rows)) if q and i != skip and pick(r)) for k in width]
    everything = sums(lambda r: True)
    base = [(x + 1) / (sum(everything) + len(names)) for x in everything]
    said = {d: sums(lambda r: r[1] == d) for d in names}
    says = {d: [math.log((said[d][k] + 0.5) / sum(said[e][k] + 0.5 for e in names)) for k in width] for d in names}
    out = []
    for i, (text, declared, host, suffix) in enumerate(rows):
        if not own[i]:
            out.append((None, None))
            continue
        s = sums(lambda r: suffix is not None and r[3] == suffix, i)
        h = sums(lambda r: host is not None and r[2] == host, i)
        prior = [(s[k] + langid.SUFFIX_WEIGHT * base[k]) / (sum(s) + langid.SUFFIX_WEIGHT) for k in width]
        prior = [(h[k] + langid.HOST_WEIGHT * prior[k]) / (sum(h) + langid.HOST_WEIGHT) for k in width]
        post = soft([scores[i][k] + math.log(prior[k]) + (says[declared][k] if declared else 0) for k in width])
        out.append((names[max(width, key=lambda k: post[k])], max(post)))
    return out


def test_fusion_of_pages_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(80):
        lang = rng.choice(["en", "de", "fr"])
        n = rng.choice([0, 1, 3, 20])
        rows.append((sentence(rng, lang, n), rng.choice([lang, lang, "en", None]), rng.choice([f"{lang}.example.{lang}", "www.x.com"])))
    rows += [("12 34", "en", "www.x.com"), ("a", None, "nowhere"), ("", "fr", "www.x.com"), *[("der die das", "nl", "b.nl")] * 2]
    wanted = brute_fusion([(f"   {t} ", d, h, h.rsplit(".", 1)[1] if "." in h else None) for t, d, h in rows])
    html = [(k, f"http://{h}/p?q", f'<html{f" lang={d!r}" if d else ""}><script>the of x</script><b>{t}</b>') for k, (t, d, h) in enumerate(rows)]
    pages = spark.createDataFrame([*html, (900, None, None), (None, "http://www.x.com", "<html>the of and to in</html>")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.identify_pages(pages.filter("page_id < 900")).collect()}
    for k, (lang, sure) in enumerate(wanted):
        assert got[k]["lang"] == lang, rows[k]
        if lang:
            assert got[k]["posterior"] == pytest.approx(sure, abs=2e-3)
    odd = {r["page_id"]: r for r in langid.identify_pages(pages).collect()}
    assert odd[900]["lang"] is None and not odd[900]["kept"] and odd[None]["lang"] == "en"
    assert langid.identify_pages(pages.limit(0)).count() == 0


def test_the_largest_language_is_trained(spark):
    """A language of two thousand million rows still has its sample, which is never more than stated."""
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    few = rows.union(spark.range(30).select(F.col("id"), F.lit("der die das"), F.lit("de")))
    for n, least in ((2_000_000_000, 0), (40_000, 1000)):
        got = {r["code"]: r["n"] for r in langid.sampled(few, F.col("lang"), "text", "doc_id", [("de", 30), ("en", n)]).groupBy("code").agg(F.count("*").alias("n")).collect()}
        assert got["de"] == 30 and least <= got.get("en", 0) <= 1000
    # The share of so many rows is small, but no rounding makes it nothing.
    share = 2.0 * langid.TRAIN_ROWS / 2e9
    found = langid.sampled(rows.withColumn("text", F.lit("x")), F.col("lang"), "text", "doc_id", [("en", 2_000_000)], 50_000).count()
    assert found == pytest.approx(40_000 * 0.05, rel=0.2) and share > 0
    copies = rows.withColumn("text", F.lit("one text")).withColumn("doc_id", F.lit(7))
    assert langid.sampled(copies, F.col("lang"), "text", "doc_id", [("en", 2000)]).count() <= 1000


def test_junk_declarations_cost_little(spark):
    import time

    rng = random.Random(2)
    junk = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd"]
    rows = [(k, sentence(rng, lang := rng.choice(["en", "de", "fr"])), junk[k % 1000] if k % 3 == 0 else lang, f"h{k % 50}") for k in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    began = time.time()
    got = langid.identify(docs).groupBy("lang").count().collect()
    assert time.time() - began < 60 and {r["lang"] for r in got} == {"de", "en", "fr"}


def test_very_long_texts_and_repeated_rows(spark):
    rng = random.Random(9)
    long = sentence(rng, "de", 300_000)
    rows = [(k, sentence(rng, x), x, "h") for k, x in enumerate(["en", "de", "fr"] * 5)] + [(99, long, None, "h")] * 2
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == len(rows) and [r["lang"] for r in got if r["doc_id"] == 99] == ["de", "de"]


def test_the_language_query_covers_both_tables(spark):
    from missivelake.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op9_language_id"](spark, sf).collect()
    for table, key in (("documents", "doc_id"), ("pages", "page_id")):
        ids = [r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect()]
        assert sorted(r[key] for r in rows if r[key] is not None) == sorted(ids)
    declared = [(r["lang"], r["declared"]) for r in rows if r["page_id"] is not None]
    assert sum(a == b for a, b in declared) > 0.9 * len(declared)


def test_trigrams_stay_within_texts():
    found, sizes = langid.trigrams(["abcd", "", "x", "éa", "abc"])
    assert sizes.tolist() == [2, 0, 0, 1, 1] and len(found) == 4
    one, _ = langid.trigrams(["abc"])
    assert found[0] == found[3] == one[0]


def brute_align(item, region):
    h = [[0] * (len(region) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(region, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=20))
def test_alignment_equals_brute_force(item, region):
    score, s, e = decontaminate.align(np.array(item, np.int64), np.array(region, np.int64))
    assert score == brute_align(item, region)
    if score:
        assert brute_align(item, region[s:e]) == score


def test_leaks_and_edited_leaks(spark, docs_of, monkeypatch):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(4000)
    items = [(k, " ".join(word() for _ in range(40))) for k in range(20)] + [(50, None), (51, "a b"), (52, "three small words")]
    noise = lambda n: " ".join(word() for _ in range(n))
    rows, wanted = [], set()
    for k in range(60):
        item = rng.randrange(20)
        text = items[item][1]
        if k % 3 == 0:
            words = text.split()
            for _ in range(6):
                words[rng.randrange(len(words))] = "edited"
            text = " ".join(words).upper()
        if k % 3 < 2:
            rows.append((k, f"{noise(80)}\n{text}, {noise(50)}"))
            wanted.add((k, item))
        else:
            rows.append((k, noise(150)))
    rows += [(100, None), (101, ""), (102, "said THREE small, words here"), (None, items[0][1]), (0, rows[0][1])]
    wanted |= {(102, 52), (None, 0)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for bits in (decontaminate.MOST_BITS, 64):  # a full bit set lets everything through, which the join takes back
        monkeypatch.setattr(decontaminate, "MOST_BITS", bits)
        got = decontaminate.contaminated(docs_of(rows), benchmark).collect()
        assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted(wanted, key=str)
    kept = decontaminate.drop_contaminated(docs_of(rows), benchmark)
    assert kept.columns == docs_of([]).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([k for k in range(60) if k % 3 == 2] + [100, 101, None], key=str)
    assert decontaminate.contaminated(docs_of(rows), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(docs_of([]), benchmark).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.3])
def test_leaks_equal_alignment_of_all_pairs(spark, docs_of, share):
    rng = random.Random(12)
    words = lambda n: ["w%d" % rng.randrange(3000) for _ in range(n)]
    items = [(k, words(rng.choice([10, 36, 80]))) for k in range(12)]
    rows = [(900, words(300))]
    for k in range(60):  # copies of any part of an item, more or less edited
        own = list(items[k % 12][1])
        part = own[: rng.randint(3, len(own))]
        for _ in range(rng.choice([0, 2, 8])):
            part[rng.randrange(len(part))] = "edited%d" % rng.randrange(99)
        rows.append((k, words(20) + part + words(20)))
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(docs_of([(k, " ".join(w)) for k, w in rows]), table, share=share).collect()}
    wanted = {}
    for i, doc in rows:
        for j, own in items:
            number = {w: k for k, w in enumerate(dict.fromkeys(own + doc))}
            s, x, y = decontaminate.align(np.array([number[w] for w in own]), np.array([number[w] for w in doc]))
            if s >= share * 2 * len(own) and sum(w in doc[x:y] for w in own) >= 8:
                wanted[i, j] = s / (2 * len(own))
    assert set(got) <= set(wanted) and all(got[p] == pytest.approx(wanted[p]) for p in got)
    # A leak without any three equal words in a row has no seed.
    missed = [p for p in wanted if p not in got]
    assert len(missed) <= 0.05 * len(wanted) and len(wanted) > 10
