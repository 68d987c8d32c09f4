"""The thin registered queries ``opN_<name>`` and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, fill_in_middle, grammar_ids, langid, line_dedup, nearest, packing, pii, simhash, substring_dedup, url_filter, vector_codes
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Registers a function of (table reader) under its name."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
    return f


def sha256(text: str, name: str = "kept_sha256") -> Column:
    return F.sha2(F.col(text).cast("binary"), 256).alias(name)


@query
def op1_url_filter(t) -> DataFrame:
    pages, labels = t("pages"), t("labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = pages.select("page_id", "url").join(labels, F.col("page_id") == F.col("doc_id")).select("url", F.coalesce(bad, F.lit(False)).alias("bad"))
    return url_filter.judge(pages, labelled)


@query
def op2_packing(t) -> DataFrame:
    placed = packing.pack(t("documents"))
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_pii(t) -> DataFrame:
    found = pii.find(t("documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["is_base"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.KINDS[: pii.BASE]]
    return found.withColumn("base", base).select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op4_exact_dedup(t) -> DataFrame:
    return exact_dedup.exact_dedup(t("documents"))


@query
def op5_decontaminate(t) -> DataFrame:
    return decontaminate.contaminated(t("documents"), t("benchmark"))


@query
def op6_line_dedup(t) -> DataFrame:
    return line_dedup.line_dedup(t("documents")).select("doc_id", "n_lines", "n_dropped", sha256("kept_text"))


@query
def op7_simhash(t) -> DataFrame:
    return simhash.near_dedup(t("documents")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_grammar_ids(t) -> DataFrame:
    return grammar_ids.round_trip(t("documents")).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op9_language_id(t) -> DataFrame:
    """Both tables that have texts.  Documents have no markup and no address: their declared language and their
    source stand in for markup and host.  Pages have all four kinds of evidence."""
    columns = ["lang", "posterior", "text_lang", "declared", "kept"]
    nothing = F.lit(None).cast("long")
    documents = langid.identify(t("documents")).select("doc_id", nothing.alias("page_id"), *columns)
    return documents.union(langid.identify_pages(t("pages")).select(nothing.alias("doc_id"), "page_id", *columns))


@query
def op10_substring_dedup(t) -> DataFrame:
    return substring_dedup.substring_dedup(t("documents")).select("doc_id", "n_words", "n_removed", sha256("kept_text"))


@query
def op11_nearest(t) -> DataFrame:
    return nearest.search(t("embeddings"), F.col("vec_id") % 50 == 0)


@query
def op12_fill_in_middle(t) -> DataFrame:
    rebuilt = fill_in_middle.restore(fill_in_middle.transform(t("documents")))
    return rebuilt.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256("output", "output_sha256"), sha256("restored", "restored_sha256"))


@query
def op13_vector_codes(t) -> DataFrame:
    codes, books = vector_codes.encode(t("embeddings"))
    found = vector_codes.with_label_error(codes)
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", vector_codes.digest(books).alias("codebooks_sha256"))


ORACLES["op4_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g USING (text)
"""

ORACLES["op6_line_dedup"] = """
WITH t AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM t),
k AS (SELECT row, doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS first_doc FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(c.first_doc <> k.doc_id, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY row, doc_id
"""

ORACLES["op10_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS s FROM w WHERE len(ws) >= 13),
k AS (SELECT doc_id, s, array_to_string(ws[s:s + 12], ' ') AS g FROM p),
m AS (SELECT g, min(doc_id) AS least FROM k GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS pos FROM k JOIN m USING (g) WHERE k.doc_id > m.least),
a AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
j AS (SELECT a.doc_id, a.word, a.pos, c.pos IS NOT NULL AS gone FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.pos = c.pos),
t AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM j GROUP BY doc_id)
SELECT w.doc_id, coalesce(t.n_words, 0) AS n_words, coalesce(t.n_removed, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256 FROM w LEFT JOIN t USING (doc_id)
"""

ORACLES["op12_fill_in_middle"] = r"""
WITH l AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM l),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def _codes_sql(parts: int, width: int, entries: int, rounds: int, scale: int) -> str:
    """Every part against every entry of its codebook, round after round."""
    away = " + ".join(f"(q.c[{i}] - b.c[{i}]) * (q.c[{i}] - b.c[{i}])" for i in range(1, width + 1))
    mean = ", ".join(f"CAST((sum(q.c[{i}]) - ((sum(q.c[{i}]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)" for i in range(1, width + 1))
    steps = [
        f"k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {scale}) AS BIGINT)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"q AS (SELECT vec_id, label, p, v[p * {width} + 1:p * {width} + {width}] AS c FROM k, range({parts}) AS r(p))",
        f"b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, c FROM q QUALIFY e < {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS (SELECT q.vec_id, q.label, q.p, min({{'d': {away}, 'e': b.e}}) AS m FROM q JOIN b{r} AS b USING (p) GROUP BY q.vec_id, q.label, q.p)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT q.p, a.m.e AS e, [{mean}] AS c FROM q JOIN a{r} AS a USING (vec_id, p) GROUP BY q.p, a.m.e)")
            steps.append(f"b{r + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{r} AS b LEFT JOIN m{r} AS m USING (p, e))")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})")
    steps.append(f"x AS (SELECT vec_id, label, string_agg(lower(printf('%02x', CAST(m.e AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label)")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM x, s"


ORACLES["op13_vector_codes"] = _codes_sql(vector_codes.PARTS, 4, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE)
