"""Language identification by Bayesian evidence fusion.

Four pieces of evidence give one posterior over the languages:

* text: naive Bayes over hashed byte trigrams of the whole lower-cased text;
* the declared language, weighted by how often texts of a language declare it;
* the address suffix and the host, as a hierarchy of smoothed priors (all rows, suffix, host), each level
  shrinking to the one above; a row's own contribution is taken out of its host's and suffix's counts.

The trigram model is fitted on a sample of at most ``TRAIN_ROWS`` rows a language, those of smallest hash of text and key;
priors and declaration rates are grouped sums over all rows.  The languages are those of ``CODES`` that some row declares, however
few its rows: its trigram counts shrink to those of all languages, so a language with little text is like the mixture, which
loses to a text's own language.

A task keeps of each text the languages within ``FAR`` of its best one; the others have no weight that a prior or a
declaration could raise again.  Rows, sums and joins hold these few only.

Defined results: a null or empty text has no text evidence; a text without letters is rejected
(lang null).  A declaration that is null or no code of the list, and a null or unknown suffix or host, say nothing.  Without any declared language
everything is rejected.  Rows with a null doc_id and repeated rows are judged like any other.  Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_without, small_batches, whole_text, written

BUCKETS = 1 << 14
TRAIN_ROWS = 1000
#: Natural logarithms by which a language may fall behind the best one of a text.
FAR = 60.0
#: The two-letter codes of ISO 639-1.
CODES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv "
    "ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my "
    "na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty "
    "ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
#: Trigrams of the mixture of all languages that are added to those of each.
SHRINK = 2000.0
#: Neighbouring trigrams share bytes: that many count as one independent observation.
TEMPER = 3.0
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
LEAST_POSTERIOR = 0.5


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all texts' trigrams, number of them in each text)."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([max(0, len(r) - 2) for r in raw], np.int64)
    b = np.frombuffer(b"".join(raw), np.uint8)
    if len(b) < 3:
        return np.empty(0, np.uint32), sizes
    h = b[:-2].astype(np.uint32) * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS)
    # Trigrams over the border of two texts go.
    ends = np.cumsum([len(r) for r in raw])
    keep = np.ones(len(b), bool)
    keep[np.concatenate([ends - 1, ends - 2])[np.concatenate([ends - 1, ends - 2]) >= 0]] = False
    for e, r in zip(ends.tolist(), raw):
        if len(r) == 1:
            keep[e - 1] = False
    return h[keep[: len(h)]], sizes


def languages(docs: DataFrame, declared: Column) -> list[tuple[str, int]]:
    """The declared codes of the list, and how many rows each has."""
    rows = docs.select(F.lower(F.trim(declared)).alias("code")).filter(F.col("code").isin(CODES)).groupBy("code").count()
    return sorted((r["code"], r["count"]) for r in rows.collect())  # at most one row a code of the list


def sampled(docs: DataFrame, declared: Column, text: str, key: str, codes: list[tuple[str, int]], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(code, text): at most ``train_rows`` rows of each code, those of smallest hash.

    A share of the hashes twice as large as needed goes into the ranking; it is compared as a fraction, which no number of rows rounds
    to zero.  Only that many rows of a code leave a task.
    """
    share = F.create_map(*[x for c, n in codes for x in (F.lit(c), F.lit(min(1.0, 2.0 * train_rows / n)))])
    at = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(key)), 1)
    rows = docs.select(F.lower(F.trim(declared)).alias("code"), whole_text(text).alias("text"), at.alias("at"))
    rows = rows.filter(F.col("code").isin([c for c, _ in codes]) & (F.col("at").cast("double") / float(1 << 63) <= share[F.col("code")]))
    place = F.row_number().over(Window.partitionBy("code").orderBy("at", F.xxhash64("text")))
    return rows.withColumn("place", place).filter(F.col("place") <= train_rows).select("code", "text")


def train(rows: DataFrame, names: list[str]) -> np.ndarray:
    """Log probabilities (language, bucket) of (code, text) rows, smoothed by the mixture of all languages."""
    place = {c: k for k, c in enumerate(names)}

    def count(batches):
        import pyarrow as pa

        total = np.zeros((len(names), BUCKETS), np.int64)
        for batch in batches:
            for c, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[place[c]] += np.bincount(trigrams([t])[0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())], names=["cell", "n"])

    cells = rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(names) * BUCKETS)
    for r in cells.toLocalIterator():  # at most one number for each cell of the model
        counts[r["cell"]] += r["n"]
    counts = counts.reshape(len(names), BUCKETS)
    mixture = counts.sum(0) + 0.5
    counts += SHRINK * mixture / mixture.sum()
    return np.log(counts / counts.sum(1, keepdims=True))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def identify(
    docs: DataFrame,
    text: str = "text",
    declared: Column | str = "lang",
    host: Column | str = "source",
    suffix: Column | str | None = None,
    key: str = "doc_id",
    keep_languages: list[str] | None = None,
    least_posterior: float = LEAST_POSTERIOR,
) -> DataFrame:
    """(doc_id, th, lang, posterior, text_lang, declared, kept) for every row.

    th is xxhash64 of the text.  ``keep_languages`` None keeps every language.  Columns are given as names
    or expressions; for web pages ``declared`` is the markup's language and host and suffix come from the
    address.
    """
    spark = docs.sparkSession
    small_batches(spark)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    declared, host = as_column(declared), as_column(host)
    suffix = F.lit(None).cast("string") if suffix is None else as_column(suffix)
    codes = languages(docs, declared)
    names = [c for c, _ in codes]
    schema = "doc_id long, th long, lang string, posterior double, text_lang string, declared string, kept boolean"
    value = whole_text(text)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(value).alias("th"), value.alias("text"), F.lower(F.trim(declared)).alias("declared"), host.cast("string").alias("host"), suffix.cast("string").alias("suffix"))
    if not codes:
        nothing = F.lit(None).cast("string")
        return rows.select("doc_id", "th", nothing.alias("lang"), F.lit(None).cast("double").alias("posterior"), nothing.alias("text_lang"), "declared", F.lit(False).alias("kept"))
    model_rows = sampled(docs, declared, text, key, codes)
    table = spark.sparkContext.broadcast(train(model_rows, names).astype(np.float32).T.copy())  # languages x buckets

    def score(batches):
        import pyarrow as pa

        model = table.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found, sizes = trigrams(texts)
            out = np.zeros((len(texts), len(names)), np.float64)
            at, k = 0, 0
            while k < len(texts):  # parts of a bounded number of trigrams
                j, n = k, 0
                while j < len(texts) and (n == 0 or n + sizes[j] <= 500_000):
                    n += int(sizes[j])
                    j += 1
                full = np.flatnonzero(sizes[k:j])
                if len(full):
                    starts = np.cumsum(sizes[k:j]) - sizes[k:j]
                    out[k + full] = np.add.reduceat(model[found[at : at + n]], starts[full], axis=0)
                at, k = at + n, j
            out /= TEMPER
            letters = [any(c.isalpha() for c in t) for t in texts]
            near = out >= out.max(1, keepdims=True) - FAR
            ends = pa.array(np.concatenate([[0], np.cumsum(near.sum(1))]), pa.int32())
            p = _softmax(np.where(near, out, -np.inf))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (np.nonzero(near)[1].astype(np.int32), out[near], p[near])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), batch.column(4), batch.column(5), pa.array(letters, pa.bool_()), *lists], names=["doc_id", "th", "declared", "host", "suffix", "letters", "k", "score", "p"])

    scored = written(rows.mapInArrow(score, "doc_id long, th long, declared string, host string, suffix string, letters boolean, k array<int>, score array<double>, p array<double>"), "language-scores")
    # (declared, host, suffix, language, weight), a row for each language that a text may have; summed with map-side combination, so
    # that a hot host costs a few rows a task.
    weights = scored.filter("letters").select("declared", "host", "suffix", F.explode(F.arrays_zip("k", "p")).alias("x")).select("declared", "host", "suffix", "x.k", "x.p")
    by = lambda c: weights.filter(F.col(c).isNotNull()).groupBy(c, "k").agg(F.sum("p").alias("n"))
    overall, said = np.zeros(len(names)), np.full((len(names), len(names)), 0.5)
    for r in weights.groupBy("k").agg(F.sum("p").alias("n")).collect():  # one row a language
        overall[r["k"]] = r["n"]
    codes_said = set()
    for r in by("declared").filter(F.col("declared").isin(names)).collect():  # at most one number for each two languages of the list
        said[names.index(r["declared"]), r["k"]] += r["n"]
        codes_said.add(r["declared"])
    priors = lambda c: written(by(c).groupBy(F.col(c).alias(f"__{c}")).agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias(f"{c}_n")), f"{c}-priors")  # noqa: E731  one entry a language
    base = (overall + 1.0) / (overall + 1.0).sum()
    said = np.log(said / said.sum(0, keepdims=True))  # declared x true
    joined = scored.join(priors("host"), F.col("host") == F.col("__host"), "left").join(priors("suffix"), F.col("suffix") == F.col("__suffix"), "left")
    joined = joined.select("doc_id", "th", "declared", "letters", "k", "score", "p", "host_n", "suffix_n")
    wanted = names if keep_languages is None else [c for c in names if c in set(keep_languages)]

    def fuse(batches):
        import pyarrow as pa

        def dense(lists, values, empty):
            """Rows of all languages from lists of (language, value)."""
            out = np.full((len(lists), len(names)), empty)
            at = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            out[at, lists.flatten().to_numpy(zero_copy_only=False)] = values.flatten().to_numpy(zero_copy_only=False)
            return out

        def counted(maps, own):
            """Sums of a map column without the row's own part."""
            out = np.zeros((len(maps), len(names)))
            for i, m in enumerate(maps.to_pylist()):
                for k, n in m or ():
                    out[i, k] = n
            return np.maximum(out - own * (out.sum(1) > 0)[:, None], 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            letters, declared_ = np.array(batch.column("letters").to_pylist()), batch.column("declared").to_pylist()
            scores = dense(batch.column("k"), batch.column("score"), -np.inf)
            own = dense(batch.column("k"), batch.column("p"), 0.0) * letters[:, None]
            count_s, count_h = counted(batch.column("suffix_n"), own), counted(batch.column("host_n"), own)
            prior_s = (count_s + SUFFIX_WEIGHT * base) / (count_s.sum(1, keepdims=True) + SUFFIX_WEIGHT)
            prior = (count_h + HOST_WEIGHT * prior_s) / (count_h.sum(1, keepdims=True) + HOST_WEIGHT)
            says = np.array([said[names.index(d)] if d in codes_said else np.zeros(len(names)) for d in declared_])
            post = _softmax(scores + np.log(prior) + says)
            best = post.argmax(1)
            sure = np.round(post[np.arange(len(best)), best], 6)
            lang = [names[k] if ok else None for k, ok in zip(best, letters)]
            by_text = [names[k] if ok else None for k, ok in zip(scores.argmax(1), letters)]
            kept = [x is not None and s >= least_posterior and x in wanted for x, s in zip(lang, sure)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(sure, pa.float64()), pa.array(by_text, pa.string()), batch.column(2), pa.array(kept, pa.bool_())], names=["doc_id", "th", "lang", "posterior", "text_lang", "declared", "kept"])

    return joined.mapInArrow(fuse, schema)


def keep_identified(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose language is identified, with all their columns."""
    rejected = identify(docs, text, **options).filter("not kept").select("doc_id", "th").distinct()
    return rows_without(docs, rejected, F.col("doc_id").cast("long"), F.xxhash64(whole_text(text)))


def identify_pages(pages: DataFrame, **options) -> DataFrame:
    """Languages of raw web pages: markup language, host and address suffix as evidence; key page_id.

    The text is the markup without tags, scripts and styles.  A page without ``lang`` in its markup declares nothing.
    """
    host = F.lower(F.regexp_extract("url", r"://([^/?#:]*)", 1))
    visible = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    full = lambda c: F.nullif(c, F.lit(""))
    rows = pages.select("page_id", visible.alias("text"), full(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-z]{2,3})", 1))).alias("declared"), full(host).alias("host"), full(F.regexp_extract(host, r"\.([a-z]+)$", 1)).alias("suffix"))
    return identify(rows, declared="declared", host="host", suffix="suffix", key="page_id", **options).withColumnRenamed("doc_id", "page_id")
