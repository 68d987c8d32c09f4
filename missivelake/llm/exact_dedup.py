"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so: at white space between certain letters (about one word in
forty), at least ``min_chars`` and at most ``max_chars`` after the last cut.  Equal stretches of different
texts are therefore cut alike, wherever they stand.  Chunks are deduplicated once; a 64-bit chunk hash becomes a verified identifier when
exactly one chunk content carries it.  A text is then represented by its recipe, the ordered list of chunk
identifiers, and only recipes are compared and moved.  Contents that share a hash are compared as text.

Defined results: a null text is the empty text, whose recipe is empty; all such rows are equal.  Rows with
a null doc_id take part; when every row of a group has a null doc_id, keep_id is null and all of them stay.
Repeated rows (same doc_id, same text) each count in group_size and share one verdict.  Other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_without, whole_text, written

MIN_CHARS, MAX_CHARS = 512, 8192
#: Hash values shared by different chunks that are listed in the plan; beyond, every chunk is compared as text.
MAX_LISTED = 10_000


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The chunks of a text in order; joined, they give the text back."""
    cut = rf"(?s).{{{min_chars},{max_chars}}}?(?<=[n-zN-Z.]\s)(?=[a-dA-D][a-fA-F])|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def shared_hashes(docs: DataFrame, text: str = "text", hashed=chunk_hash, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Hashes that more than one chunk content carries; every distinct chunk is moved once."""
    parts = docs.select(F.explode(chunks(whole_text(text), min_chars, max_chars)).alias("chunk"))
    distinct = parts.select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    return distinct.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")


def exact_dedup(docs: DataFrame, text: str = "text", hashed=chunk_hash, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays.  ``hashed`` maps a chunk to a bigint and may
    collide; the result does not depend on it.
    """
    collided = [r[0] for r in shared_hashes(docs, text, hashed, min_chars, max_chars).limit(MAX_LISTED + 1).collect()]
    value = whole_text(text)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(value.cast("binary"), 256).alias("text_sha256"),
        chunks(value, min_chars, max_chars).alias("chunks"),
    )
    if not collided:
        plain = F.array().cast("array<string>")
    elif len(collided) > MAX_LISTED:
        plain = F.col("chunks")
    else:
        plain = F.filter("chunks", lambda c: hashed(c).isin(collided))
    rows = rows.select("doc_id", "text_sha256", F.transform("chunks", hashed).alias("recipe"), plain.alias("plain"))
    rows = rows.select("doc_id", "text_sha256", F.xxhash64("recipe", "plain").alias("key"), "recipe", "plain")
    # Partial aggregation merges the copies of one group before they are shuffled.
    groups = rows.groupBy("key", "recipe", "plain").agg(F.max("doc_id").alias("largest"), F.count("*").alias("n")).filter("n > 1")
    # A plain equi-join: AQE broadcasts a small side and splits a hot recipe's partition.
    joined = rows.join(groups, ["key", "recipe", "plain"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("largest")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("n").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("largest"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each set of equal texts, with all its columns: a row that ``exact_dedup`` keeps.

    Where it keeps several, rows of one doc_id or all without one, any one of them stays.
    """
    own = F.col("doc_id").cast("long"), F.sha2(whole_text(text).cast("binary"), 256)
    verdicts = exact_dedup(docs, text).groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    verdicts = written(verdicts.filter("not kept or n > 1"), "copies")
    kept = rows_without(docs, verdicts.select("doc_id", "text_sha256"), *own)
    several = verdicts.filter("kept").select("doc_id", "text_sha256")
    if several.isEmpty():
        return kept
    # Few rows: those that stand in the table more than once as they are.
    some = rows_without(docs, verdicts.filter("not kept").select("doc_id", "text_sha256"), *own)
    rest = rows_without(some, kept.select(own[0].alias("doc_id"), own[1].alias("text_sha256")).distinct(), *own)
    one = rest.groupBy(*[x.alias(f"key{k}") for k, x in enumerate(own)]).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return kept.unionByName(one.select("row.*"))
