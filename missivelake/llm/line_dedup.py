"""Line deduplication that returns per-document keep bitmaps (DataFrame functions only).

Lines travel as 128-bit key hashes with (document, position), never as text.  They are written once, range-partitioned
by hash and document (descending) and sorted within the ranges by hash, document and position, so that a very
common line spreads over as many ranges as it needs.  Every range streams its sorted rows: first occurrences in a
document, then one run head a key, its first document and how many hold it.  The few run heads are merged, one row a
key and range.  The lines to drop come back per document as a run-length compressed bitmap: the runs of kept lines.

Defined results: a null or empty text is one empty line.  Documents are counted by doc_id, so rows of one
doc_id are one document there, while each row gets its own bitmap by its text.  Rows with a null doc_id neither count
nor lose lines.  Repeated rows (same doc_id, same text) get the same bitmap.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, setting, whole_text, written

MIN_CHARS, MIN_DOCS = 40, 5
WHITE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without the white space around it, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _occurrences(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, th, n_lines, pos): one row for each long line."""
    value = whole_text(text)
    # HOFs keep a document's lines in one row until only hashes are left.
    keyed = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(value).alias("th"),
        F.transform(lines_of(value), line_key).alias("keys"),
    )
    hashed = keyed.select(
        "doc_id",
        "th",
        F.size("keys").alias("n_lines"),
        F.posexplode(F.transform("keys", lambda k: F.when(F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("second"), k).alias("h2"))))).alias("pos", "h"),
    ).filter(F.col("h").isNotNull())
    return hashed.select("h.h1", "h.h2", "doc_id", "th", "n_lines", "pos")


def run_heads(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first_doc, first_pos, n_docs): the first occurrence of each key that at least ``min_docs`` documents hold."""
    # The complement of an id reverses the order, so that descending ids are ascending for the grouping too.
    order = ["h1", "h2", "reverse"]
    ranged = lines.select("h1", "h2", F.bitwise_not("doc_id").alias("reverse"), "pos").repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    # A range holds all rows of a key and document, so neither grouping moves rows before its heads are made; the
    # first position depends on the order, which keeps the sort.
    in_docs = ranged.groupBy(*order).agg(F.first("pos").alias("pos"))
    heads = in_docs.groupBy("h1", "h2").agg(F.min(F.struct("reverse", "pos")).alias("first"), F.count("*").alias("n_docs"))
    return heads.filter(F.col("n_docs") >= min_docs).select("h1", "h2", F.bitwise_not("first.reverse").alias("first_doc"), F.col("first.pos").alias("first_pos"), "n_docs")


def keep_bitmaps(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, th, n_dropped, keep_runs) for documents that lose lines.

    th is xxhash64 of the text; keep_runs are (start, length) pairs of kept lines, starts from 1.
    """
    lines = written(_occurrences(docs, text, min_chars), "lines")
    # Sorted input is grouped as a stream.  Written, the heads are a table of their own: both sides of the join are
    # plain exchanges, and AQE can split the partition of a very common line.
    with setting(docs.sparkSession, "spark.sql.execution.replaceHashWithSortAgg", "true"):
        heads = written(run_heads(lines, min_docs), "line-heads")
    hits = lines.join(heads, ["h1", "h2"]).filter("doc_id <> first_doc")
    per_doc = hits.groupBy("doc_id", "th", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.col("n_lines")))
    gaps = F.transform(
        F.sequence(F.lit(1), F.size("gone") + 1),
        lambda i: F.struct((F.element_at("edges", i) + 2).alias("start"), (F.element_at("edges", i + 1) - F.element_at("edges", i) - 1).alias("length")),
    )
    maps = per_doc.withColumn("edges", edges).select("doc_id", "th", F.size("gone").cast("long").alias("n_dropped"), F.filter(gaps, lambda g: g["length"] > 0).alias("keep_runs"))
    maps = written(maps, "keep-bitmaps")
    discard(lines, heads)
    return maps


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) for every row of ``docs``."""
    value = whole_text(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("text"), F.xxhash64(value).alias("th"))
    marks = bitmaps.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "n_dropped", "keep_runs").hint("shuffle_hash")
    joined = rows.join(marks, (F.col("th") == F.col("__th")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    lines = lines_of(F.col("text"))
    kept = F.array_join(F.flatten(F.transform("keep_runs", lambda r: F.slice(F.col("lines"), r["start"], r["length"]))), "\n")
    return joined.withColumn("lines", lines).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep_runs").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )


def line_dedup(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines
    except in the largest doc_id that holds them."""
    return apply_bitmaps(docs, keep_bitmaps(docs, text, min_chars, min_docs), text)
