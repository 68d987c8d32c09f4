"""Sinks: pages per thread, JSON documents, manifests, and file copies and moves."""

from __future__ import annotations

import contextlib
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.sources.sorted_files import write_sorted
from missivelake.sources.stores import in_task, located, staged

#: The columns by which the messages of a page are ordered.
MESSAGE_ORDER = ["undated", "ts_key", "file_ord", "msg_ord"]


def page_pieces(messages: DataFrame, group: str, title: Column | None = None, shells: DataFrame | None = None) -> DataFrame:
    """(name, kind, text, and the order): the messages of each group in time order, undated ones last, between head and tail.

    shells (<group>, before, after) gives what stands around them, else a bare page does.  A page is never one row: its pieces
    are sorted by ranges and written as a stream.
    """
    head = T.html_escape(title if title is not None else F.col(group).cast("string"))
    before, after = F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), head, F.lit("</title></head><body>\n")), F.lit("\n</body></html>")
    groups = messages.groupBy(group).agg(F.first(before).alias("bare"))
    if shells is not None:
        groups = groups.join(shells.select(group, "before", "after"), group, "left")
        before, after = F.coalesce("before", "bare"), F.coalesce("after", after)
    else:
        before = F.col("bare")
    name = F.col(group).cast("string").alias("name")
    nowhere = [F.lit(False).alias("undated"), F.lit("").alias("ts_key"), F.lit(0).cast("long").alias("file_ord"), F.lit(0).cast("long").alias("msg_ord")]
    body = messages.select(name, F.lit(1).alias("kind"), F.col("html").alias("text"), (F.coalesce("ts_key", F.lit("")) == "").alias("undated"), F.coalesce("ts_key", F.lit("")).alias("ts_key"), F.col("file_ord").cast("long").alias("file_ord"), F.col("msg_ord").cast("long").alias("msg_ord"))
    return body.union(groups.select(name, F.lit(0).alias("kind"), before.alias("text"), *nowhere)).union(groups.select(name, F.lit(2).alias("kind"), after.alias("text"), *nowhere))


def write_pages(pieces: DataFrame, folder: str, order: list[Column | str] | None = None) -> int:
    """Writes the pages of ``pieces`` below a folder; returns how many."""
    return write_sorted(pieces, folder, order or MESSAGE_ORDER)


def write_text_files(rows: DataFrame, folder: str, name: str, text: str) -> None:
    """One file a row, written by the executors into a folder they share; a repeated task writes the same."""
    base = located(rows.sparkSession, folder)

    def write(part):
        import uuid

        store, root = in_task(base)
        store.create_dir(root, recursive=True)
        for r in part:
            path = f"{root.rstrip('/')}/{r[name].lstrip('/')}"
            store.create_dir(path.rpartition("/")[0], recursive=True)
            beside = f"{path}.tmp.{uuid.uuid4().hex}"
            with store.open_output_stream(beside) as out:
                out.write(r[text].encode())
            store.move(beside, path)

    rows.select(name, text).foreachPartition(write)


def copy_files(plan: DataFrame, dry_run: bool = False) -> int:
    """Copies (source, target) pairs on the executors, with their times; returns how many.

    Several sources of one target are a mistake of the plan: the least source is the one that is copied, in any order of tasks.
    """
    import shutil

    chosen = staged(plan.groupBy("target").agg(F.min("source").alias("source")), "copies")
    n = chosen.count()
    if not dry_run:

        def copy(part):
            for r in part:
                os.makedirs(os.path.dirname(r["target"]), exist_ok=True)
                beside = f"{r['target']}.tmp.{os.getpid()}"
                shutil.copy2(r["source"], beside)
                os.replace(beside, r["target"])

        chosen.select("source", "target").foreachPartition(copy)
    return n


def digests(plan: DataFrame, column: str) -> DataFrame:
    """(<column>, length, sha256) of the distinct files that a column names, read as streams by tasks; absent ones have nulls."""

    def read(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                length, digest = None, None
                with contextlib.suppress(FileNotFoundError, IsADirectoryError), open(path, "rb") as f:
                    digest, length = hashlib.file_digest(f, "sha256").hexdigest(), f.tell()
                rows.append((path, length, digest))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.string())], names=["path", "length", "sha256"])

    paths = plan.select(F.col(column).cast("string")).distinct()
    return paths.mapInArrow(read, "path string, length long, sha256 string").withColumnRenamed("path", column)


def move_files(plan: DataFrame) -> DataFrame:
    """Carries out (source, target, action) of ``operators.sanitize.settle`` on the executors: ``move`` renames, ``remove`` deletes a
    source whose bytes the target has.  Returns what was done: (source, target, action, done).

    No two rows have one target to move to, so that the outcome does not depend on the order of tasks.  A repeated task finds
    its sources gone, which is no error.  Folders that are empty afterwards go too.
    """

    def move(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                if r["action"] == "remove":
                    with contextlib.suppress(FileNotFoundError):
                        os.remove(r["source"])
                elif os.path.exists(r["source"]):
                    os.makedirs(os.path.dirname(r["target"]), exist_ok=True)
                    os.replace(r["source"], r["target"])
                with contextlib.suppress(OSError):
                    os.removedirs(os.path.dirname(r["source"]))
                r["done"] = not os.path.exists(r["source"])
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("source", pa.string()), ("target", pa.string()), ("action", pa.string()), ("done", pa.bool_())]))

    settled = staged(plan.select("source", "target", "action"), "moves")
    removed = staged(settled.filter("action = 'remove'").mapInArrow(move, "source string, target string, action string, done boolean"), "removed")
    return removed.union(staged(settled.filter("action = 'move'").mapInArrow(move, "source string, target string, action string, done boolean"), "moved"))


def write_document(pieces: DataFrame, path: str, order: list[Column | str], separator: str = ",\n") -> bool:
    """Writes one JSON document of sorted (kind, text) pieces; nothing without pieces."""
    folder, _, name = path.rpartition("/")
    return write_sorted(pieces.withColumn("name", F.lit(name)), folder or ".", order, separator) > 0


#: The keys of a snapshot's manifest, in order.
MANIFEST_KEYS = (
    "snapshot_time", "source_db", "message_count", "attachment_rows", "integrity_check", "zero_byte_attachments",
    "missing_attachments", "attachment_audit", "shared_attachments", "wal_copied",
)


def manifest_text(values: dict[str, object]) -> str:
    return "".join(f"{k}: {values.get(k, '?')}\n" for k in MANIFEST_KEYS)


def write_version(df: DataFrame, path: str) -> None:
    """A new version of a table; an existing one is never overwritten."""
    df.write.mode("errorifexists").parquet(path)
