"""File inventories and the small state files of an archive, in any store that Spark reaches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missivelake.sources.sorted_files import write_sorted
from missivelake.sources.stores import Store, in_task, located, staged

LISTED = "path string, folder boolean, length long, mtime timestamp"
#: Rows of a batch of listed files.
LISTED_ROWS = 10_000


def lister(deep: bool):
    """Lists folders in a task: one level, or everything below."""

    def run(batches):
        import os

        import pyarrow as pa
        from pyarrow import fs

        def listed():
            for batch in batches:
                left = batch.column(0).to_pylist()
                while left:
                    address = left.pop()
                    store, base = in_task(address)
                    for info in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                        path = f"{address.rstrip('/')}/{info.base_name}"
                        if info.type == fs.FileType.Directory:
                            if isinstance(store, fs.LocalFileSystem) and os.path.islink(info.path):
                                continue  # what stands there is listed where it is
                            if deep:
                                left.append(path)
                            else:
                                yield path, True, None, None
                        elif info.type == fs.FileType.File:
                            yield path, False, info.size, info.mtime_ns // 1000

        def made(rows):
            paths, folders, lengths, times = zip(*rows) if rows else [()] * 4
            columns = [pa.array(paths, pa.string()), pa.array(folders, pa.bool_()), pa.array(lengths, pa.int64()), pa.array(times, pa.int64()).cast(pa.timestamp("us", "UTC"))]
            return pa.RecordBatch.from_arrays(columns, names=["path", "folder", "length", "mtime"])

        rows = []
        for row in listed():
            rows.append(row)
            if len(rows) == LISTED_ROWS:
                yield made(rows)
                rows = []
        yield made(rows)

    return run


def inventory(spark: SparkSession, root: str, enough: int | None = None) -> DataFrame:
    """(root, rel_path, path, length, mtime) of every file below a folder of any store, empty and hidden ones too, which Spark's
    own readers leave out; none if the folder does not exist.

    The driver lists nothing.  Tasks list level by level, each level dealt anew, until there are ``enough`` folders for all tasks;
    then each task walks its own.  Linked folders are not followed.
    """
    base = located(spark, root).rstrip("/")
    enough = enough or 4 * spark.sparkContext.defaultParallelism
    folders, n = spark.createDataFrame([(base or "/",)], "path string"), 1
    found = []
    while 0 < n < enough:
        level = staged(folders.repartition(n).mapInArrow(lister(False), LISTED), "listed")
        found.append(level.filter("not folder"))
        folders = level.filter("folder").select("path")
        n = folders.count()
    if n:
        found.append(folders.repartition(min(n, 16 * enough)).mapInArrow(lister(True), LISTED))
    files = found[0]
    for more in found[1:]:
        files = files.union(more)
    return files.select(F.lit(root).alias("root"), F.substring("path", len(base) + 2, 1 << 20).alias("rel_path"), "path", "length", "mtime")


def snapshots(spark: SparkSession, root: str) -> list[tuple[str, bool]]:
    """(stamp, complete) of the run folders below a root; names are the state, .complete marks a commit."""
    store = Store(spark, root)
    return [(name, store.exists(f"{root}/{name}/.complete")) for name, folder in store.names(root) if folder and name.startswith("20")]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of a file whose name may be hidden from Spark's readers; none if it does not exist.

    A task reads the file as a stream, so that its length does not matter to the driver.
    """
    if not Store(spark, path).exists(path):
        return spark.createDataFrame([], "value string")

    def run(batches):
        import io

        import pyarrow as pa

        for batch in batches:
            for address in batch.column(0).to_pylist():
                store, base = in_task(address)
                with store.open_input_stream(base) as data, io.TextIOWrapper(data, encoding="utf-8", errors="replace") as text:
                    while lines := text.readlines(1 << 20):
                        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    return spark.createDataFrame([(located(spark, path),)], "path string").mapInArrow(run, "value string")


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """(pattern): stripped non-empty lines of an exclude list; none if there is no such file."""
    return lines_of(spark, path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("pattern")).filter("pattern <> ''").distinct()


def write_patterns(patterns: DataFrame, path: str, dry_run: bool = False) -> int:
    """Writes an exclude list, sorted, one pattern a line; returns how many there are.  No line passes the driver."""
    rows = staged(patterns.select("pattern").distinct(), "patterns")
    if not dry_run:
        folder, _, name = path.rpartition("/")
        write_sorted(rows.select(F.lit(name).alias("name"), F.lit(1).alias("kind"), F.concat("pattern", F.lit("\n")).alias("text"), "pattern"), folder or ".", ["pattern"], "")
    return rows.count()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(old, new) of a rename log: a JSON object, one entry a line, or one as other tools lay it out; none if it is absent or no JSON
    object.  One of another layout is read whole, in one task."""
    lines = lines_of(spark, path).filter(~F.col("value").rlike(r"^\s*$"))
    entry = F.from_json(F.concat(F.lit("{"), F.regexp_replace("value", r",?\s*$", ""), F.lit("}")), "map<string,string>")
    by_line = lines.filter(~F.col("value").rlike(r"^\s*[{}]\s*$")).select(entry.alias("m"))
    if not by_line.filter("m is null or size(m) = 0").isEmpty():
        by_line = lines.agg(F.from_json(F.array_join(F.collect_list("value"), ""), "map<string,string>").alias("m"))
    return by_line.select(F.explode("m").alias("old", "new"))


def write_log(log: DataFrame, path: str, dry_run: bool = False) -> None:
    """Writes a rename log as a JSON object, one entry a line, sorted; of several entries of an old name the greatest new one stays."""
    if dry_run:
        return
    folder, _, name = path.rpartition("/")
    entries = log.groupBy("old").agg(F.max("new").alias("new"))
    quoted = lambda c: F.substring(F.to_json(F.struct(F.col(c).alias("x"))), 6, 1 << 30)  # noqa: E731  {"x":…}
    body = F.concat(F.lit("  "), F.regexp_replace(quoted("old"), r"\}$", ""), F.lit(": "), F.regexp_replace(quoted("new"), r"\}$", ""))
    rows = entries.select(F.lit(name).alias("name"), F.lit(1).alias("kind"), body.alias("text"), "old")
    ends = log.sparkSession.createDataFrame([(name, 0, "{\n", ""), (name, 2, "\n}\n", "")], "name string, kind int, text string, old string")
    write_sorted(staged(rows, "log").union(ends), folder or ".", ["old"], ",\n")


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and renames it, so readers see the old text or the new one."""
    Store(spark, path).put(path, text.encode())


def refresh(spark: SparkSession, source: str, target: str) -> bool:
    """Copies a database file with its side files, or a folder of shards; an absent or empty one is refused, and the old copy stays.

    All are copied beside their places before the first is renamed.  Side files of the copy before that the source no longer has go.
    """
    import os
    import shutil
    import uuid

    from missivelake.sources.sinks import copy_files
    from missivelake.sources.stores import plain

    source, target = plain(located(spark, source)), plain(located(spark, target))
    beside = f"{target}.tmp.{uuid.uuid4().hex}"
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    if os.path.isdir(source):
        found = inventory(spark, source)
        if copy_files(found.select(F.col("path").alias("source"), F.concat(F.lit(f"{beside}/"), "rel_path").alias("target"))) == 0:
            return False
        if os.path.isdir(target):
            os.rename(target, f"{beside}.old")
        os.rename(beside, target)
        shutil.rmtree(f"{beside}.old", ignore_errors=True)
        return True
    made = []
    try:
        if not os.path.isfile(source) or os.path.getsize(source) == 0:
            return False
        for tail in ("", "-wal", "-shm"):
            if os.path.isfile(source + tail):
                shutil.copy2(source + tail, beside + tail)
                made.append(tail)
        if os.path.getsize(beside) == 0:
            return False
        for tail in made:
            os.replace(beside + tail, target + tail)
        for tail in ("-wal", "-shm"):
            if tail not in made and os.path.exists(target + tail):
                os.remove(target + tail)  # of the copy before
        return True
    finally:
        for tail in made:
            if os.path.exists(beside + tail):
                os.remove(beside + tail)
