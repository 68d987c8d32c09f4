"""A data source that writes text files from sorted pieces: pages, documents and lists of any length, without a row for each.

Rows are pieces (name, kind, text), dealt by ranges of name and order and sorted within them, so that a file with very many pieces is
written by many tasks.  A task streams its pieces into one staged part a file.  Only what committed tasks have staged counts: the
job's commit writes their list, an abort deletes everything staged.  Then parts become files: a part that is a whole file is renamed,
those of a file that spans several ranges are joined in order, by tasks that read them as streams.  Each step can be carried out again.

Between neighbouring pieces of a file with the same odd kind stands the separator; even kinds are heads, middles and tails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from missivelake.operators.ranks import range_keys
from missivelake.sources.stores import Store, in_task, located

NAMES, COMMIT = "names.json", "commit.json"
#: Characters gathered before they are written.
BUFFER = 1 << 20


class Staged(WriterCommitMessage):
    """What one task has staged: its folder, and its files' names and kinds at both ends."""

    def __init__(self, part: int, folder: str, files: int, first: tuple | None, last: tuple | None):
        self.part, self.folder, self.files, self.first, self.last = part, folder, files, first, last


class SortedFilesWriter(DataSourceArrowWriter):
    def __init__(self, staging: str, separator: str):
        self.staging, self.separator = staging, separator

    def write(self, batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        folder = f"{self.staging}/{context.partitionId():06d}-{context.taskAttemptId()}"
        store, base = in_task(folder)
        store.create_dir(base, recursive=True)
        names, ends, stream, held, size = [], [], None, [], 0
        try:
            for batch in batches:
                for name, kind, text in zip(*(batch.column(c).to_pylist() for c in ("name", "kind", "text")), strict=True):
                    if not names or name != names[-1]:
                        if stream is not None:
                            stream.write("".join(held).encode())
                            stream.close()
                        stream, held, size = store.open_output_stream(f"{base}/{len(names)}"), [], 0
                        names.append(name)
                        ends.append([kind, kind])
                    elif kind % 2 and ends[-1][1] == kind:
                        held.append(self.separator)
                    ends[-1][1] = kind
                    held.append(text)
                    size += len(text)
                    if size >= BUFFER:
                        stream.write("".join(held).encode())
                        held, size = [], 0
        finally:
            if stream is not None:
                stream.write("".join(held).encode())
                stream.close()
        with store.open_output_stream(f"{base}/{NAMES}") as out:
            out.write(json.dumps(names).encode())
        at = lambda i: (names[i], *ends[i])
        return Staged(context.partitionId(), folder, len(names), at(0) if names else None, at(-1) if names else None)

    def commit(self, messages):
        done = sorted((m for m in messages if m is not None and m.files), key=lambda m: m.part)
        store, base = in_task(self.staging)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{COMMIT}") as out:
            out.write(json.dumps([(m.folder, m.files, m.first, m.last) for m in done]).encode())

    def abort(self, messages):
        from pyarrow import fs

        store, base = in_task(self.staging)
        if store.get_file_info(base).type != fs.FileType.NotFound:
            store.delete_dir(base)


class SortedFiles(DataSource):
    """``df.write.format("sorted_files").option("staging", ...)``: stages sorted (name, kind, text) rows."""

    @classmethod
    def name(cls):
        return "sorted_files"

    def writer(self, schema, overwrite):
        return SortedFilesWriter(self.options["staging"], self.options.get("separator", "\n"))


def spans(done: list) -> tuple[list[tuple], list[tuple]]:
    """(joins, moves) of the staged folders in order: (name, [(path, separated from the one before)]) of files in several
    folders, and (folder, first, last file to move) of the rest."""
    parts: list[list] = []  # neighbouring ends of one name
    for folder, files, first, last in done:
        if parts and parts[-1][0] == first[0]:
            parts[-1][1].append((f"{folder}/0", first[1] % 2 == 1 and parts[-1][2] == first[1]))
        else:
            parts.append([first[0], [(f"{folder}/0", False)], None])
        if files > 1:
            parts.append([last[0], [(f"{folder}/{files - 1}", False)], None])
        parts[-1][2] = last[2]
    joined = [(name, pieces) for name, pieces, _ in parts if len(pieces) > 1]
    apart = {path for _, pieces in joined for path, _ in pieces}
    moves = [(folder, int(f"{folder}/0" in apart), files - int(files > 1 and f"{folder}/{files - 1}" in apart)) for folder, files, _, _ in done]
    return joined, [m for m in moves if m[1] < m[2]]


def publish(target: str, separator: str):
    """Moves or joins staged parts to their places; a repeated call finds what is done."""

    def place(store, staged: str, path: str):
        from pyarrow import fs

        if store.get_file_info(staged).type == fs.FileType.NotFound:
            return  # an earlier attempt has moved it
        store.create_dir(path.rpartition("/")[0], recursive=True)
        store.move(staged, path)

    def run(batches):
        import pyarrow as pa

        store, base = in_task(target)
        for batch in batches:
            n = 0
            for row in batch.to_pylist():
                if row["folder"] is not None:
                    _, folder = in_task(row["folder"])
                    names = json.loads(store.open_input_stream(f"{folder}/{NAMES}").read())
                    for i in range(row["first"], row["last"]):
                        place(store, f"{folder}/{i}", f"{base}/{names[i]}")
                    n += row["last"] - row["first"]
                    continue
                beside = f"{in_task(row['parts'][0])[1]}.joined.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    for part, separated in zip(row["parts"], row["separated"], strict=True):
                        if separated:
                            out.write(separator.encode())
                        with store.open_input_stream(in_task(part)[1]) as data:
                            while block := data.read(BUFFER):
                                out.write(block)
                place(store, beside, f"{base}/{row['name']}")
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return run


def write_sorted(pieces: DataFrame, folder: str, order: list[Column | str], separator: str = "\n") -> int:
    """Writes the files of (name, kind, text) pieces, sorted by kind and ``order`` within each, below ``folder``; returns how many.

    A null text is an empty piece; a null name has no file.  Names may hold folders.  An existing file is replaced whole.
    """
    spark: SparkSession = pieces.sparkSession
    spark.dataSource.register(SortedFiles)
    target = located(spark, folder)
    staging = f"{target}/_staging-{uuid.uuid4().hex}"
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    named = pieces.filter(F.col("name").isNotNull()).select("name", F.col("kind").cast("int").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), *[k.alias(f"__{i}") for i, k in enumerate(keys)])
    by = ["name", "kind", *[f"__{i}" for i in range(len(keys))], "text"]
    keys = range_keys(named, by, {"text": 64})
    dealt = named.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*by).select("name", "kind", "text")
    dealt.write.format("sorted_files").mode("append").option("staging", staging).option("separator", separator).save()
    store = Store(spark, target)
    done = json.loads(store.read(f"{staging}/{COMMIT}") or b"[]")  # one entry a task
    joins, moves = spans(done)
    rows = [(None, 0, 0, name, [p for p, _ in parts], [s for _, s in parts]) for name, parts in joined_first(joins)] + [(*m, None, None, None) for m in moves]
    n = 0
    if rows:
        plan = spark.createDataFrame(rows, "folder string, first long, last long, name string, parts array<string>, separated array<boolean>")
        n = plan.repartition(len(rows)).mapInArrow(publish(target, separator), "n long").agg(F.sum("n")).first()[0]
    store.delete(staging)
    return n


def joined_first(joins: list[tuple]) -> list[tuple]:
    """The files of most parts first, as they take longest."""
    return sorted(joins, key=lambda j: -len(j[1]))
