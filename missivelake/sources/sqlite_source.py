"""SQLite tables as a Spark data source: read by rowid ranges, followed as a stream, written as shards.

``register(spark)`` and then
``spark.read.format("sqlite").option("path", file).option("dbtable", "message").load()``.
A path is one store's file, or a folder with a folder of shards for each table, as ``df.write.format("sqlite")`` makes it: each task
writes a file of its own, and files count once their job has committed.  Files must be readable under the same path by every
executor, and are never changed by reading.  Comparisons of columns with literals are pushed into the scan.  Bytes that are no UTF-8
become replacement characters.

As a stream, a table's offset is the largest rowid read of each file, so that a restarted query goes on where its checkpoint ends.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: Columns read from known tables; other tables take their declared types.
SCHEMAS = {
    "message": "ROWID bigint, guid string, date bigint",
    "attachment": "ROWID bigint, filename string, transfer_name string",
    "message_attachment_join": "message_id bigint, attachment_id bigint",
    "chat": "ROWID bigint, display_name string, chat_identifier string",
    "chat_message_join": "chat_id bigint, message_id bigint",
    "chat_handle_join": "chat_id bigint, handle_id bigint",
    "handle": "ROWID bigint, id string",
    "ZABCDRECORD": "Z_PK bigint, ZFIRSTNAME string, ZLASTNAME string, ZORGANIZATION string",
    "ZABCDPHONENUMBER": "ROWID bigint, ZOWNER bigint, ZFULLNUMBER string",
    "ZABCDEMAILADDRESS": "ROWID bigint, ZOWNER bigint, ZADDRESS string",
}
#: Columns of known tables that are read where a store has them.
OPTIONAL = {"message": {"text": "string", "is_from_me": "bigint", "handle_id": "bigint"}}
ROWS_EACH = 200_000
#: The columns that are a table's rowid, and the ending of a committed shard.
KEYS, SHARD = ("ROWID", "Z_PK"), ".db"
OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def connect(path: str) -> sqlite3.Connection:
    """A read-only connection; the file is never created or changed."""
    db = sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)
    db.text_factory = lambda b: b.decode("utf-8", "replace")
    return db


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def shards(path: str, table: str) -> list[str]:
    """The files that hold a table: the store itself, or the committed shards of its folder."""
    if not os.path.isdir(path):
        return [path]
    folder = os.path.join(path, table)
    return sorted(os.path.join(folder, n) for n in os.listdir(folder) if n.endswith(SHARD)) if os.path.isdir(folder) else []


def bounds(path: str, table: str) -> tuple[int | None, int | None] | None:
    """The least and the largest rowid; None for a table or view without rowids."""
    with connect(path) as db:
        try:
            return db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(table)}").fetchone()
        except sqlite3.OperationalError:
            return None


def selected(path: str, table: str, schema: StructType, where: list[str], values: list) -> Iterator[tuple]:
    """The rows of a table as Spark's types."""
    columns = ", ".join(quoted(c) for c in schema.names)
    kinds = [f.dataType.typeName() for f in schema.fields]
    query = f"SELECT {columns} FROM {quoted(table)}" + (" WHERE " + " AND ".join(where) if where else "")
    with connect(path) as db:
        for row in db.execute(query, values):
            yield tuple(None if v is None else _as(v, k) for v, k in zip(row, kinds))


@dataclass
class Range(InputPartition):
    path: str
    low: int | None
    high: int | None


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, rows_each: int):
        self.path, self.table, self.schema, self.rows_each = path, table, schema, rows_each
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        names = set(self.schema.names)
        for f in filters:
            attribute = getattr(f, "attribute", ())
            if len(attribute) != 1 or attribute[0] not in names:
                yield f
            elif type(f) in OPERATORS and isinstance(f.value, (int, str)):
                self.where.append(f"{quoted(attribute[0])} {OPERATORS[type(f)]} ?")
                self.values.append(f.value)
            elif isinstance(f, IsNotNull):
                self.where.append(f"{quoted(attribute[0])} IS NOT NULL")
            elif isinstance(f, In) and len(f.value) <= 500 and all(isinstance(v, (int, str)) for v in f.value):
                self.where.append(f"{quoted(attribute[0])} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            else:
                yield f

    def partitions(self) -> list[Range]:
        files = shards(self.path, self.table)
        if len(files) != 1:  # shards are about as large as the tasks that wrote them
            return [Range(f, None, None) for f in files]
        ends = bounds(files[0], self.table)
        if ends is None:
            return [Range(files[0], None, None)]
        low, high = ends
        return [Range(files[0], k, min(k + self.rows_each, high + 1)) for k in range(low, high + 1, self.rows_each)] if low is not None else []

    def read(self, partition: Range | None) -> Iterator[tuple]:
        if partition is None:  # an empty table has no ranges
            return
        where, values = list(self.where), list(self.values)
        if partition.low is not None:
            where.append("rowid >= ? AND rowid < ?")
            values += [partition.low, partition.high]
        yield from selected(partition.path, self.table, self.schema, where, values)


class SqliteStream(DataSourceStreamReader):
    """New rows by rowid: an offset maps each file's name to the largest rowid that was read."""

    def __init__(self, path: str, table: str, schema: StructType, rows_each: int):
        self.path, self.table, self.schema, self.rows_each = path, table, schema, rows_each

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        ends = {os.path.basename(f): bounds(f, self.table) for f in shards(self.path, self.table)}
        return {name: e[1] for name, e in ends.items() if e and e[1] is not None}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for f in shards(self.path, self.table):
            name = os.path.basename(f)
            low, high = start.get(name), end.get(name)
            if high is not None:
                low = low + 1 if low is not None else bounds(f, self.table)[0]
                out += [Range(f, k, min(k + self.rows_each, high + 1)) for k in range(low, high + 1, self.rows_each)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from selected(partition.path, self.table, self.schema, ["rowid >= ? AND rowid < ?"], [partition.low, partition.high])

    def commit(self, end: dict) -> None:
        """The store is not ours: nothing is deleted."""


class Shard(WriterCommitMessage):
    def __init__(self, staged: str):
        self.staged = staged


class SqliteWriter(DataSourceWriter):
    """A file a task, renamed when the job commits."""

    def __init__(self, path: str, table: str, schema: StructType):
        self.folder, self.table, self.schema = os.path.join(path, table), table, schema

    def write(self, iterator) -> Shard:
        from pyspark import TaskContext

        os.makedirs(self.folder, exist_ok=True)
        context = TaskContext.get()
        staged = os.path.join(self.folder, f"part-{context.partitionId():06d}{SHARD}.{context.taskAttemptId()}")
        kinds = {"long": "INTEGER", "integer": "INTEGER", "double": "REAL", "binary": "BLOB"}
        columns = [f"{quoted(f.name)} {kinds.get(f.dataType.typeName(), 'TEXT')}{' PRIMARY KEY' if f.name in KEYS else ''}" for f in self.schema.fields]
        with sqlite3.connect(staged) as db:
            db.execute(f"CREATE TABLE {quoted(self.table)} ({', '.join(columns)})")
            db.executemany(f"INSERT INTO {quoted(self.table)} VALUES ({', '.join('?' * len(columns))})", (tuple(r) for r in iterator))
        db.close()
        return Shard(staged)

    def commit(self, messages: list[Shard]) -> None:
        for m in messages:
            if m is not None:
                os.replace(m.staged, m.staged.rpartition(".")[0])

    def abort(self, messages: list[Shard]) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.staged):
                os.remove(m.staged)


def _as(value, kind: str):
    if kind == "string":
        return value if isinstance(value, str) else value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)
    if kind == "long":
        return int(value)
    if kind == "double":
        return float(value)
    return value


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        table = self.options["dbtable"]
        files = shards(self.options["path"], table)
        if not files:
            raise ValueError(f"no table {table}")
        with connect(files[0]) as db:
            columns = db.execute(f"PRAGMA table_info({quoted(table)})").fetchall()
        if table in SCHEMAS:
            there = {c[1] for c in columns}
            return ", ".join([SCHEMAS[table], *[f"{c} {kind}" for c, kind in OPTIONAL.get(table, {}).items() if c in there]])
        if not columns:
            raise ValueError(f"no table {table}")
        kind = lambda t: "bigint" if "INT" in t.upper() else "double" if any(x in t.upper() for x in ("REAL", "FLOA", "DOUB")) else "binary" if "BLOB" in t.upper() else "string"
        return ", ".join(f"`{c[1]}` {kind(c[2] or '')}" for c in columns)

    def _place(self) -> tuple[str, str]:
        return self.options["path"], self.options["dbtable"]

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(*self._place(), schema, int(self.options.get("rowseach", ROWS_EACH)))

    def streamReader(self, schema: StructType) -> SqliteStream:
        return SqliteStream(*self._place(), schema, int(self.options.get("rowseach", ROWS_EACH)))

    def writer(self, schema: StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(*self._place(), schema)


def table_names(path: str) -> list[str]:
    if os.path.isdir(path):
        return sorted(n for n in os.listdir(path) if shards(path, n))
    with connect(path) as db:
        return sorted(r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'"))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    register(spark)
    return spark.read.format("sqlite").option("path", path).option("dbtable", table).load()


def follow_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table as a stream of its new rows."""
    register(spark)
    return spark.readStream.format("sqlite").option("path", path).option("dbtable", table).load()


def write_tables(path: str, tables: dict[str, DataFrame]) -> str:
    """Writes tables as shards below a folder, a file a task; they are read again by the folder's path."""
    for name, rows in tables.items():
        register(rows.sparkSession)
        rows.write.format("sqlite").mode("append").option("path", path).option("dbtable", name).save()
    return path


def read_messages(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The seven tables of a message store."""
    names = ("message", "attachment", "message_attachment_join", "chat", "chat_message_join", "chat_handle_join", "handle")
    return {n: read_table(spark, path, n) for n in names}


def read_book(spark: SparkSession, path: str) -> dict[str, DataFrame] | None:
    """record, phone and email tables as far as they exist; None for an unreadable store or one without records."""
    try:
        there = set(table_names(path))
    except sqlite3.Error:
        return None
    if "ZABCDRECORD" not in there:
        return None
    wanted = {"record": "ZABCDRECORD", "phone": "ZABCDPHONENUMBER", "email": "ZABCDEMAILADDRESS"}
    return {k: read_table(spark, path, t) for k, t in wanted.items() if t in there}


def book_paths(folder: str) -> list[str]:
    """The main book, then those of the accounts in order of their folders."""
    import glob

    main = os.path.join(folder, "AddressBook-v22.abcddb")
    rest = sorted(glob.glob(os.path.join(glob.escape(folder), "Sources", "*", "AddressBook-v22.abcddb")))
    return [p for p in [main, *rest] if os.path.exists(p)]


def integrity(path: str) -> tuple[str, str, str]:
    """(integrity, messages, attachments) of a snapshot; an unreadable one gives (error:…, ?, ?)."""
    try:
        with connect(path) as db:
            check = db.execute("PRAGMA integrity_check").fetchone()[0]
            counts = [str(db.execute(f"SELECT count(*) FROM {t}").fetchone()[0]) for t in ("message", "attachment")]
        return check, *counts
    except sqlite3.Error as e:
        return f"error:{e}", "?", "?"


def integrity_of(spark: SparkSession, path: str) -> tuple[str, str, str]:
    """:func:`integrity` of a store's file, or of all shards of a folder, which tasks check; the first fault stands for all."""
    if not os.path.isdir(path):
        return integrity(path)
    files = [(f,) for name in table_names(path) for f in shards(path, name)]

    def check(batches):
        import pyarrow as pa

        for batch in batches:
            told = []
            for f in batch.column(0).to_pylist():
                try:
                    with connect(f) as db:
                        told.append(db.execute("PRAGMA integrity_check").fetchone()[0])
                except sqlite3.Error as e:
                    told.append(f"error:{e}")
            yield pa.RecordBatch.from_arrays([pa.array(told, pa.string())], names=["told"])

    if not files:
        return "error:no shards", "?", "?"
    bad = spark.createDataFrame(files, "path string").repartition(len(files)).mapInArrow(check, "told string").filter("told <> 'ok'").agg(F.min("told")).first()[0]
    if bad is not None:
        return bad, "?", "?"
    return "ok", *[str(read_table(spark, path, t).count()) for t in ("message", "attachment")]
