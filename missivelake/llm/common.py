"""Shared helpers: reading inputs, whole texts, and tables written to the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper and lower case of A-Z only; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a few ids each, some 16 MB, that are sent to every executor at most.
MOST_SENT = 1_000_000
#: Rows in one Arrow batch handed to Python; long texts must not add up to gigabytes.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reads one input table with Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch for the Python stages of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


_kept: dict[str, Any] = {}


def kept(owner: str, make: Callable[[], Any]) -> Any:
    """What the tasks of one operator keep in a Python worker, made when it is first asked for.

    Workers outlive stages.  What another operator kept goes first, so that a worker never holds the tables of several.
    """
    if owner not in _kept:
        if _kept:
            _kept.clear()
            give_back()
        _kept[owner] = make()
    return _kept[owner]


def give_back() -> None:
    """Returns freed memory to the system, which the allocators would keep for the process."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or in local mode a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="missivelake-"))
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes ``df`` as Parquet into the shared folder and reads it back.

    Unlike a cached or locally checkpointed frame, the copy outlives any executor.  Nothing reads the job's
    shuffles again, so they go as soon as it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/missivelake/{name}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def discard(*frames: DataFrame | None) -> None:
    """Deletes written tables that nothing reads any more; frames that were not written stay."""
    for frame in frames:
        path = getattr(frame, "__dict__", {}).pop("written_to", None)
        if path is not None:
            jvm = frame.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def is_empty(df: DataFrame) -> bool:
    """Whether a frame has no rows; the shuffles of the question go with it."""
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return df.isEmpty()


def sent(table: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """A written table of ids, to be sent whole to the executors while it has at most ``most`` rows; else as it is."""
    return F.broadcast(table) if table.count() <= most else table


def rows_of_finite(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is not null, not empty, and has neither null nor non-finite components."""
    unusable = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.filter((F.size(column) > 0) & ~F.exists(column, unusable))


def rows_without(docs: DataFrame, keys: DataFrame, *own: Column) -> DataFrame:
    """The rows of ``docs`` whose expressions ``own`` are in no row of ``keys``, column by column; null equals null.

    The keys are written and, while they are few, sent to the rows, whose texts then stay where they are.  They get names of
    their own, so that any column name may stand in ``docs``.
    """
    tag = uuid.uuid4().hex
    named = sent(written(keys.select(*[F.col(c).alias(f"{c}-{tag}") for c in keys.columns]), "keys"))
    same = [o.eqNullSafe(F.col(f"`{c}`")) for o, c in zip(own, named.columns, strict=True)]
    return docs.join(named, reduce(Column.__and__, same), "left_anti")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for one job, put back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Deals small rows that are about to be multiplied to as many tasks as there are shuffle partitions;
    without a stated number AQE would gather them in a few tasks by their size before."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
