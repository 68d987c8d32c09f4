"""Places of rows within their keys, and the first or last few of each key, without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from missivelake.sources.stores import staged


#: Characters of a text by which ranges are cut.
CUT = 300


def range_keys(rows: DataFrame, columns: list[str], sizes: dict[str, int] | None = None) -> list[Column]:
    """Keys that deal rows to ranges in the order of ``columns`` but hold only the start of each text, ``CUT`` characters or its own size.

    The driver samples the keys of ranges, so that they must not grow with the texts.  What stands behind a text that is longer
    than its start does not count: such rows of one start lie in one range, where they are sorted by the whole texts.
    """
    keys, whole = [], None
    for c in columns:
        size, value = (sizes or {}).get(c, CUT), F.col(c)
        text = isinstance(rows.schema[c].dataType, StringType)
        value = F.substring(value, 1, size) if text else value
        keys.append(value if whole is None else F.when(whole, value))
        if text and c != columns[-1]:
            here = F.coalesce(F.length(c) <= size, F.lit(True))
            whole = here if whole is None else whole & here
            keys.append(~whole)
    return keys


def numbered_in_task(keys: list[str]):
    """Numbers the rows of each key in a sorted partition; batches may cut a key."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, before, place = TaskContext.get().partitionId(), None, 0

        def changes(column, last):
            """Where a column differs from the row above, nulls being equal."""
            shifted = pa.concat_arrays([last, column.slice(0, len(column) - 1)])
            unequal = pc.fill_null(pc.not_equal(column, shifted), False)
            return pc.or_(unequal, pc.xor(pc.is_null(column), pc.is_null(shifted))).to_numpy(zero_copy_only=False)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            starts = np.zeros(batch.num_rows, bool)
            for column, last in zip(columns, before or [c.slice(0, 1) for c in columns], strict=True):
                starts |= changes(column, last)
            rows = np.arange(batch.num_rows)
            begun = np.maximum.accumulate(np.where(starts, rows, -1))
            places = np.where(begun >= 0, rows - begun + 1, place + rows + 1)
            place, before = int(places[-1]), [c.slice(batch.num_rows - 1) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(rows), part, np.int64)), pa.array(places.astype(np.int64))], names=[*batch.schema.names, "__part", "__place"])

    return run


def ranked(rows: DataFrame, key: list[str], order: list[str], out: str = "place") -> DataFrame:
    """Adds the place, from 1, of each row within its key in the given order; null keys are one key.

    Rows are dealt by ranges of key and order, so that a key with very many rows lies in many tasks.  Each counts its own; a
    range that goes on with the key of the one before adds how many rows of it came earlier.  At most one key a range goes on, so that
    these counts are as many rows as there are ranges, and are sent to all tasks.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([*rows.schema.fields, StructField("__part", LongType()), StructField("__place", LongType())])
    dealt = rows.repartitionByRange(n, *range_keys(rows, [*key, *order])).sortWithinPartitions(*key, *order)
    counted = staged(dealt.mapInArrow(numbered_in_task(key), schema), "ranked")
    sizes = counted.groupBy(*key, "__part").agg(F.max("__place").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(*key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    going_on = sizes.withColumn("__earlier", earlier).filter("__earlier > 0").select(F.col("__part").alias("__of"), *[F.col(k).alias(f"__key{i}") for i, k in enumerate(key)], "__earlier")
    same = F.col("__part") == F.col("__of")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"__key{i}"))
    joined = counted.join(F.broadcast(going_on), same, "left")
    return joined.select(*rows.columns, (F.col("__place") + F.coalesce("__earlier", F.lit(0))).alias(out))


def first_few(rows: DataFrame, key: list[str], order: list[Column | str], most: int, out: str = "place") -> DataFrame:
    """The first ``most`` rows of each key with their place, from 1.

    A rank below a bound is applied before the exchange too: each task passes on at most ``most`` rows a key.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn(out, place).filter(F.col(out) <= most)


def newest_and_oldest(rows: DataFrame, key: list[str], order: list[str], newest: int = 10, oldest: int = 5, out: str = "place") -> DataFrame:
    """The last ``newest`` rows of each key, the last one first, then its first ``oldest`` rows; a row may be among both."""
    last = first_few(rows, key, [F.desc(c) for c in order], newest, out)
    first = first_few(rows, key, [F.asc(c) for c in order], oldest, out)
    return last.union(first.withColumn(out, F.col(out) + newest))
