"""Duplicate removal by identity with an explicit order: which copy wins never depends on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.operators.ranks import ranked
from missivelake.sources.stores import staged


def first_wins(rows: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    A grouped min_by of the whole row: partial aggregation leaves one row a key and task, so a key with very
    many copies is no hot spot, unlike with a window.
    """
    rest = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*[F.col(k) for k in key], *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*rows.columns)


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, at the position of the first: adds ``first_<order>`` columns."""
    rest = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"), F.min(F.struct(*order)).alias("__first"))
    return picked.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest], *[F.col(f"__first.{c}").alias(f"first_{c}") for c in order])


def contribution(rows: DataFrame, key: list[str], order: list[str], source: str) -> DataFrame:
    """Per source: rows in, and rows that are the first of their key."""
    firsts = rows.groupBy(*key).agg(F.min_by(F.col(source), F.struct(*order)).alias(source)).groupBy(source).agg(F.count("*").alias("n_new"))
    return rows.groupBy(source).agg(F.count("*").alias("n_in")).join(firsts, source, "left").select(source, "n_in", F.coalesce("n_new", F.lit(0)).alias("n_new"))


def new_or_changed(source: DataFrame, target: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """Rows of ``source`` that ``target`` lacks or holds with other values; nothing is ever deleted."""
    there = target.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in compare])
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    return source.join(there, F.col(key) == F.col("__key"), "left").filter(F.col("__key").isNull() | differs).withColumn("change", F.when(F.col("__key").isNull(), F.lit("new")).otherwise(F.lit("changed"))).select(*source.columns, "change")


def numbered_names(rows: DataFrame, name: str, order: list[str], out: str = "output_name", taken: DataFrame | None = None) -> DataFrame:
    """Names that do not clash: the second bearer of a name gets _2 before the suffix, and so on.

    taken: (<name>) names that exist already; they count as first bearers.  Where a numbered name is itself a name of the input or a
    taken one, the number starts behind all numbers that are in use.  Places come from ranges, so that a name with very
    many bearers is no hot spot.
    """
    placed = ranked(rows, [name], order, "__place")
    names = rows.select(F.col(name).alias("__name"))
    if taken is not None:
        there = taken.select(F.col(name).alias("__there")).distinct()
        placed = placed.join(there, F.col(name) == F.col("__there"), "left").withColumn("__place", F.col("__place") + F.col("__there").isNotNull().cast("long")).drop("__there")
        names = names.union(there)
    placed = staged(placed, "places")
    part = lambda c, i: F.regexp_extract(c, r"^(.*?)(\.[^./]+)?$", i)
    numbered = lambda n: F.when(n == 1, F.col(name)).otherwise(F.concat(part(F.col(name), 1), F.lit("_"), n.cast("string"), part(F.col(name), 2)))
    first = placed.withColumn(out, numbered(F.col("__place")))
    names = names.filter("__name is not null").distinct()
    clashes = staged(first.filter("__place > 1").select(F.col(name).alias("__of"), F.col(out).alias("__out")).distinct().join(names, F.col("__out") == F.col("__name")).select("__of", "__out"), "clashes")
    number = F.try_to_number(F.regexp_extract(part(F.col("__name"), 1), r"_([0-9]{1,9})$", 1), F.lit("999999999")).cast("long")
    base = F.concat(F.regexp_replace(part(F.col("__name"), 1), r"_[0-9]{1,9}$", ""), part(F.col("__name"), 2))
    used = names.select(base.alias("__of"), number.alias("__n")).union(first.select(F.col(name), "__place")).groupBy("__of").agg(F.max("__n").alias("__last"))
    behind = clashes.join(used, "__of").select(F.col("__of").alias("__whose"), "__out", "__last")
    moved = first.join(behind, (F.col(name) == F.col("__whose")) & (F.col(out) == F.col("__out")), "left")
    return moved.withColumn(out, F.when(F.col("__last").isNull(), F.col(out)).otherwise(numbered(F.col("__last") + F.col("__place")))).select(*rows.columns, out)


def stash(files: DataFrame, name: str = "name", content: str = "content", order: str = "ord") -> DataFrame:
    """Content-addressed names: the same name and bytes once; other bytes under that name get a hash suffix."""
    from missivelake.functions import text as T

    digest = F.sha2(F.col(content), 256)
    copies = files.withColumn("__digest", digest).groupBy(name, "__digest").agg(F.min(order).alias("first"))
    first = copies.groupBy(name).agg(F.min_by("__digest", "first").alias("__kept"))
    tail = T.suffix(F.col(name))
    other = F.concat(T.stem(F.col(name)), F.lit("_"), F.substring("__digest", 1, 8), tail)
    return copies.join(first, name).select(F.col(name), F.col("__digest").alias("sha256"), "first", F.when(F.col("__digest") == F.col("__kept"), F.col(name)).otherwise(other).alias("stored_name"))
