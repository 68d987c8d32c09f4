"""Contact books: union, handle map, names, and conversations grouped by person."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T

#: Fixed value: the distance between the key ranges of united books, beyond the base book's largest key.
KEY_STRIDE = 1_000_000


def union_books(books: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """One book of several: keys of the i-th are shifted by i strides, those of the first stay.

    Each book maps record, phone and email to its tables; absent tables are skipped, absent columns are null.
    """
    if not books:
        return {}
    largest = books[0]["record"].agg(F.coalesce(F.max("Z_PK"), F.lit(0))).first()[0]
    offset = largest + KEY_STRIDE
    out = {}
    for name, key in (("record", "Z_PK"), ("phone", "ZOWNER"), ("email", "ZOWNER")):
        parts = [b[name].withColumn(key, F.col(key) + i * offset) for i, b in enumerate(books) if name in b]
        if parts:
            out[name] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out


def handle_map(books: list[dict[str, DataFrame]]) -> DataFrame:
    """(norm_handle, person_key, display_name): the last entry of a handle wins, books in order, phones
    before e-mails.  Persons of different books stay different persons.  Books without records are skipped."""
    parts = []
    for i, book in enumerate(books):
        if "record" not in book:
            continue
        names = book["record"].select(F.col("Z_PK").alias("__pk"), T.contact_name(F.col("ZFIRSTNAME"), F.col("ZLASTNAME"), F.col("ZORGANIZATION"), F.col("Z_PK")).alias("display_name"))
        for j, (table, column) in enumerate((("phone", "ZFULLNUMBER"), ("email", "ZADDRESS"))):
            if table not in book:
                continue
            rows = book[table].filter(F.col("ZOWNER").isNotNull() & (F.coalesce(F.col(column), F.lit("")) != ""))
            row_order = F.col("ROWID") if "ROWID" in rows.columns else F.col("ZOWNER")
            rows = rows.select(T.norm_handle(F.col(column)).alias("norm_handle"), F.col("ZOWNER").alias("owner"), F.struct(F.lit(i).alias("book"), F.lit(j).alias("table"), row_order.cast("long").alias("row"), F.col(column).alias("raw")).alias("ord"))
            rows = rows.join(names, F.col("owner") == F.col("__pk"), "left").withColumn("display_name", F.coalesce("display_name", F.concat(F.lit("record"), F.col("owner").cast("string"))))
            parts.append(rows.select("norm_handle", F.concat(F.lit(f"{i}:"), F.col("owner").cast("string")).alias("person_key"), "display_name", "ord"))
    if not parts:
        raise ValueError("no contact book with records")
    entries = reduce(DataFrame.unionByName, parts).filter("norm_handle <> ''")
    return last_entry(entries, "norm_handle", ["person_key", "display_name"])


def last_entry(entries: DataFrame, key: str, columns: list[str], ord_column: str = "ord") -> DataFrame:
    """The last entry of each key."""
    return entries.groupBy(key).agg(F.max_by(F.struct(*columns), ord_column).alias("v")).select(key, *[F.col(f"v.{c}").alias(c) for c in columns])


def numbers_by_name(handles: DataFrame) -> DataFrame:
    """(name, numbers, number): all-digit handles by lower-cased name; ``number`` is the first."""
    rows = handles.filter(F.col("norm_handle").rlike("^[0-9]+$"))
    return rows.groupBy(F.lower("display_name").alias("name")).agg(F.array_sort(F.collect_list("norm_handle")).alias("numbers"), F.min("norm_handle").alias("number"))


def leading(counted: DataFrame, group: Column | str, name: str, order: str, *more: Column) -> DataFrame:
    """(group_key, output_name, n_messages): the ``name`` with the largest ``n`` of each group, the first of equal ones by ``order``, and
    the sum; ``more`` aggregates go along."""
    first = F.max_by(name, F.struct("n", F.negative(order))).alias("output_name")
    return counted.groupBy((F.col(group) if isinstance(group, str) else group).alias("group_key")).agg(first, F.sum("n").alias("n_messages"), *more)


def plan_groups(files: DataFrame, handles: DataFrame) -> DataFrame:
    """Files by person: (person_key, display_name, files, n_messages, output_name).

    files: (file, file_ord, text).  A file's handle is its stem; files without a known handle form groups of
    their own with a null person_key.  Files are listed by falling count of distinct ids, then input order;
    the first of them names the output.
    """
    counted = files.select("file", "file_ord", F.size(F.array_distinct(T.guids(F.col("text")))).cast("long").alias("n"), T.norm_handle(T.stem(F.col("file"))).alias("norm_handle"))
    joined = counted.join(handles, "norm_handle", "left")
    group = F.coalesce("person_key", F.concat(F.lit("file:"), F.col("file")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "file_ord", "file", "n"))), lambda r: F.struct(r["file"].alias("file"), r["n"].alias("n")))
    grouped = leading(joined, group, "file", "file_ord", F.first("person_key").alias("person_key"), F.min("display_name").alias("display_name"), listed.alias("files"))
    return grouped.select("person_key", "display_name", "files", "n_messages", "output_name")


def standalone(files: DataFrame, handles: DataFrame) -> DataFrame:
    """Files whose handle no contact has."""
    return files.withColumn("norm_handle", T.norm_handle(T.stem(F.col("file")))).join(handles.select("norm_handle"), "norm_handle", "left_anti").select(*files.columns)
