import uuid

import pytest
from pyspark.sql import functions as F

from missivelake.functions import text as T


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "number"),
    [("40404", "40404"), ("+33 6 12 34", "+3361234"), ("(555) 000-0001", "+15550000001"), ("1-555-000-0001", "+15550000001"), ("12", None), ("123456789", None)],
)
def test_normalize_number(spark, raw, number):
    assert one(spark, T.normalize_number(F.col("a")), a=raw) == number


@pytest.mark.parametrize(("raw", "handle"), [("+1 (555) 000-0001", "5550000001"), ("123", "123"), (" Ann@Example.com\t", "ann@example.com"), ("٠١٢٣", "٠١٢٣")])
def test_norm_handle(spark, raw, handle):
    assert one(spark, T.norm_handle(F.col("a")), a=raw) == handle


@pytest.mark.parametrize(
    ("raw", "key"),
    [
        ("Jul 02, 2026  7:45:05 AM", "2026-07-02T07:45:05"),
        ("Jul 2, 2026 12:45:05 PM (Read by them)", "2026-07-02T12:45:05"),
        ("2025-06-15 12:00:00", "2025-06-15T12:00:00"),
        ("  at 2025-06-15T12:00 sharp", "2025-06-15T12:00"),
        ("some  text", "some text"),
        ("", ""),
    ],
)
def test_time_key(spark, raw, key):
    assert one(spark, T.time_key(F.col("a")), a=raw) == key


@pytest.mark.parametrize(("value", "iso"), [(700000000123456789, "2023-03-08T20:26:40+00:00"), (700000000, "2023-03-08T20:26:40+00:00"), (0, None)])
def test_apple_iso(spark, value, iso):
    assert one(spark, T.apple_iso(F.col("a")), a=value) == iso


def test_uuid5_equals_the_library(spark):
    found = one(spark, T.message_uuid(F.col("a"), F.col("b"), F.col("c")), a="2020-01-01T12:00:00-05:00", b="+1555", c="hé")
    assert found == str(uuid.uuid5(uuid.UUID(T.VOICE_NAMESPACE), "2020-01-01T12:00:00-05:00|+1555|hé")).upper()


def test_sanitizing_is_idempotent_and_whole_path(spark):
    clean = one(spark, T.sanitize_path(F.col("a")), a='sub:dir/pic?1[2]"|.jpg')
    assert clean == 'sub-dir/pic-1-2-"-.jpg'
    assert one(spark, T.sanitize_path(F.col("a")), a=clean) == clean
    assert one(spark, T.exclude_pattern(F.col("a")), a="a[1].jpg") == "a?1?.jpg"


def test_pattern_regex_matches_like_a_wildcard(spark):
    for pattern, name, hit in [("a?1?.jpg", "a[1].jpg", True), ("a?1?.jpg", "a[1]xjpg", False), ("a*", "a/b", True), ("(x)+.t", "(x)+.t", True)]:
        regex = one(spark, T.pattern_regex(F.col("a")), a=pattern)
        assert (one(spark, F.expr("a rlike b"), a=name, b=regex)) is hit


def test_reference_rewrite_leaves_plain_text(spark):
    html = '<img src="Attachments/a:b.jpg"> Attachments/a:b.jpg <a href="Attachments/a:b.jpg">'
    pairs = lambda **m: F.create_map(*[F.lit(x) for kv in m.items() for x in (f"Attachments/{kv[0]}", f"Attachments/{kv[1]}")])
    found = one(spark, T.replace_references(F.col("a"), F.create_map(F.lit("Attachments/a:b.jpg"), F.lit("Attachments/a-b.jpg"))), a=html)
    assert found == '<img src="Attachments/a-b.jpg"> Attachments/a:b.jpg <a href="Attachments/a-b.jpg">'
    # One pass: a new path is not taken for an old one, and what stands around stays.
    chain = '<a href="Attachments/x"><a href="Attachments/y"> src="Attachments/x$1"\n'
    assert one(spark, T.replace_references(F.col("a"), pairs(x="y", y="z$0")), a=chain) == '<a href="Attachments/y"><a href="Attachments/z$0"> src="Attachments/x$1"\n'
    for text in ("", "none", '"Attachments/x"'):
        assert one(spark, T.replace_references(F.col("a"), pairs(x="y")), a=text) == text


def test_resolve_path(spark):
    path = lambda a: tuple(one(spark, T.resolve_path(F.col("a"), F.lit("/x"), F.lit("/s")), a=a))
    assert path("~/L/Attachments/ab/p.jpg") == ("/x/ab/p.jpg", "ab/p.jpg")
    assert path("~/Attachments/StickerCache/p.png") == ("/s/p.png", "p.png")
    assert path("attachments/p.jpg") == (None, "attachments/p.jpg")


def test_group_name(spark):
    rows = spark.createDataFrame([(["+1", "+2", "+1"],), ([f"+155500000{k:02}" for k in range(30)],)], "m array<string>")
    short, long = (r[0] for r in rows.select(T.group_name(F.col("m"))).collect())
    assert short == "+1, +2"
    assert long.endswith("more") and len(long[: long.rindex(", +")].encode()) <= 160 and "+19 more" in long


def test_file_names(spark):
    assert one(spark, T.number_of_filename(F.col("a")), a="+15550000001 - Text - 2020.html") == "+15550000001"
    assert one(spark, T.number_of_filename(F.col("a")), a="Ann Lee - Text - 2020.html") is None
    assert one(spark, T.file_kind(F.col("a")), a="Ann_-_Missed_-_2020.html") == "Missed"
    assert one(spark, T.file_kind(F.col("a")), a="Group Conversation - 2020.html") == "Group"
    assert one(spark, T.stem(F.col("a")), a="x/a@b.c.html") == "a@b.c"


def test_display_time_drops_the_hours_zero_only(spark):
    assert one(spark, T.display_time(F.to_timestamp_ntz("a", F.lit("yyyy-MM-dd HH:mm:ss"))), a="2026-07-02 07:05:05") == "Jul 02, 2026 7:05:05 AM"
