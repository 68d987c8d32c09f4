import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from missivelake.operators import audit, contacts, dedup, participants, sanitize, threads
from missivelake.sources import files, html_pages, sinks, sqlite_source
from missivelake.streaming import incremental

G = "AAAAAAAA-0000-4000-8000-{:012d}".format


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("db") / "chat.db")
    with sqlite3.connect(path) as db:
        db.executescript(
            """CREATE TABLE message (ROWID INTEGER PRIMARY KEY, guid TEXT, date INTEGER);
            CREATE TABLE attachment (ROWID INTEGER PRIMARY KEY, filename TEXT, transfer_name TEXT);
            CREATE TABLE message_attachment_join (message_id INTEGER, attachment_id INTEGER);
            CREATE TABLE chat (ROWID INTEGER PRIMARY KEY, display_name TEXT, chat_identifier TEXT);
            CREATE TABLE chat_message_join (chat_id INTEGER, message_id INTEGER);
            CREATE TABLE chat_handle_join (chat_id INTEGER, handle_id INTEGER);
            CREATE TABLE handle (ROWID INTEGER PRIMARY KEY, id TEXT);"""
        )
        db.executemany("INSERT INTO message VALUES (?,?,?)", [(1, G(1), 700000000123456789), (2, G(2), 700000000), (3, G(3), 0), (4, G(4), None)])
        db.executemany(
            "INSERT INTO attachment VALUES (?,?,?)",
            [(1, "~/L/Attachments/ab/pic.jpg", "pic.jpg"), (2, "~/L/Attachments/ab/zero.jpg", ""), (3, "~/L/Attachments/ab/gone.jpg", None), (4, "x/StickerCache/s?1.png", None), (5, "elsewhere/x.jpg", "x"), (6, None, None), (7, "~/attachments/low.jpg", None)],
        )
        db.executemany("INSERT INTO message_attachment_join VALUES (?,?)", [(1, 1), (2, 1), (1, 2), (2, 3), (3, 4), (1, 5), (4, 7)])
        db.executemany("INSERT INTO chat VALUES (?,?,?)", [(1, "", "chat100"), (2, "Named", "chat200"), (3, None, "chat300")])
        db.executemany("INSERT INTO chat_message_join VALUES (?,?)", [(1, 1), (2, 1), (1, 2), (3, 3), (2, 4)])
        db.executemany("INSERT INTO chat_handle_join VALUES (?,?)", [(1, 11), (1, 10), (2, 10)])
        db.executemany("INSERT INTO handle VALUES (?,?)", [(10, "+15550000001"), (11, "+15550000000")])
    return path


def book(path, records, phones=None, emails=None):
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE ZABCDRECORD (Z_PK INTEGER PRIMARY KEY, ZFIRSTNAME TEXT, ZLASTNAME TEXT, ZORGANIZATION TEXT)")
        db.executemany("INSERT INTO ZABCDRECORD VALUES (?,?,?,?)", records)
        if phones is not None:
            db.execute("CREATE TABLE ZABCDPHONENUMBER (ZOWNER INTEGER, ZFULLNUMBER TEXT)")
            db.executemany("INSERT INTO ZABCDPHONENUMBER VALUES (?,?)", phones)
        if emails is not None:
            db.execute("CREATE TABLE ZABCDEMAILADDRESS (ZOWNER INTEGER, ZADDRESS TEXT)")
            db.executemany("INSERT INTO ZABCDEMAILADDRESS VALUES (?,?)", emails)
    return str(path)


def test_sqlite_source_splits_and_pushes(spark, store):
    sqlite_source.register(spark)
    df = spark.read.format("sqlite").option("path", store).option("dbtable", "message").option("rowsEach", 2).load()
    assert df.rdd.getNumPartitions() == 2
    assert [r["ROWID"] for r in df.filter("ROWID >= 2 and date is not null").orderBy("ROWID").collect()] == [2, 3]
    assert sqlite_source.integrity(store) == ("ok", "4", "7")
    assert sqlite_source.integrity(store + ".none")[1:] == ("?", "?")


def test_audit_of_a_store(spark, store, tmp_path):
    refs = audit.attachment_references(sqlite_source.read_messages(spark, store))
    rows = refs.collect()
    assert len(rows) == 8  # one attachment on two messages, one message in two chats; null and other paths go
    assert {r["chat_name"] for r in rows} == {"+15550000000, +15550000001", "Named", "chat300"}
    inventory = spark.createDataFrame([("/a/ab/pic.jpg", 5), ("/a/ab/zero.jpg", 0)], "path string, length bigint")
    patterns = spark.createDataFrame([("s?1.png",)], "pattern string")
    done = audit.classify(refs, inventory, patterns, "/a", "/s").cache()
    total = audit.totals(done).first()
    assert (total["ok"], total["zero_byte"], total["missing"], total["referenced"]) == (4, 2, 2, 8)
    path = tmp_path / "audit.json"
    assert sinks.write_document(audit.document_pieces(done, "now", "db", "/a"), str(path), audit.RECORD_ORDER)
    document = json.loads(path.read_text())
    assert list(document) == ["generated", "snapshot_db", "shared_attachments", "totals", "zero_byte", "missing"]
    assert document["totals"] == {"ok": 4, "zero_byte": 2, "missing": 2, "referenced": 8}
    assert [len(document["zero_byte"]), len(document["missing"])] == [2, 2] and document["missing"][0]["file"] in ("ab/gone.jpg", "gone.jpg", "~/attachments/low.jpg")
    # O1: oldest first, undated last.
    problems = [(r["status"], r["sent"] is None, r["sent"] or "", r["chat"], r["file"]) for r in audit.problems(done).collect()]
    assert problems == sorted(problems) and len(problems) == 4
    sinks.write_document(audit.document_pieces(done.limit(0), "now", "db", "/a"), str(path), audit.RECORD_ORDER)
    assert json.loads(path.read_text())["missing"] == []
    assert any("Named" in r["line"] for r in audit.report_lines(done).collect())


def test_kept_inventories_meet_without_an_exchange(spark):
    from missivelake.sources.stores import bucketed

    rows = spark.range(200).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"), F.col("id").alias("length"))
    refs = bucketed(rows.select("path", F.col("length").alias("k")).union(rows.select("path", F.col("length") + 1000)), "path", "refs", 4)
    before, after = bucketed(rows.filter("length % 10 <> 3"), "path", "inventory", 4), bucketed(rows.filter("length % 10 <> 4").withColumn("length", F.expr("if(length % 10 = 5, 0, if(length % 10 = 6, length + 1, length))")), "path", "inventory", 4)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = audit.changed_paths(before, after)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        changes = audit.audit_changes(refs, before, after)
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 1  # the few that changed go to the references
        rows = sorted((r["k"], r["was"], r["now"]) for r in changes.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    wanted = [(k + d, {3: "missing", 4: "ok", 5: "ok"}[k % 10], {3: "ok", 4: "missing", 5: "zero_byte"}[k % 10]) for d in (0, 1000) for k in range(200) if k % 10 in (3, 4, 5)]
    assert rows == sorted(wanted)
    assert audit.audit_changes(refs, before, before).count() == 0


def test_contact_union_and_handles(spark, tmp_path):
    a = sqlite_source.read_book(spark, book(tmp_path / "a", [(1, "Ann", "Lee", None), (2, None, None, "Org")], [(1, "(555) 000-0001"), (None, "1"), (2, "--")], [(1, " Ann@Example.com ")]))
    b = sqlite_source.read_book(spark, book(tmp_path / "b", [(1, "Bob", "", None), (3, None, None, None)], [(1, "+1 555 000 0001"), (3, "777"), (9, "888")]))
    united = contacts.union_books([a, b])
    assert sorted(r["Z_PK"] for r in united["record"].collect()) == [1, 2, 1000003, 1000005]
    found = {r["norm_handle"]: (r["person_key"], r["display_name"]) for r in contacts.handle_map([a, b]).collect()}
    assert found == {"5550000001": ("1:1", "Bob"), "ann@example.com": ("0:1", "Ann Lee"), "777": ("1:3", "record3"), "888": ("1:9", "record9")}
    pages = spark.createDataFrame([("+15550000001.html", 0, G(1)), ("Ann@example.com.html", 1, G(1) + " " + G(2)), ("stray.html", 2, "")], "file string, file_ord int, text string")
    plan = {r["output_name"]: r["person_key"] for r in contacts.plan_groups(pages, contacts.handle_map([a, b])).collect()}
    assert plan == {"+15550000001.html": "1:1", "Ann@example.com.html": "0:1", "stray.html": None}
    assert sqlite_source.read_book(spark, str(tmp_path / "none")) is None


PAGE = '<div class="message"><div class="sent"><p><span class="timestamp"><a href="sms://open?message-guid={}">{}</a></span></p><div class="message_part">{}</div></div></div>'


def page(*messages):
    return "<!DOCTYPE html><html><head><title>t</title></head><body>\n" + "\n".join(PAGE.format(*m) for m in messages) + "\n</body></html>"


def test_overlapping_pages_merge_to_one_copy(spark, tmp_path):
    (tmp_path / "Real Group.html").write_text(page((G(1), "Jul 02, 2026  7:45:05 AM", "one"), (G(2), "Jul 02, 2026 1:00:00 PM", "two")))
    (tmp_path / "b%20.html").write_text(page((G(2).lower(), "Jul 02, 2026 1:00:00 PM", "two again"), (G(3), "", "three")))
    pages = html_pages.with_order(html_pages.read_pages(spark, str(tmp_path)))
    assert {r["file"] for r in pages.collect()} == {"Real Group.html", "b%20.html"}
    for mode in ("shape", "div"):
        rows = html_pages.parse_messages(pages, mode)
        merged = dedup.first_wins(rows, ["guid"], ["file_ord", "msg_ord"])
        assert [r["guid"] for r in merged.orderBy(F.col("ts_key") == "", "ts_key", "file_ord", "msg_ord").collect()] == [G(1), G(2), G(3)]
        assert merged.filter(F.col("html").contains("two again")).count() == 0
    out = sinks.page_pieces(dedup.first_wins(rows, ["guid"], ["file_ord", "msg_ord"]).withColumn("thread", F.lit("x.html")), "thread")
    assert sinks.write_pages(out, str(tmp_path / "out")) == 1
    assert (tmp_path / "out" / "x.html").read_text().count('<div class="message">') == 3
    stats = {r["file"]: (r["n_in"], r["n_new"]) for r in dedup.contribution(rows, ["guid"], ["file_ord", "msg_ord"], "file").collect()}
    assert stats == {"Real Group.html": (2, 2), "b%20.html": (2, 1)}


def test_large_pages_are_parsed_in_parts(spark):
    """The parts of a page hold the messages of the whole page in their order, and pages that cannot be cut stay whole."""
    message = lambda k, inside="x": PAGE.format(G(k), "Jul 02, 2026 7:45:05 AM", inside)
    nested = '<div class="replies"><div class="message"><a href="sms://open?message-guid={}">r</a></div></div>'
    body = "\n".join(message(k, nested.format(G(9000 + k)) if k % 9 == 0 else f"<img src='Attachments/{G(5000 + k)}/p.jpg'>" if k % 7 == 0 else f"t{k} <b>") for k in range(200))
    texts = {
        "plain": f"<html><head><title>t</title></head><body>\n{body}\n</body></html>",
        "wrapped": f"<html><body><div id='all'><div>head</div>\n{body}\n</div><p>tail</p></body></html>",
        "comment": f"<body>{body}<!-- {G(77)} --></body>",
        "headed": f"<body><p id='{G(1)}'>x</p>{body}</body>",
        "unclosed": f"<body><div>{body}",
        "texts": "<body>" + "".join(f'<div class="message"><p>{G(k)}</p></div>' for k in range(90)) + "</body>",
        "one": "<body>" + f'<div class="message"><a href="{G(3)}">x</a></div>' * 90 + "</body>",
        "apart": f"<body><div>{body}</div><div>{message(300)}</div></body>",
        "none": "x" * 5000, "empty": "",
    }
    assert {n for n, t in texts.items() if html_pages.cuts(t, 2000)} >= {"plain", "wrapped"}
    assert not any(html_pages.cuts(texts[n], 2000) for n in ("comment", "headed", "texts", "one", "none", "empty"))
    pages = spark.createDataFrame([(n, k, t) for k, (n, t) in enumerate(texts.items())] + [("null", 99, None)], "file string, file_ord int, text string")
    for mode in ("shape", "div"):
        parted, whole = ([r.asDict() for r in html_pages.parse_messages(pages, mode, large, 2000).orderBy("file", "msg_ord").collect()] for large in (1000, 1 << 30))
        assert max(r["msg_ord"] for r in parted) > html_pages.PLACES
        drop = lambda rows: [{k: v for k, v in r.items() if k != "msg_ord"} for r in rows]
        assert drop(parted) == drop(whole)


def test_shape_finds_comments_and_splits_replies(spark):
    text = f"<body><div><!-- {G(7)} --><p>x</p></div><div class='message' id='{G(8)}'><img src='Attachments/{G(9)}/x.jpg'></div></body>"
    rows = spark.createDataFrame([("f", 0, text), ("g", 1, f"<p>{G(5)}</p>"), ("h", 2, None)], "file string, file_ord int, text string")
    found = {(r["file"], r["guid"]) for r in html_pages.parse_messages(rows).collect()}
    assert found == {("f", G(7)), ("f", G(8)), ("f", G(9)), ("g", G(5))}


VOICE = '<html><head><title>{title}</title></head><body>{people}{messages}</body></html>'
LINE = '<div class="message"><abbr class="dt" title="{ts}">x</abbr>: <cite class="sender vcard"><a class="tel" href="tel:{tel}"><span class="fn">{name}</span></a></cite>: <q>{text}</q>{extra}</div>'


def voice(title, *lines, people=()):
    box = "".join(f'<div class="participants"><cite class="sender vcard"><a class="tel" href="tel:{p}">p</a></cite></div>' for p in people)
    return VOICE.format(title=title, people=box, messages="".join(LINE.format(**{"extra": "", "name": "", **line}) for line in lines))


def test_voice_threads(spark, tmp_path):
    me = {"tel": "+15550000009", "name": "Me"}
    chunks = [
        ("Ann Lee - Text - 1Z.html", voice("Me to Ann Lee", {"ts": "2020-01-01T12:00:00.123-05:00", "text": "out &amp; about", **me})),
        ("Ann Lee - Text - 2Z.html", voice("Me to Ann Lee", {"ts": "2020-01-02T12:00:00-05:00", "tel": "+15550000001", "name": "Ann Lee", "text": "hello", "extra": '<img src="pic-1">'}, {"ts": "bad", "text": "dropped", **me})),
        ("Ann Lee - Text - 2Z copy.html", voice("Me to Ann Lee", {"ts": "2020-01-02T12:00:00-05:00", "tel": "+15550000001", "name": "Ann Lee", "text": "hello"})),
        ("+15550000002 - Text - 3Z.html", voice("Me to", {"ts": "2020-01-03T12:00:00-05:00", "text": "x", **me})),
        ("Group Conversation - 4Z.html", voice("Group", {"ts": "2020-01-04T12:00:00-05:00", "tel": "+1555", "name": "Z", "text": ""}, people=("+1556", "+1555"))),
        ("Zed - Text - 5Z.html", voice("Me to Zed/Q", {"ts": "2020-01-05T12:00:00-05:00", "text": "x", **me})),
    ]
    pages = spark.createDataFrame([(n, i, t) for i, (n, t) in enumerate(chunks)], "file string, file_ord int, text string")
    known = threads.identify(html_pages.parse_chunks(pages))
    messages = threads.messages_of(known).cache()
    plan = {r["output_name"]: (r["n_messages"], r["n_attachments"]) for r in threads.plan(messages).collect()}
    assert plan == {"+15550000001.html": (2, 0), "+15550000002.html": (1, 0), "+1555, +1556.html": (1, 0), "Zed_Q.html": (1, 0)}
    names = threads.thread_names(messages)
    assert [r["n_messages"] for r in threads.plan(messages).collect()] == [2, 1, 1, 1]  # O6
    assert sinks.write_pages(threads.page_pieces(messages, names, threads.plan(messages)), str(tmp_path), ["ts", "place"]) == 4
    html = (tmp_path / "+15550000001.html").read_text()
    assert html.index("out &amp; about") < html.index("hello") and "Jan 01, 2020 12:00:00 PM" in html and html.endswith("</div>\n</body></html>")
    assert "bubble" not in (tmp_path / "+1555, +1556.html").read_text()
    assert threads.group_sidecar(messages).first()["members"] == ["+1555", "+1556"]
    first = threads.messages_of(threads.identify(html_pages.parse_chunks(pages.filter("file_ord < 2"))))
    media = spark.createDataFrame([("m/pic-1.png",), ("m/pic-1.jpg",)], "path string")
    assert [r["resolved"] for r in threads.resolve_attachments(first, media).collect() if r["resolved"]] == [["m/pic-1.jpg"]]
    assert tuple(threads.attachment_totals(first, media).first()) == (1, 0)


def test_participants_prefer_recent_ids(spark, store, tmp_path):
    tables = sqlite_source.read_messages(spark, store)
    ids = [G(k) for k in (1, *range(100, 130))]
    text = "".join(f"message-guid={g} " for g in ids)
    pages = spark.createDataFrame([("A, B.html", text), ("Family.html", text), ("Real Group.html", f"message-guid={G(1)} message-guid={G(2)}")], "file string, text string")
    found = participants.participants(pages, tables)
    assert {r["file"]: r["handles"] for r in found.collect()} == {"A, B.html": ["+15550000000", "+15550000001"], "Real Group.html": ["+15550000000", "+15550000001"]}
    path = tmp_path / "members.json"
    assert not sinks.write_document(participants.sidecar_pieces(found.limit(0)), str(path), ["file"]) and not path.exists()
    assert sinks.write_document(participants.sidecar_pieces(found), str(path), ["file"])
    assert json.loads(path.read_text())["A, B.html"] == ["+15550000000", "+15550000001"]


def test_sanitize_plans_and_rewrite(spark):
    tree = spark.createDataFrame([("r", "Attachments/sub:dir/pic:1.jpg"), ("r", "x/StickerCache/a.png"), ("r", "Attachments/a:b"), ("r", "Attachments/a?b")], "root string, rel_path string")
    assert {r["root"] for r in sanitize.attachment_roots(tree).collect()} == {"Attachments", "x/StickerCache"}
    plan = [(r["rel_dir"], r["old_name"], r["new_name"]) for r in sanitize.full_plan(tree).collect()]
    assert plan[0] == ("Attachments/sub:dir", "pic:1.jpg", "pic-1.jpg") and ("Attachments", "sub:dir", "sub-dir") in plan
    depths = [r["depth"] for r in sanitize.full_plan(tree).collect()]  # O8: deepest first
    assert depths == sorted(depths, reverse=True)
    pages = spark.createDataFrame([("new.html", '<img src="Attachments/a:b"> Attachments/a:b'), ("other.html", '<a href="Attachments/d:r/x.jpg">')], "file string, html string")
    scoped = {r["old_path"]: (r["new_path"], r["skipped"], r["exists"]) for r in sanitize.scoped_plan(pages, spark.createDataFrame([("Attachments/zzz:only-old",)], "path string")).collect()}
    assert scoped == {"Attachments/a:b": ("Attachments/a-b", False, False), "Attachments/d:r/x.jpg": ("Attachments/d:r/x.jpg", True, False)}
    pairs = spark.createDataFrame([("Attachments/a:b", "Attachments/a-b")], "old_path string, new_path string")
    out = {r["file"]: (r["html"], r["n_updated"]) for r in sanitize.rewrite(pages, pairs).collect()}
    assert out["new.html"] == ('<img src="Attachments/a-b"> Attachments/a:b', 1) and out["other.html"][1] == 0


def test_state_files(spark, tmp_path):
    path = str(tmp_path / "excludes")
    assert files.write_patterns(spark.createDataFrame([("b",), ("a",), ("b",)], "pattern string"), path) == 2
    assert open(path).read() == "a\nb\n"
    assert sorted(r["pattern"] for r in files.read_patterns(spark, path).collect()) == ["a", "b"]
    assert files.read_patterns(spark, path + "x").count() == 0
    (tmp_path / "log").write_text("{bad")
    assert files.read_log(spark, str(tmp_path / "log")).count() == 0
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f.txt").write_text("abc")
    row = files.inventory(spark, str(tmp_path / "d")).first()
    assert (row["rel_path"], row["length"]) == ("f.txt", 3)
    assert sinks.manifest_text({"message_count": 3}).splitlines()[2] == "message_count: 3"


def test_incremental_runs_equal_one_full_run(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"2026-02-{1 + k:02d} 10:00:00") for k in range(20)], "guid long, ts string").withColumn("ts", F.to_timestamp_ntz("ts", F.lit("yyyy-MM-dd HH:mm:ss")))
    root = str(tmp_path / "runs")
    assert incremental.sync(rows, root, "2026-02-10_080000", dry_run=True)["start"] is None
    first = incremental.sync(rows.filter("guid < 10"), root, "2026-02-10_080000")
    (tmp_path / "runs" / "2026-02-15_000000").mkdir()  # a run that never committed
    second = incremental.sync(rows, root, "2026-02-21_080000")
    assert (first["start"], second["start"]) == (None, "2026-02-09")
    assert incremental.archive(spark, root, "guid", ["ts"]).count() == 20
    assert incremental.start_day([("2026-03-01_000000", True)]) == "2026-02-28"
    assert incremental.start_day([], since="2024-13-99") == "2024-13-99"
    with pytest.raises(ValueError):
        incremental.start_day([], since="yesterday")
    assert incremental.run_folder(spark, root, "2026-02-21_080000").endswith("_2")
    assert files.snapshots(spark, root) == [("2026-02-10_080000", True), ("2026-02-15_000000", False), ("2026-02-21_080000", True), ("2026-02-21_080000_2", False)]
    with pytest.raises(FileExistsError):
        incremental.commit(spark, first["folder"], None)
    plan = incremental.window(rows.select("guid", "ts"), "ts", "2026-02-05")
    assert plan.count() == 16


def test_streams_keep_the_first_by_order(spark, tmp_path):
    """A copy that comes first in order may arrive last: also in a later batch, and after a restart."""
    schema = "guid long, place long, ts timestamp, text string"

    def arrive(name, rows):
        spark.createDataFrame(rows, "guid long, place long, ts string, text string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        incremental.follow(stream, "guid", "place", "ts", str(tmp_path / "out"), str(tmp_path / "ck"), "1 hour").awaitTermination()
        return {r["guid"]: (r["place"], r["text"]) for r in incremental.followed(spark, str(tmp_path / "out"), "guid", "place").collect()}

    arrive("a", [(1, 5, "2026-01-01 00:00:00", "late copy"), (1, 7, "2026-01-01 00:00:01", "x"), (2, 3, "2026-01-01 00:00:02", "b")])
    assert run() == {1: (5, "late copy"), 2: (3, "b")}
    arrive("b", [(1, 2, "2026-01-01 00:30:00", "first"), (2, 9, "2026-01-01 00:30:00", "y"), (3, 1, "2026-01-01 00:30:00", "c")])
    assert run() == {1: (2, "first"), 2: (3, "b"), 3: (1, "c")}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4  # a worse copy is not passed on
    arrive("c", [(4, 1, "2026-02-01 00:00:00", "far")])
    arrive("d", [(2, 1, "2026-01-01 00:00:00", "too late")])
    run()
    arrive("e", [(2, 0, "2026-01-01 00:00:00", "much too late")])
    assert run()[2][1] in ("b", "too late")


def test_a_store_is_followed_by_rowid(spark, tmp_path):
    path = str(tmp_path / "chat.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE message (ROWID INTEGER PRIMARY KEY, guid TEXT, date INTEGER)")
        db.executemany("INSERT INTO message VALUES (?,?,?)", [(k, G(k), k) for k in (3, 4, 9)])

    def run():
        stream = sqlite_source.follow_table(spark, path, "message")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["ROWID"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [3, 4, 9] and run() == [3, 4, 9]
    with sqlite3.connect(path) as db:
        db.executemany("INSERT INTO message VALUES (?,?,?)", [(k, G(k), k) for k in (10, 500_000)])
    assert run() == [3, 4, 9, 10, 500_000]


def test_shards_count_when_their_job_has_committed(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("ROWID"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("guid"), F.col("id").alias("date")).repartition(3)
    path = sqlite_source.write_tables(str(tmp_path / "s"), {"message": rows})
    assert len(list((tmp_path / "s" / "message").iterdir())) == 3 and sqlite_source.table_names(path) == ["message"]
    found = sqlite_source.read_table(spark, path, "message")
    assert found.rdd.getNumPartitions() == 3 and {tuple(r) for r in found.collect()} == {tuple(r) for r in rows.collect()}
    assert [r["ROWID"] for r in found.filter("ROWID >= 98").orderBy("ROWID").collect()] == [98, 99]
    bad = rows.withColumn("date", F.when(F.col("ROWID") == 50, F.raise_error(F.lit("no"))).otherwise(F.col("date")).cast("long"))
    with pytest.raises(Exception, match="no"):
        sqlite_source.write_tables(str(tmp_path / "t"), {"message": bad})
    assert sqlite_source.shards(str(tmp_path / "t"), "message") == []
    assert sqlite_source.read_table(spark, sqlite_source.write_tables(str(tmp_path / "e"), {"message": rows.limit(0)}), "message").count() == 0


def test_exclude_patterns_equal_their_expressions(spark):
    import fnmatch
    import random

    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ab/.") for _ in range(n))
    values = sorted({word(rng.randint(0, 6)) for _ in range(150)})
    patterns = sorted({"".join(rng.choice("ab/.??*" if k % 3 == 0 else "ab/.?" if k % 3 == 1 else "ab/.") for _ in range(rng.randint(1, 6))) for k in range(60)} | {"?", "a*", "*b/", "*ab.a*", "?*/b*a"} - {"*"})
    patterns = [p for p in patterns if set(p) - {"*", "?"} or "*" not in p]
    refs = spark.createDataFrame([(v, k) for k, v in enumerate(values)] + [(None, 999)], "tail string, k long")
    got = sorted(r["tail"] for r in audit.excluded(refs, spark.createDataFrame([(p,) for p in patterns], "pattern string")).collect())
    assert got == [v for v in values if any(fnmatch.fnmatchcase(v, p) for p in patterns)]
    for few in (["??*", "a?"], ["*"], ["*/*.*", "*" + "ab/." * 10], []):  # without literals; with some that no value holds
        got = sorted(r["tail"] for r in audit.excluded(refs, spark.createDataFrame([(p,) for p in few], "pattern string")).collect())
        assert got == [v for v in values if any(fnmatch.fnmatchcase(v, p) for p in few)]
