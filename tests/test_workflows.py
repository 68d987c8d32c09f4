import json
import sqlite3

import pytest
from test_operators import G, LINE, VOICE, book, page, store  # noqa: F401

from missivelake.__main__ import main
from missivelake.plans import workflows


def test_audit_job(spark, store, tmp_path):  # noqa: F811
    shared = tmp_path / "Attachments"
    (shared / "ab").mkdir(parents=True)
    (shared / "ab" / "pic.jpg").write_text("x")
    (shared / "ab" / "zero.jpg").write_text("")
    (tmp_path / "ex").write_text("s?1.png\n")
    main(["audit", store, str(shared), "--out", str(tmp_path / "out"), "--exclude-from", str(tmp_path / "ex")], spark)
    found = json.loads((tmp_path / "out" / "attachment-audit.json").read_text())
    assert found["totals"] == {"ok": 4, "zero_byte": 2, "missing": 2, "referenced": 8}
    assert "integrity_check: ok" in (tmp_path / "out" / "manifest.txt").read_text()
    assert "zero.jpg" in (tmp_path / "out" / "audit-report.txt").read_text()


def test_merge_and_group_jobs(spark, tmp_path):
    a, b = tmp_path / "+15550000001.html", tmp_path / "ann@example.com.html"
    a.write_text(page((G(1), "Jul 02, 2026 7:45:05 AM", "one"), (G(2), "Jul 02, 2026 1:00:00 PM", "two")))
    b.write_text(page((G(2), "Jul 02, 2026 1:00:00 PM", "two again"), (G(3), "", "three")))
    found = main(["merge", str(a), str(b), "-o", str(tmp_path / "out" / "m.html")], spark)
    assert found["messages"] == 3 and found["duplicates"] == 1 and found["files"][str(b)] == (2, 1)
    text = (tmp_path / "out" / "m.html").read_text()
    assert text.index("one") < text.index(">two<") < text.index("three")
    contact = book(tmp_path / "book", [(1, "Ann", "Lee", None)], [(1, "+1 555 000 0001")], [(1, "Ann@example.com")])
    report = main(["group", str(a), str(b), "-o", str(tmp_path / "g"), "--addressbook", contact], spark)
    assert [(r[1], r[2]) for r in report] == [("Ann Lee", 2)] and len(list((tmp_path / "g").iterdir())) == 1
    again = main(["group", str(a), str(b), "-o", str(tmp_path / "g"), "--addressbook", contact], spark)
    first, second = report[0][0], again[0][0]
    assert second == first.replace(".html", "_2.html") and (tmp_path / "g" / first).read_text() == (tmp_path / "g" / second).read_text()


def test_pages_of_one_name_in_several_runs(spark, tmp_path):
    for run, messages in (("a", [(G(1), "Jul 02, 2026 7:45:05 AM", "one")]), ("b", [(G(1), "Jul 02, 2026 7:45:05 AM", "again"), (G(2), "Jul 02, 2026 1:00:00 PM", "two")])):
        (tmp_path / run).mkdir()
        text = page(*messages).replace("<title>t</title>", f'<title>{run}</title><link rel="stylesheet" href="{run}.css">')
        (tmp_path / run / "t.html").write_text(text.replace("<body>", "<body><h1>kept</h1>"))
    inputs = [str(tmp_path / "a" / "t.html"), str(tmp_path / "b" / "t.html")]
    found = main(["merge", *inputs, "-o", str(tmp_path / "out" / "t.html")], spark)
    assert (found["messages"], found["duplicates"]) == (2, 1) and [found["files"][p] for p in inputs] == [(1, 1), (2, 1)]
    text = (tmp_path / "out" / "t.html").read_text()
    # The first page's shell stays, without its own messages.
    assert 'href="a.css"' in text and "<h1>kept</h1>" in text and text.count('<div class="message">') == 2
    assert text.index("kept") < text.index(">one<") < text.index(">two<") < text.index("</body>") and "again" not in text
    assert [r["n"] for r in main(["merge", *inputs, "--inspect"], spark)] == [1, 2]
    contact = book(tmp_path / "book", [(1, "Ann", "Lee", None)], [(1, "777")])
    report = main(["group", *inputs, "-o", str(tmp_path / "g"), "--addressbook", contact], spark)
    assert [r[0] for r in report] == ["t.html", "t_2.html"] and len(list((tmp_path / "g").iterdir())) == 2
    for bad in ([], [str(tmp_path / "none.html")]):
        with pytest.raises(ValueError):
            workflows.merge_pages(spark, bad, None)


def test_voice_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = LINE.format(ts="2020-01-02T12:00:00-05:00", tel="+15550000001", name="Ann", text="hello", extra='<img src="pic-1">')
    (tmp_path / "in" / "Ann - Text - 1Z.html").write_text(VOICE.format(title="Me to Ann", people="", messages=line))
    (tmp_path / "in" / "Ann - Missed - 1Z.html").write_text("<html></html>")
    (tmp_path / "in" / "pic-1.jpg").write_text("bytes")
    command = ["voice", "--input-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out"), "--media-dir", str(tmp_path / "in"), "--attachments-root", str(tmp_path / "out" / "Attachments")]
    assert main([*command, "--dry-run"], spark)["threads"][0][2] == "+15550000001.html" and not (tmp_path / "out").exists()
    found = main(command, spark)
    assert found["attachments"] == (1, 0) and found["skipped"]["Missed"][0] == 1
    assert 'src="Attachments/pic-1.jpg"' in (tmp_path / "out" / "+15550000001.html").read_text()
    assert (tmp_path / "out" / "Attachments" / "pic-1.jpg").read_text() == "bytes"


def exported(root):
    (root / "Attachments" / "sub").mkdir(parents=True)
    (root / "Attachments" / "sub" / "p?1.jpg").write_text("x")
    for run in ("2024", "2025"):
        (root / run).mkdir()
        (root / run / "t.html").write_text(f'<img src="Attachments/sub/p?1.jpg"> Attachments/sub/p?1.jpg {run}')
    return root


def test_sanitize_job_into_another_folder(spark, tmp_path):
    root = exported(tmp_path / "export")
    for extra in ([], ["--html-dir", str(root)]):
        out = tmp_path / f"out{len(extra)}"
        found = main(["sanitize", str(root), "--out", str(out), *extra], spark)
        assert found["renames"] == [("Attachments/sub/p?1.jpg", "Attachments/sub/p-1.jpg")] and (found["references"], found["pages"]) == (2, 2)
        assert found["roots"] == ["Attachments"] and found["files"] == 1
        for run in ("2024", "2025"):
            assert (out / run / "t.html").read_text() == f'<img src="Attachments/sub/p-1.jpg"> Attachments/sub/p?1.jpg {run}'
        assert (out / "Attachments" / "sub" / "p-1.jpg").read_text() == "x" and (root / "Attachments" / "sub" / "p?1.jpg").exists()
    assert (root / workflows.EXCLUDES).read_text() == "Attachments/sub/p?1.jpg\n"


def test_sanitize_job_in_place(spark, tmp_path):
    root = exported(tmp_path / "export")
    (root / "Attachments" / "b:d").mkdir()
    (root / "Attachments" / "b:d" / "q.jpg").write_text("q")
    old = root / "Attachments" / "sub" / "p?1.jpg"
    assert main(["sanitize", str(root), "--dry-run"], spark)["pages"] == 2 and old.exists()
    found = main(["sanitize", str(root)], spark)
    assert found["files"] == 2 and not old.exists() and not (root / "Attachments" / "b:d").exists()
    assert (root / "Attachments" / "b-d" / "q.jpg").read_text() == "q" and (root / "Attachments" / "sub" / "p-1.jpg").read_text() == "x"
    assert (root / "2025" / "t.html").read_text().startswith('<img src="Attachments/sub/p-1.jpg">')
    assert json.loads((root / workflows.RENAMES).read_text())["Attachments/sub/p?1.jpg"] == "Attachments/sub/p-1.jpg"
    assert main(["sanitize", str(root)], spark)["renames"] == []
    old.write_text("came back")  # the known copy stays, the old name goes
    assert main(["sanitize", str(root)], spark)["files"] == 1
    assert not old.exists() and (root / "Attachments" / "sub" / "p-1.jpg").read_text() == "x"


def test_snapshot_job_and_growth(spark, store, tmp_path):  # noqa: F811
    source = tmp_path / "live"
    (source / "ab").mkdir(parents=True)
    for name in ("pic.jpg", "b?d.jpg"):
        (source / "ab" / name).write_text("x")
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / workflows.EXCLUDES).write_text("ab/b?d.jpg\n")
    command = ["snapshot", store, "--root", str(tmp_path / "r"), "--attachments", str(source)]
    assert main([*command, "--dry-run"], spark) == {"Attachments": 1} and not (tmp_path / "r" / "snapshots").exists()
    found = main(command, spark)
    assert found["copied"] == {"Attachments": 1} and found["integrity_check"] == "ok"
    assert (tmp_path / "r" / "Attachments" / "ab" / "pic.jpg").exists() and not (tmp_path / "r" / "Attachments" / "ab" / "b?d.jpg").exists()
    assert workflows.snapshot(spark, store, str(tmp_path / "r"), "2099-01-01_000000", str(source))["copied"] == {"Attachments": 0}
    rows = main(["growth", "--root", str(tmp_path / "r")], spark)
    assert [(r["messages"], r["more_messages"], r["more_attachments"]) for r in rows] == [(4, None, None), (4, 0, 0)]


def test_sync_exports_pages_members_and_books(spark, tmp_path):
    path = str(tmp_path / "chat.db")
    with sqlite3.connect(path) as db:
        db.executescript(
            """CREATE TABLE message (ROWID INTEGER PRIMARY KEY, guid TEXT, date INTEGER, text TEXT, is_from_me INTEGER, handle_id INTEGER);
            CREATE TABLE attachment (ROWID INTEGER PRIMARY KEY, filename TEXT, transfer_name TEXT);
            CREATE TABLE message_attachment_join (message_id INTEGER, attachment_id INTEGER);
            CREATE TABLE chat (ROWID INTEGER PRIMARY KEY, display_name TEXT, chat_identifier TEXT);
            CREATE TABLE chat_message_join (chat_id INTEGER, message_id INTEGER);
            CREATE TABLE chat_handle_join (chat_id INTEGER, handle_id INTEGER);
            CREATE TABLE handle (ROWID INTEGER PRIMARY KEY, id TEXT);"""
        )
        rows = [(1, G(1), 700000000, "a < b", 0, 10), (2, G(2), 700000060, None, 1, None), (3, G(3), 800000000, "late", 0, 11)]
        db.executemany("INSERT INTO message VALUES (?,?,?,?,?,?)", rows)
        db.execute("INSERT INTO attachment VALUES (1, '~/L/Attachments/ab/pic.jpg', NULL)")
        db.execute("INSERT INTO message_attachment_join VALUES (2, 1)")
        db.executemany("INSERT INTO chat VALUES (?,?,?)", [(1, "", "chat1"), (2, None, "chat2")])
        db.executemany("INSERT INTO chat_message_join VALUES (?,?)", [(1, 1), (1, 2), (2, 3)])
        db.executemany("INSERT INTO chat_handle_join VALUES (?,?)", [(1, 11), (1, 10), (2, 11)])
        db.executemany("INSERT INTO handle VALUES (?,?)", [(10, "+15550000001"), (11, "+15550000000")])
    (tmp_path / "books").mkdir()
    book(tmp_path / "books" / "AddressBook-v22.abcddb", [(1, "Ann", "Lee", None)], [(1, "+1 555 000 0001")])
    root = tmp_path / "r"
    done = main(["sync", path, "--root", str(root), "--addressbook-dir", str(tmp_path / "books"), "--working-dir", str(tmp_path / "work")], spark)
    assert (tmp_path / "work" / ".lease").is_dir() and not (root / ".lease").exists() and (root / "Contacts" / "AddressBook-v22.abcddb").is_file()
    assert (done["pages"], done["participants"], done["books"]) == (2, True, ["phone", "record"])
    folder = tmp_path / "r" / done["folder"].rsplit("/", 1)[1]
    text = (folder / "html" / "+15550000000, +15550000001.html").read_text()
    assert ">a &lt; b<" in text and '<span class="sender">Ann Lee<' in text and '<span class="sender">Me<' in text
    assert 'src="Attachments/ab/pic.jpg"' in text and text.index(G(1)) < text.index(G(2))
    assert json.loads((folder / "group_participants.json").read_text()) == {"+15550000000, +15550000001.html": ["+15550000000", "+15550000001"]}
    assert (folder / ".complete").exists() and spark.read.parquet(str(folder / "book" / "record")).count() == 1
    late = main(["sync", path, "--root", str(root), "--since", "2026-01-01"], spark)
    assert (late["pages"], late["participants"], late["books"]) == (1, False, [])


def test_sync_jobs(spark, store, tmp_path):  # noqa: F811
    assert main(["sync", store, "--root", str(tmp_path / "r"), "--dry-run"], spark)["start"] is None
    done = main(["sync", store, "--root", str(tmp_path / "r"), "--since", "2020-01-01"], spark)
    assert spark.read.parquet(done["folder"] + "/messages").select("guid").distinct().count() == 2
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("1")
    (tmp_path / "a" / "y?").write_text("1")
    plan = workflows.plan_sync(spark, str(tmp_path / "a"), str(tmp_path / "b"), spark.createDataFrame([("y?",)], "pattern string"))
    assert [r["change"] for r in plan.collect()] == ["new"]
    from missivelake.sources import sinks

    assert sinks.copy_files(plan) == 1 and (tmp_path / "b" / "x").read_text() == "1"
    assert workflows.copy_store(spark, store, str(tmp_path / "snap")).endswith("chat.db")
