"""What must not grow with long names, many files or late times, on small tables."""

import re

import pytest

from missivelake.plans import archive_queries, catalogue, job_queries  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def moved(df) -> list[set[str]]:
    """The columns that each exchange and each sort of a plan holds."""
    jvm = df.sparkSession._jvm
    text = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = re.findall(r"\(\d+\) (?:Exchange|Sort)\b[^\n]*\n(?:Output|Input) \[\d+\]: \[([^\n]*)\]", text)
    return [set(re.findall(r"([A-Za-z_]+)#\d+", columns)) for columns in nodes]


def holds_names_of_rows(df) -> bool:
    """Whether a chat's name, which may list thousands of members, moves or is sorted with each reference."""
    found = moved(df)
    assert found
    return any(columns & {"chat", "chat_name"} and columns & {"path", "stored_path", "file"} for columns in found)


def test_changed_references_are_kept_without_names(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(archive_queries, "bucketed", lambda df, *rest, f=archive_queries.bucketed: (kept.append(set(df.columns)), f(df, *rest))[1])
    assert not holds_names_of_rows(catalogue.QUERIES["audit_changed"](spark, SMALL))
    assert kept and not any("chat" in columns for columns in kept)


def test_references_are_counted_before_their_names_are_joined(spark):
    assert not holds_names_of_rows(catalogue.QUERIES["audit_join"](spark, SMALL))


def test_voice_messages_of_one_time_follow_their_conversations(spark, tmp_path):
    """Conversations 70 and 670 have one thread and one time; their numbers do not sort as texts."""
    import duckdb

    rows = [(c, turn, "user" if turn % 2 else "assistant", "x") for c in (70, 670) for turn in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    spark.read.parquet(f"{SMALL}/nation.parquet").write.parquet(str(tmp_path / "nation.parquet"))
    found = {r["file"]: r["html"] for r in catalogue.QUERIES["job_voice"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as db:
        for t in ("conversations", "nation"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        assert found == dict(db.sql(f"SELECT file, html FROM ({catalogue.ORACLES['job_voice']})").fetchall())


def test_a_stream_of_late_times_keeps_the_first_copies(spark, tmp_path):
    """Years that pandas does not know, a missing time, and microseconds."""
    from missivelake.streaming import incremental

    times = {"a": ["4465-01-02 03:04:05.000006", "2020-01-01 00:00:00"], "b": ["1971-01-01 00:00:00.5"], "c": [None], "d": ["9999-12-31 23:59:59.999999", "2262-04-12 00:00:00"]}
    rows = [(k, i, x) for k, found in times.items() for i, x in enumerate(found)]
    df = spark.createDataFrame(rows, "guid string, place long, x string").selectExpr("guid", "place", "cast(x as timestamp) as ts", "cast(x as timestamp_ntz) as wall")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    incremental.follow(stream, "guid", "place", "ts", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = incremental.followed(spark, str(tmp_path / "out"), "guid", "place").selectExpr("guid", "cast(ts as string) as x", "cast(wall as string) as y", "place").collect()
    assert sorted((r["guid"], r["place"], r["x"], r["y"]) for r in found) == [(k, 0, x[0], x[0]) for k, x in sorted(times.items())]


def test_ranges_hold_the_start_of_texts_only(spark):
    from pyspark.sql import functions as F

    from missivelake.operators.ranks import CUT, range_keys, ranked

    rows = spark.createDataFrame([(a, b, n) for n in range(3) for a in ("x" * CUT, "x" * CUT + "a", "x" * CUT + "b", "w", None) for b in ("p" * 2 * CUT, "q", None)], "a string, b string, n long")
    keys = rows.select(*[k.alias(f"k{i}") for i, k in enumerate(range_keys(rows, ["a", "b", "n"]))])
    assert max(len(v) for r in keys.collect() for v in r if isinstance(v, str)) <= CUT
    order = lambda df, *by: [tuple(r) for r in df.orderBy(*by).select("a", "b", "n").collect()]
    both = rows.select("*", *[k.alias(f"k{i}") for i, k in enumerate(range_keys(rows, ["a", "b", "n"]))])
    assert order(both, *keys.columns, "a", "b", "n") == order(rows, "a", "b", "n")
    placed = ranked(rows.withColumn("of", F.lit(0)), ["of"], ["a", "b", "n"]).orderBy("place").collect()
    assert [(r["a"], r["b"], r["n"]) for r in placed] == order(rows, "a", "b", "n")


def test_long_member_lists_stand_once_in_their_document(spark, tmp_path):
    import json

    from missivelake.operators import participants
    from missivelake.sources import sinks

    members = [f"member {i:05d}" for i in range(600)]
    tables = {"chat_handle_join": spark.createDataFrame([(c, c * 1000 + i) for c, n in ((1, 600), (2, 2)) for i in range(n)], "chat_id long, handle_id long"),
              "handle": spark.createDataFrame([(c * 1000 + i, members[i]) for c in (1, 2) for i in range(600)], "ROWID long, id string")}
    chats = spark.createDataFrame([(f"page {i:03d}.html", 1 + i % 2) for i in range(100)], "file string, chat_id long")
    path = tmp_path / "members.json"
    assert sinks.write_document(participants.shared_sidecar_pieces(chats, participants.member_lists(tables)), str(path), ["file"])
    found = json.loads(path.read_text())
    lists = found.pop("members")
    assert lists == {"1": members} and path.stat().st_size < 2 * len(json.dumps(members))
    assert found == {f"page {i:03d}.html": members[:2] if i % 2 else {"members_ref": 1} for i in range(100)}
    assert not sinks.write_document(participants.shared_sidecar_pieces(chats.limit(0), participants.member_lists(tables)), str(tmp_path / "none.json"), ["file"])


def test_members_do_not_move_with_their_pages(spark):
    found = moved(catalogue.QUERIES["group_members"](spark, SMALL))
    assert found and not any(columns & {"handles", "id"} and "file" in columns for columns in found)


def test_the_driver_lists_no_pages(spark, tmp_path):
    from missivelake.sources import html_pages

    texts = {"a b+%41.html": "<p>é</p>".encode(), "sub/bad.html": b"a\xffb", "sub/deep/c.html": b"c", "empty.html": b"", ".hidden.html": b"x", "_side/d.html": b"x", "other.txt": b"x"}
    for name, data in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    pages = html_pages.read_pages(spark, str(tmp_path), recursive=True)
    assert not any(f.endswith(".html") for f in pages.inputFiles())
    wanted = {"a b+%41.html": "<p>é</p>", "sub/bad.html": "a�b", "sub/deep/c.html": "c"}
    assert {r["path"]: (r["file"], r["text"]) for r in pages.collect()} == {str(tmp_path / n): (n.rpartition("/")[2], x) for n, x in wanted.items()}
    assert [r["file"] for r in html_pages.read_pages(spark, str(tmp_path)).collect()] == ["a b+%41.html"]
    assert html_pages.read_pages(spark, [str(tmp_path / "sub/bad.html"), str(tmp_path / "empty.html")]).count() == 1
    with pytest.raises(FileNotFoundError):
        html_pages.read_pages(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("mode", ["shape", "div"])
def test_pages_are_parsed_in_parts_that_tasks_read(spark, tmp_path, mode):
    """Cut pages, small ones, one with bad bytes: the same messages and ids as from whole texts."""
    from missivelake.operators import participants
    from missivelake.sources import html_pages

    one = '<div class="message"><p><span class="timestamp"><a href="sms://open?message-guid=AAAAAAAA-0000-4000-8000-{:012d}">Jan 02, 2020 8:{:02d}:00 AM</a></span></p><q>é€ {}</q></div>\n'
    for name, n in (("A, B.html", 500), ("C, D.html", 3), ("E, F.html", 40), ("G.html", 20)):
        data = ("<html><head><title>t</title></head><body>\n" + "".join(one.format(i, i % 60, "x" * (i % 50)) for i in range(n)) + "</body></html>").encode()
        (tmp_path / name).write_bytes(data.replace("é€ ".encode(), b"\xff ") if name.startswith("E") else data)
    pages = html_pages.with_order(html_pages.read_pages(spark, str(tmp_path)))
    told = lambda df: sorted((r["file"], r["guid"], r["ts_key"], r["html"]) for r in df.collect())
    assert told(html_pages.read_messages(spark, str(tmp_path), mode, 4000, 2000)) == told(html_pages.parse_messages(pages, mode, 1 << 30))
    parts = html_pages.page_parts(spark, str(tmp_path), 4000, 2000)
    assert parts.filter("file = 'A, B.html' and not whole").count() > 10 and "text" not in parts.columns
    few = lambda df: sorted(tuple(r) for r in df.select("file", "pos", "guid").collect())
    searched = html_pages.SEARCHED
    try:
        html_pages.SEARCHED = 1000
        assert few(html_pages.read_candidates(spark, str(tmp_path))) == few(participants.candidate_ids(pages))
    finally:
        html_pages.SEARCHED = searched


def test_long_chat_names_stand_once_in_an_audit(spark, tmp_path):
    import json

    from missivelake.operators import audit
    from missivelake.sources import sinks

    name = ", ".join(f'member "{i:05d}"' for i in range(600))
    names = spark.createDataFrame([(1, "Named"), (2, name)], "code long, chat string")
    rows = [(1 + i % 2, f"f{i:03d}", None if i % 7 == 0 else f"2020-01-01T00:00:{i % 60:02d}", f"t{i}", f"s{i}", f"p{i}", ("missing", "zero_byte", "ok")[i % 3]) for i in range(300)]
    done = spark.createDataFrame(rows, "code long, file string, sent string, tail string, stored_path string, path string, status string")
    path = tmp_path / "audit.json"
    assert sinks.write_document(audit.document_pieces(done, "now", "db", "/a", names), str(path), audit.RECORD_ORDER)
    document = json.loads(path.read_text())
    assert document["chats"] == {"2": name} and path.stat().st_size < 5 * len(name)
    for status in ("missing", "zero_byte"):
        wanted = sorted(((s is None, s or "", c, f, t, p) for c, f, s, t, p, _, x in rows if x == status))
        assert [(r["sent"] is None, r["sent"] or "", r.get("chat_ref", 1), r["file"], r["tail"], r["stored_path"]) for r in document[status]] == wanted
        assert all(r["chat"] == "Named" for r in document[status] if "chat_ref" not in r)
    sinks.write_document(audit.document_pieces(done.filter("code = 1"), "now", "db", "/a", names.filter("code = 1")), str(path), audit.RECORD_ORDER)
    assert list(json.loads(path.read_text())) == ["generated", "snapshot_db", "shared_attachments", "totals", "zero_byte", "missing"]


def test_references_move_without_names(spark):
    assert not holds_names_of_rows(catalogue.QUERIES["audit_references"](spark, SMALL))


def test_problems_are_sorted_without_names(spark):
    found = catalogue.QUERIES["audit_problems"](spark, SMALL)
    assert not holds_names_of_rows(found)
    order = [(r["status"], r["sent"] is None, r["sent"] or "", r["chat"], r["file"]) for r in found.collect()]
    assert order == sorted(order)


def test_reports_are_ranked_without_names(spark):
    found = catalogue.QUERIES["audit_report"](spark, SMALL)
    assert not holds_names_of_rows(found)
    order = [(r["status"], r["chat"], r["rn"]) for r in found.collect()]
    assert order == sorted(order)
