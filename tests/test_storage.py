"""Sorted files, leases, inventories, ranks, and the settling of clashing names."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from missivelake.operators import dedup, ranks, sanitize
from missivelake.sources import files, sinks, sorted_files
from missivelake.sources.leases import FREE, Lease, LeaseHeld, LeaseLost, lease
from missivelake.sources.stores import Store, in_task, located
from missivelake.streaming import incremental


def test_sorted_files_of_hot_and_small_threads(spark, tmp_path):
    """One thread holds most messages, so that it lies in several ranges; others share a task."""
    rows = [("hot.html", 1, k, f"m{k:05d}") for k in range(3000)] + [(f"s/{k}.html", 1, 0, f"x{k}") for k in range(40)]
    rows += [(n, kind, 0, text) for n in {r[0] for r in rows} for kind, text in ((0, "<head>\n"), (2, "\n<tail>"))]
    pieces = spark.createDataFrame(rows, "name string, kind int, at int, text string").repartition(3)
    out = tmp_path / "out"
    assert sinks.write_pages(pieces, str(out), ["at"]) == 41
    assert (out / "hot.html").read_text() == "<head>\n" + "\n".join(f"m{k:05d}" for k in range(3000)) + "\n<tail>"
    assert all((out / f"s/{k}.html").read_text() == f"<head>\nx{k}\n<tail>" for k in range(40))
    assert sorted(os.listdir(out)) == ["hot.html", "s"]  # nothing staged stays
    assert sinks.write_pages(pieces.filter("name = 's/1.html'").withColumn("text", F.lit("é")), str(out), ["at"]) == 1
    assert (out / "s" / "1.html").read_text() == "ééé"
    assert sinks.write_pages(pieces.limit(0), str(out), ["at"]) == 0
    odd = spark.createDataFrame([(None, 1, 0, "lost"), ("e.html", 1, 0, None), ("e.html", 1, 1, "b")], pieces.schema)
    assert sinks.write_pages(odd, str(out), ["at"]) == 1 and (out / "e.html").read_text() == "\nb"


def test_parts_of_failed_attempts_do_not_count(spark, tmp_path):
    """A task that failed after it had staged something is run again; an aborted job leaves nothing."""
    spark.dataSource.register(sorted_files.SortedFiles)
    writer = sorted_files.SortedFilesWriter(str(tmp_path / "_staging"), "\n")
    (tmp_path / "_staging" / "000000-1").mkdir(parents=True)
    writer.commit([None, sorted_files.Staged(0, "f", 0, None, None)])
    assert json.loads((tmp_path / "_staging" / "commit.json").read_text()) == []
    writer.abort([])
    assert not (tmp_path / "_staging").exists()
    bad = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "name string, kind int, text string").select("name", "kind", F.when(F.col("name") == "b", F.raise_error(F.lit("no"))).otherwise(F.col("text")).alias("text"))
    with pytest.raises(Exception, match="no"):
        sinks.write_pages(bad, str(tmp_path / "out"), [])
    assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []


def test_spans_of_parts():
    one = lambda folder, n, first, last: (folder, n, first, last)
    joins, moves = sorted_files.spans([one("a", 2, ("x", 0, 2), ("y", 0, 1)), one("b", 1, ("y", 1, 1), ("y", 1, 1)), one("c", 3, ("y", 2, 2), ("z", 0, 2))])
    assert joins == [("y", [("a/1", False), ("b/0", True), ("c/0", False)])] and moves == [("a", 0, 1), ("c", 1, 3)]
    assert sorted_files.spans([]) == ([], [])


def test_ranks_over_ranges(spark):
    rows = [("hot", k) for k in range(2000)] + [(None, k) for k in range(50)] + [(f"k{k % 7}", k) for k in range(70)]
    got = ranks.ranked(spark.createDataFrame(rows, "key string, at long").repartition(5), ["key"], ["at"]).collect()
    expected, seen = {}, {}
    for key, at in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        seen[key] = seen.get(key, 0) + 1
        expected[key, at] = seen[key]
    assert {(r["key"], r["at"]): r["place"] for r in got} == expected and len(got) == len(rows)
    assert ranks.ranked(spark.createDataFrame([], "key string, at long"), ["key"], ["at"]).count() == 0


def test_first_few_are_cut_before_the_exchange(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("key"), F.col("id").alias("at"))
    few = ranks.newest_and_oldest(rows, ["key"], ["at"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4  # before and after each exchange
    got = [r["at"] for r in few.filter("key = 0").orderBy("place").collect()]
    assert got == [999 - 3 * k for k in range(10)] + [3 * k for k in range(5)]
    short = [r["at"] for r in ranks.newest_and_oldest(rows.filter("at < 6"), ["key"], ["at"]).filter("key = 1").orderBy("place").collect()]
    assert short == [4, 1, 1, 4]


def test_numbered_names_never_clash(spark):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(["a.html"] * 4 + ["a_3.html", "a_2.html", "b", "b", "b_7", "a_2.html", None, "c.tar.gz", "c.tar.gz"])], "k long, name string")
    out = {r["k"]: r["output_name"] for r in dedup.numbered_names(rows, "name", ["k"]).collect()}
    assert out[0] == "a.html" and out[3] == "a_4.html" and out[4] == "a_3.html" and out[5] == "a_2.html" and out[9] == "a_2_2.html"
    assert (out[6], out[7], out[8], out[10], out[11], out[12]) == ("b", "b_2", "b_7", None, "c.tar.gz", "c.tar_2.gz")
    named = [n for n in out.values() if n is not None]
    assert len(set(named)) == len(named) == 12
    there = spark.createDataFrame([("b",), ("b_3",), ("zz",)], "name string")
    again = [r["output_name"] for r in dedup.numbered_names(rows.filter("name = 'b'"), "name", ["k"], taken=there).orderBy("k").collect()]
    assert again[0] == "b_2" and len({*again, "b", "b_3"}) == 4


def test_two_racing_writers(spark, tmp_path):
    """Of many that try at once one gets the lease; the others are told."""
    for _ in range(3):
        took, told, start = [], [], threading.Barrier(6)

        def attempt():
            own = Lease(spark, str(tmp_path), 60)
            start.wait()
            try:
                took.append(own.acquire() and own)
            except LeaseHeld:
                told.append(own)

        threads = [threading.Thread(target=attempt) for _ in range(6)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(took) == 1 and len(told) == 5
        took[0].check()
        took[0].release()


def test_a_stale_lease_is_taken_over(spark, tmp_path):
    now = [1000.0]
    crashed = Lease(spark, str(tmp_path), 60, "crashed", lambda: now[0])
    assert crashed.acquire() == 1
    other = Lease(spark, str(tmp_path), 60, "other", lambda: now[0])
    now[0] += 59
    crashed.extend()
    now[0] += 59
    with pytest.raises(LeaseHeld):
        other.acquire()
    now[0] += 2
    assert other.acquire() == 2
    for late in (crashed.check, crashed.extend):
        with pytest.raises(LeaseLost):
            late()
    crashed.release()  # of no effect
    other.check()
    other.release()
    assert Lease(spark, str(tmp_path), 60, "third", lambda: now[0]).acquire() == 3
    assert sorted(os.listdir(tmp_path / ".lease")) == ["000000000003"]
    # A mark that its writer never filled holds from its own time on.
    (tmp_path / ".lease" / "000000000004").write_text("")
    with pytest.raises(LeaseHeld):
        Lease(spark, str(tmp_path), 60).acquire()
    os.utime(tmp_path / ".lease" / "000000000004", (1, 1))
    assert Lease(spark, str(tmp_path), 60).acquire() == 5


def test_a_lease_is_extended_while_it_is_held(spark, tmp_path):
    import time

    with lease(spark, str(tmp_path), 0.9) as held:
        time.sleep(2)
        with pytest.raises(LeaseHeld):
            Lease(spark, str(tmp_path), 0.9).acquire()
        held.check()
    assert os.path.exists(tmp_path / ".lease" / ("000000000001" + FREE))


def test_a_run_that_lost_its_lease_does_not_commit(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2026-02-01 10:00:00")], "guid long, ts string").withColumn("ts", F.to_timestamp_ntz("ts", F.lit("yyyy-MM-dd HH:mm:ss")))
    root = str(tmp_path / "runs")

    def stolen(folder):
        Store(spark, root).create(f"{root}/.lease/000000000009", json.dumps({"owner": "x", "until": 0}).encode())
        return {}

    with pytest.raises(LeaseLost):
        incremental.sync(rows, root, "2026-02-10_080000", more=stolen)
    assert [complete for _, complete in files.snapshots(spark, root)] == [False]
    plan = incremental.sync(rows, root, "2026-02-11_080000", dry_run=True)
    assert plan["steps"][1] == f"write all messages to {root}/2026-02-11_080000/messages"
    assert incremental.sync(rows, root, "2026-02-11_080000")["folder"].endswith("2026-02-11_080000")


@pytest.mark.parametrize("enough", [1, 3, 1000])
def test_inventory_by_levels(spark, tmp_path, enough):
    """Empty, hidden and oddly named files, deep and wide folders; links are not followed."""
    for name in ("a.txt", "x/b?.txt", "x/y/.hidden", "x/y/z/w/_c", "é v/100%.txt", *[f"wide/{k}/f" for k in range(6)]):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if name.startswith("x/y") else "abc")
    (tmp_path / "empty").mkdir()
    (tmp_path / "x" / "loop").symlink_to(tmp_path)
    rows = {r["rel_path"]: r for r in files.inventory(spark, str(tmp_path), enough).collect()}
    assert set(rows) == {"a.txt", "x/b?.txt", "x/y/.hidden", "x/y/z/w/_c", "é v/100%.txt", *[f"wide/{k}/f" for k in range(6)]}
    assert rows["x/y/.hidden"]["length"] == 0 and rows["é v/100%.txt"]["length"] == 3 and all(r["path"] == f"{tmp_path}/{p}" and r["root"] == str(tmp_path) for p, r in rows.items())
    assert rows["a.txt"]["mtime"].timestamp() == pytest.approx(os.path.getmtime(tmp_path / "a.txt"), abs=1e-3)
    assert files.inventory(spark, str(tmp_path / "none")).count() == 0


def test_addresses(spark, tmp_path):
    (tmp_path / "in").mkdir()
    conf = spark._jsparkSession.sessionState().newHadoopConf
    assert conf() is not None and located(spark, f"file:{tmp_path}/in/new/x") == f"{tmp_path}/in/new/x"
    spark.conf.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}/in")
    assert located(spark, "viewfs://store/in/later") == f"{tmp_path}/in/later"
    (tmp_path / "in" / "f").write_text("x")
    assert [r["rel_path"] for r in files.inventory(spark, "viewfs://store/in").collect()] == ["f"]
    store, path = in_task(f"file://{tmp_path}/in/f")
    assert store.open_input_stream(path).read() == b"x"
    own = Store(spark, str(tmp_path))
    assert own.create(f"{tmp_path}/m", b"1") and not own.create(f"{tmp_path}/m", b"2") and own.read(f"{tmp_path}/m") == b"1"
    own.put(f"{tmp_path}/m", b"3")
    assert own.read(f"{tmp_path}/m") == b"3" and own.read(f"{tmp_path}/none") is None and own.read(f"{tmp_path}/in") is None


def test_stores_other_than_local(spark, tmp_path):
    """The driver's calls through Hadoop's own interface, as any other store takes them."""
    own = Store(spark, str(tmp_path))
    own.local = False
    assert own.create(f"{tmp_path}/m", b"1") and not own.create(f"{tmp_path}/m", b"2") and own.read(f"{tmp_path}/m") == b"1"
    own.put(f"{tmp_path}/m", "é".encode())
    own.put(f"{tmp_path}/sub/n", b"")
    assert own.read(f"{tmp_path}/m") == "é".encode() and own.read(f"{tmp_path}/sub/n") == b"" and own.names(str(tmp_path)) == [("m", False), ("sub", True)]
    own.delete(f"{tmp_path}/sub")
    assert not own.exists(f"{tmp_path}/sub")


def test_logs_and_refresh(spark, tmp_path):
    log = spark.createDataFrame([('a"b', "c\\d"), ("é:1", "é-1"), ("x", "y"), ("x", "z")], "old string, new string")
    files.write_log(log, str(tmp_path / "log"))
    assert json.loads((tmp_path / "log").read_text()) == {'a"b': "c\\d", "é:1": "é-1", "x": "z"}
    assert {tuple(r) for r in files.read_log(spark, str(tmp_path / "log")).collect()} == {('a"b', "c\\d"), ("é:1", "é-1"), ("x", "z")}
    for text in ('{"a": "b", "c": "d"}', '{\n  "a": "b",\n  "c": "d"\n}', '{"a":\n"b", "c": "d"}'):
        (tmp_path / "log").write_text(text)
        assert {tuple(r) for r in files.read_log(spark, str(tmp_path / "log")).collect()} == {("a", "b"), ("c", "d")}
    files.write_log(log.limit(0), str(tmp_path / "log"))
    assert json.loads((tmp_path / "log").read_text()) == {} and files.read_log(spark, str(tmp_path / "log")).count() == 0
    source, target = tmp_path / "db", tmp_path / "cache" / "db"
    source.write_text("one")
    (tmp_path / "db-wal").write_text("w")
    assert files.refresh(spark, str(source), str(target)) and sorted(p.name for p in target.parent.iterdir()) == ["db", "db-wal"]
    source.write_text("")
    assert not files.refresh(spark, str(source), str(target)) and not files.refresh(spark, str(tmp_path / "none"), str(target))
    assert target.read_text() == "one" and len(list(target.parent.iterdir())) == 2
    source.write_text("two")
    (tmp_path / "db-wal").unlink()
    assert files.refresh(spark, str(source), str(target)) and [p.name for p in target.parent.iterdir()] == ["db"]


def test_clashing_names_lose_no_bytes(spark, tmp_path):
    """Three files of one new name, copies among others, a name that exists, and a hashed name that other bytes have."""
    import hashlib

    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    tree = {"a/x:1.jpg": "one", "a/x?1.jpg": "two", "a/x|1.jpg": "one", "a/y:.jpg": "p", "a/y-.jpg": "p", "a/y*.jpg": "q", "a/y?.jpg": "q", "a/z:": "r", "a/v:.b.c": "s", "a/v-.b.c": "t", f"a/v-.b_{digest('s')[:8]}.c": "other"}
    for name, text in tree.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    pairs = spark.createDataFrame([(n, n.translate(str.maketrans(":?|*", "----"))) for n in tree if set(n) & set(":?|*")] + [("a/gone:", "a/gone-")], "old_path string, new_path string")
    listed = files.inventory(spark, str(tmp_path)).select("rel_path")
    rows = {r["old_path"]: (r["new_path"], r["action"], r["collision"]) for r in sanitize.settle(pairs, listed, sinks.digests, str(tmp_path)).collect()}
    assert rows == {
        "a/x:1.jpg": ("a/x-1.jpg", "move", False), "a/x|1.jpg": ("a/x-1.jpg", "remove", False), "a/x?1.jpg": (f"a/x-1_{digest('two')[:8]}.jpg", "move", True),
        "a/y:.jpg": ("a/y-.jpg", "remove", False), "a/y*.jpg": (f"a/y-_{digest('q')[:8]}.jpg", "move", True), "a/y?.jpg": (f"a/y-_{digest('q')[:8]}.jpg", "remove", True),
        "a/z:": ("a/z-", "move", False), "a/v:.b.c": (f"a/v-.b_{digest('s')}.c", "move", True), "a/gone:": ("a/gone-", None, False),
    }
    plan = spark.createDataFrame([(f"{tmp_path}/{o}", f"{tmp_path}/{n}", a) for o, (n, a, _) in rows.items() if a], "source string, target string, action string")
    assert sinks.move_files(plan).filter("done").count() == 8
    left = {p.name: p.read_text() for p in (tmp_path / "a").iterdir()}
    assert sorted(left.values()) == sorted({"one", "two", "p", "q", "r", "s", "t", "other"}) and not any(set(n) & set(":?|*") for n in left)
