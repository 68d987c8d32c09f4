"""Incremental runs: window, lease, run folders, commit, and the overlap merge; batch and streaming."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from missivelake.operators.dedup import first_wins
from missivelake.sources.files import snapshots
from missivelake.sources.leases import SECONDS, lease
from missivelake.sources.stores import Store

OVERLAP_DAYS = 1
#: The mark by which a run claims its folder.
CLAIMED = ".claimed"


def start_day(stamps: list[tuple[str, bool]], full: bool = False, since: str | None = None) -> str | None:
    """The first day to read: none for a full run, else the given day, else the newest committed run's day less
    one, else none.  The shape of a given day is checked, the calendar is not."""
    if full:
        return None
    if since is not None:
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", since):
            raise ValueError(f"not a day: {since}")
        return since
    done = [s for s, complete in stamps if complete]
    if not done:
        return None
    return str(dt.date.fromisoformat(max(done)[:10]) - dt.timedelta(days=OVERLAP_DAYS))


def window(rows: DataFrame, ts: str, start: str | None) -> DataFrame:
    """Rows from the start day on; there is no upper bound.  The comparison reaches the scan."""
    return rows if start is None else rows.filter(F.col(ts) >= F.lit(start).cast(rows.schema[ts].dataType))


def merge_overlap(parts: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Rows of overlapping runs, oldest run first: one a key, the first in (run, order)."""
    tagged = [p.withColumn("__run", F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0]
    for p in tagged[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return first_wins(out, [key], ["__run", *order]).drop("__run")


def run_folder(spark: SparkSession, root: str, stamp: str) -> str:
    """A new folder for this run; _2, _3 … when the stamp is taken.  Earlier runs are never rewritten.

    The folder belongs to whoever creates its mark, which only one writer can.
    """
    store, n = Store(spark, root), 1
    while True:
        path = f"{root}/{stamp}" if n == 1 else f"{root}/{stamp}_{n}"
        if not store.exists(path) and store.create(f"{path}/{CLAIMED}", stamp.encode()):
            return path
        n += 1


def commit(spark: SparkSession, folder: str, start: str | None, now: dt.datetime | None = None) -> None:
    """The last act of a run: without this mark the next run reads the same window again.  It appears at once, and only once."""
    at = (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    if not Store(spark, folder).create(f"{folder}/.complete", f"start={start or 'full'}\ncompleted_at={at}\n".encode()):
        raise FileExistsError(f"{folder} is committed already")


def sync(rows: DataFrame, root: str, stamp: str, ts: str = "ts", full: bool = False, since: str | None = None, dry_run: bool = False, more: Callable[[str], dict] | None = None, seconds: float = SECONDS, working: str | None = None) -> dict:
    """One incremental run of a message table: returns its plan, and unless dry_run writes and commits it.

    ``more`` does the rest of a run in its folder before the commit.  One run writes at a time, under a lease that outlives no crash;
    a run whose lease was taken over does not commit.
    """
    spark = rows.sparkSession
    start = start_day(snapshots(spark, root), full, since)
    plan = {"start": start, "root": root, "stamp": stamp, "steps": steps(working or root, root, stamp, start)}
    if dry_run:
        return plan
    with lease(spark, working or root, seconds) as held:
        folder = run_folder(spark, root, stamp)
        window(rows, ts, start).write.parquet(f"{folder}/messages")
        told = more(folder) if more else {}
        held.check()
        commit(spark, folder, start)
    return plan | {"folder": folder} | told


def steps(working: str, root: str, stamp: str, start: str | None) -> list[str]:
    """What a run does, in order, for its printed plan."""
    window_text = "all messages" if start is None else f"messages from {start} on"
    return [f"take the lease {working}/.lease", f"write {window_text} to {root}/{stamp}/messages", f"write pages, members and books below {root}/{stamp}", f"commit {root}/{stamp}/.complete"]


def archive(spark: SparkSession, root: str, key: str, order: list[str]) -> DataFrame:
    """All committed runs merged."""
    parts = [spark.read.parquet(f"{root}/{s}/messages") for s, complete in snapshots(spark, root) if complete]
    return merge_overlap(parts, key, order)


def growth(runs: DataFrame, stamp: str, counts: list[str]) -> DataFrame:
    """Adds more_<count>: how much each count has grown since the run before; null for the first.  One row a run."""
    before = Window.orderBy(stamp)
    return runs.select("*", *[(F.col(c) - F.lag(c).over(before)).alias(f"more_{c}") for c in counts])


#: Times between which a watermark moves; pandas knows none before 1677 and after 2262.
EARLIEST, LATEST = "1680-01-01 00:00:00", "2260-01-01 00:00:00"


def stream_first(rows: DataFrame, key: str, order: str, ts: str, delay: str = "1 day") -> DataFrame:
    """The rows of a stream that are the first of their key by ``order`` so far, whatever order they arrive in.

    A state a key holds the order of its best row; a later arrival that comes before it in order is passed on too, so that the first
    copy of what has been passed on (:func:`first_wins`, :func:`followed`) is the first of all.  States go when the watermark
    has passed their time, and rows older than that are dropped as late.  Times reach Python as numbers or texts, whatever their year;
    for the watermark those behind ``LATEST`` count as that.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    times = {TimestampType: (F.unix_micros, F.timestamp_micros, LongType()), TimestampNTZType: (lambda c: c.cast("string"), lambda c: F.to_timestamp_ntz(c), StringType())}
    coded = {c: times[type(k)] for c, k in kinds.items() if type(k) in times}
    schema = StructType([StructField(c, coded[c][2] if c in coded else k) for c, k in kinds.items()])
    plain, kind = list(kinds), schema[order].dataType
    first, last = (F.lit(x).cast(kinds[ts]) for x in (EARLIEST, LATEST))
    at = F.when(F.col(ts) > last, last).when(F.col(ts) < first, first).otherwise(F.col(ts))

    def better(_, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        best = state.get[0] if state.exists else None
        found, latest = None, 0
        for frame in frames:
            latest = max(latest, int(frame["__at"].max().value // 1_000_000))
            row = frame.sort_values([order, "__at", ts], kind="stable").iloc[:1]
            if found is None or row[order].iloc[0] < found[order].iloc[0]:
                found = row
        if best is None or found[order].iloc[0] < best:
            best = found[order].iloc[0]
            state.update((best.item() if hasattr(best, "item") else best,))
            yield found[plain]
        else:
            yield found[plain].iloc[:0]
        state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + 1)

    marked = rows.withColumn("__at", at).withWatermark("__at", delay).withColumns({c: to(F.col(c)) for c, (to, _, _) in coded.items()})
    passed = marked.groupBy(key).applyInPandasWithState(better, schema, StructType([StructField("best", kind)]), "append", "EventTimeTimeout")
    return passed.withColumns({c: back(F.col(c)) for c, (_, back, _) in coded.items()}) if coded else passed


def follow(rows: DataFrame, key: str, order: str, ts: str, out: str, checkpoint: str, delay: str = "1 day"):
    """Appends what :func:`stream_first` passes on as Parquet, up to the present end of the source; Spark's commit log takes the
    place of the commit mark."""
    first = stream_first(rows, key, order, ts, delay)
    return first.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def followed(spark: SparkSession, out: str, key: str, order: str) -> DataFrame:
    """The first row of each key of a followed source."""
    return first_wins(spark.read.parquet(out), [key], [order])


def stream_counts(rows: DataFrame, ts: str, by: str, window_length: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Messages per window and kind with late data up to the watermark; an extension for monitoring."""
    return rows.withWatermark(ts, delay).groupBy(F.window(ts, window_length), by).agg(F.count("*").alias("n"))
