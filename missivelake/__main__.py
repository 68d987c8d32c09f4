"""Command line: python -m missivelake sync|snapshot|growth|audit|merge|group|voice|sanitize …

MISSIVELAKE_ROOT names the archive, MISSIVELAKE_WORKING_DIR the folder of the sync's lease, MISSIVELAKE_WORK a folder that all
executors share for intermediate tables.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os


def parser() -> argparse.ArgumentParser:
    root = os.environ.get("MISSIVELAKE_ROOT", "archive")
    p = argparse.ArgumentParser(prog="missivelake", description=__doc__)
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("sync", help="one incremental run over a message store")
    s.add_argument("store")
    s.add_argument("--root", default=root)
    s.add_argument("--since")
    s.add_argument("--addressbook-dir")
    s.add_argument("--working-dir", default=os.environ.get("MISSIVELAKE_WORKING_DIR"), help="where the lease lies; without, the archive")
    s.add_argument("--full", action="store_true")
    s.add_argument("--dry-run", action="store_true")
    s = sub.add_parser("snapshot", help="copy a store, sync its attachments, audit the copy")
    s.add_argument("store")
    s.add_argument("--attachments")
    s.add_argument("--stickers")
    s.add_argument("--root", default=root)
    s.add_argument("--dry-run", action="store_true")
    s = sub.add_parser("growth", help="how the snapshots have grown")
    s.add_argument("--root", default=root)
    s = sub.add_parser("audit", help="check every attachment reference")
    s.add_argument("store")
    s.add_argument("shared")
    s.add_argument("--out", default=root)
    s.add_argument("--exclude-from")
    s = sub.add_parser("merge", help="merge pages of one thread")
    s.add_argument("files", nargs="+")
    s.add_argument("-o", "--output")
    s.add_argument("--inspect", action="store_true")
    s = sub.add_parser("group", help="merge pages by contact")
    s.add_argument("files", nargs="+")
    s.add_argument("-o", "--output", required=True)
    s.add_argument("--addressbook", action="append", default=[])
    s.add_argument("--dry-run", action="store_true")
    s = sub.add_parser("voice", help="convert voice conversation files")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--attachments-root")
    s.add_argument("--media-dir")
    s.add_argument("--addressbook", action="append", default=[])
    s.add_argument("--dry-run", action="store_true")
    s = sub.add_parser("sanitize", help="normalise attachment names and references")
    s.add_argument("root")
    s.add_argument("--out", help="write changed pages and files there; without, change the archive itself")
    s.add_argument("--html-dir", action="append")
    s.add_argument("--dry-run", action="store_true")
    return p


def main(arguments: list[str] | None = None, spark=None) -> dict | list:
    a = parser().parse_args(arguments)
    from pyspark.sql import SparkSession

    from missivelake.plans import workflows as w

    if spark is None:
        builder = SparkSession.builder.appName(f"missivelake-{a.job}").config("spark.sql.session.timeZone", os.environ.get("TZ", "UTC"))
        if "MISSIVELAKE_WORK" in os.environ:
            builder = builder.config("spark.checkpoint.dir", os.environ["MISSIVELAKE_WORK"])
        spark = builder.getOrCreate()
    stamp = dt.datetime.now().strftime("%Y-%m-%d_%H%M%S")
    if a.job == "sync":
        found = w.sync_store(spark, a.store, a.root, stamp, a.full, a.since, a.dry_run, a.addressbook_dir, a.working_dir)
    elif a.job == "snapshot":
        found = w.snapshot(spark, a.store, a.root, stamp, a.attachments, a.stickers, a.dry_run)
    elif a.job == "growth":
        found = [r.asDict() for r in w.growth(spark, a.root).collect()]  # one row a run
    elif a.job == "audit":
        found = w.audit_snapshot(spark, a.store, a.shared, a.out, exclude_from=a.exclude_from)
    elif a.job == "merge":
        found = w.merge_pages(spark, a.files, a.output) if a.output and not a.inspect else w.inspect_pages(spark, a.files)
    elif a.job == "group":
        found = w.group_by_contact(spark, a.files, a.addressbook, a.output, a.dry_run)
    elif a.job == "voice":
        found = w.convert_voice(spark, a.input_dir, a.output_dir, a.media_dir, a.attachments_root, a.addressbook, a.dry_run)
    else:
        found = w.sanitize_archive(spark, a.root, a.out, a.html_dir, a.dry_run)
    print(json.dumps(found, indent=2, default=str))
    return found


if __name__ == "__main__":
    main()
