"""Whole jobs over an archive, composed of the operators.  Each returns what it did or would do."""

from __future__ import annotations

import datetime as dt
import os
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators import audit, contacts, dedup, export, participants, sanitize, threads
from missivelake.sources import files, html_pages, sinks, sqlite_source
from missivelake.sources.sorted_files import write_sorted
from missivelake.sources.stores import plain, staged
from missivelake.streaming import incremental

EXCLUDES = ".attachment-excludes"
RENAMES = ".attachment-renames.json"
#: Entries of each list that a report shows.
SHOWN = 100


def books(spark: SparkSession, paths: list[str]) -> list[dict[str, DataFrame]]:
    """The readable contact books, in order."""
    found = [sqlite_source.read_book(spark, p) for p in paths]
    return [b for b in found if b is not None]


def refresh_books(spark: SparkSession, source: str, cache: str) -> str:
    """Brings the archive's own copy of the contact books up to date, with their side files, and returns its folder.

    A book that is absent, empty or unreadable just now leaves the last good copy in place.
    """
    for path in sqlite_source.book_paths(source):
        files.refresh(spark, path, os.path.join(cache, os.path.relpath(path, source)))
    return cache


def copy_store(spark: SparkSession, source: str, folder: str) -> str:
    """A consistent copy of a message store: side files first, the store last; the source is never written.  Shards are copied by
    tasks."""
    target = os.path.join(plain(folder), os.path.basename(source))
    if os.path.isdir(source):
        found = files.inventory(spark, source)
        sinks.copy_files(found.select(F.col("path").alias("source"), F.concat(F.lit(f"{target}/"), "rel_path").alias("target")))
        return target
    os.makedirs(plain(folder), exist_ok=True)
    for tail in ("-wal", "-shm", ""):
        if os.path.exists(source + tail):
            shutil.copy2(source + tail, target + tail)
    return target


def plan_sync(spark: SparkSession, source_root: str, target_root: str, patterns: DataFrame | None = None) -> DataFrame:
    """(source, target, change): files that the target lacks or holds with another size or older time.  Files
    are never deleted; names that an exclude pattern matches stay out."""
    wanted = files.inventory(spark, source_root).select("rel_path", "length", "mtime", F.col("path").alias("source"))
    if patterns is not None:
        wanted = wanted.join(audit.excluded(wanted.select("rel_path"), patterns, "rel_path").distinct(), "rel_path", "left_anti")
    there = files.inventory(spark, target_root).select("rel_path", "length", "mtime")
    changed = dedup.new_or_changed(wanted, there, "rel_path", ["length", "mtime"])
    return changed.select("source", F.concat(F.lit(target_root.rstrip("/") + "/"), "rel_path").alias("target"), "change")


def audit_snapshot(spark: SparkSession, store: str, shared: str, out: str, stickers: str | None = None, exclude_from: str | None = None) -> dict:
    """Checks every attachment reference of a store; writes the audit, a report and the manifest into ``out``."""
    stickers = stickers or os.path.join(shared, "StickerCache")
    check, n_messages, n_attachments = sqlite_source.integrity_of(spark, store)
    tables = sqlite_source.read_messages(spark, store)
    codes, names = audit.chat_codes(tables)
    refs = audit.coded_references(tables, codes)
    inventory = spark.createDataFrame([], "path string, length bigint")
    for root in (shared, stickers):
        inventory = inventory.union(files.inventory(spark, root).select("path", "length"))
    patterns = files.read_patterns(spark, exclude_from) if exclude_from else None
    done = audit.classify(refs, inventory.distinct(), patterns, shared, stickers)
    now = dt.datetime.now().strftime("%Y-%m-%dT%H:%M:%S")
    path = os.path.join(out, "attachment-audit.json")
    done = staged(done, "audit")
    sinks.write_document(audit.document_pieces(done, now, store, shared, names), path, audit.RECORD_ORDER)
    total = audit.totals(done).first()
    lines = audit.report_lines(done, names=names).select(F.lit("audit-report.txt").alias("name"), F.lit(1).alias("kind"), F.concat("line", F.lit("\n")).alias("text"), "status", "code", "rn")
    write_sorted(lines, out, ["status", "code", "rn"], "")
    values = {
        "snapshot_time": now, "source_db": store, "message_count": n_messages, "attachment_rows": n_attachments, "integrity_check": check, "zero_byte_attachments": total["zero_byte"],
        "missing_attachments": total["missing"], "attachment_audit": path, "shared_attachments": shared, "wal_copied": "yes" if os.path.exists(store + "-wal") else "no",
    }
    files.replace_text(spark, os.path.join(out, "manifest.txt"), sinks.manifest_text(values))
    return values


def snapshot(spark: SparkSession, store: str, root: str, stamp: str, attachments: str | None = None, stickers: str | None = None, dry_run: bool = False) -> dict:
    """Copies a store, brings the attachment folders up to date and audits the copy: one folder a run below
    ``root/snapshots``, attachments in ``root/Attachments`` and ``root/StickerCache``.

    Names that a sanitising run has recorded as exclude patterns are not copied again.  Nothing is deleted.
    """
    patterns = files.read_patterns(spark, os.path.join(root, EXCLUDES))
    plans = {
        name: plan_sync(spark, source, os.path.join(root, name), patterns)
        for name, source in (("Attachments", attachments), ("StickerCache", stickers))
        if source and os.path.isdir(source)
    }
    if dry_run:
        return {name: plan.count() for name, plan in plans.items()}
    folder = incremental.run_folder(spark, os.path.join(root, "snapshots"), stamp)
    copy = copy_store(spark, store, folder)
    copied = {name: sinks.copy_files(plan) for name, plan in plans.items()}
    values = audit_snapshot(spark, copy, os.path.join(root, "Attachments"), folder, os.path.join(root, "StickerCache"), os.path.join(root, EXCLUDES))
    return values | {"folder": folder, "copied": copied}


def growth(spark: SparkSession, root: str) -> DataFrame:
    """(stamp, messages, attachments, more_messages, more_attachments) of the snapshots below a root, from
    their manifests; one row a run.  Counts that a manifest does not know are null."""
    pages = spark.read.text(os.path.join(root, "snapshots"), wholetext=True, pathGlobFilter="manifest.txt", recursiveFileLookup=True)
    number = lambda key: F.try_to_number(F.regexp_extract("value", rf"(?m)^{key}: (\d+)$", 1), F.lit("9999999999999999")).cast("long")
    stamp = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/manifest.txt$", 1)
    rows = pages.select(stamp.alias("stamp"), number("message_count").alias("messages"), number("attachment_rows").alias("attachments"))
    return incremental.growth(rows, "stamp", ["messages", "attachments"])


def named_pages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The pages of named files by whole path; every one has to exist."""
    missing = [p for p in paths if not os.path.isfile(p)]
    if missing or not paths:
        raise ValueError(f"no such file: {missing}" if missing else "no input files")
    return html_pages.in_order(spark, paths)


def merge_pages(spark: SparkSession, paths: list[str], out: str | None) -> dict:
    """One page of several: one copy of each id, the first by input order, in time order, within the first page."""
    pages = named_pages(spark, paths)
    rows = staged(html_pages.parse_messages(pages), "parsed")
    merged = dedup.first_wins(rows, ["guid"], ["file_ord", "msg_ord"])
    told = {r["file"]: (r["n_in"], r["n_new"]) for r in dedup.contribution(rows, ["guid"], ["file_ord", "msg_ord"], "file").collect()}  # one row an input
    stats = {p: told.get(os.path.abspath(p), (0, 0)) for p in paths}
    counts = merged.agg(F.count("*").alias("n"), F.count_if(F.col("ts_key") != "").alias("dated")).first()
    if out:
        name = F.lit(os.path.basename(out))
        shell = html_pages.shells(pages.filter("file_ord = 0")).select(name.alias("thread"), "before", "after")
        sinks.write_pages(sinks.page_pieces(merged.withColumn("thread", name), "thread", shells=shell), os.path.dirname(out) or ".")
    return {"files": stats, "messages": counts["n"], "dated": counts["dated"], "duplicates": sum(a for a, _ in stats.values()) - counts["n"]}


def inspect_pages(spark: SparkSession, paths: list[str]) -> list[dict]:
    """What merging would find in each page; nothing is written."""
    found = html_pages.inspect(html_pages.parse_messages(named_pages(spark, paths)))
    return [r.asDict() for r in found.orderBy("file").collect()]  # one row an input


def group_by_contact(spark: SparkSession, paths: list[str], book_paths: list[str], out: str, dry_run: bool = False) -> list[tuple]:
    """Pages of one person merged into one; pages without a known contact stay as they are.

    Outputs are named after a group's first page; equal names of different groups, and names that ``out`` holds already, are numbered.
    """
    pages = named_pages(spark, paths)
    plan = contacts.plan_groups(pages, contacts.handle_map(books(spark, book_paths))).withColumn("__first", F.col("output_name"))
    there = files.inventory(spark, out).filter("not contains(rel_path, '/')").select(F.col("rel_path").alias("output_name"))
    plan = staged(dedup.numbered_names(plan.withColumn("output_name", T.basename(F.col("output_name"))), "output_name", ["__first"], "target", there), "plan")
    of = plan.select(F.explode("files").alias("f"), "target", F.col("__first").alias("first")).select(F.col("f.file").alias("file"), "target", "first")
    report = [(r["target"], r["display_name"], len(r["files"]), r["n_messages"]) for r in plan.orderBy("target").collect()]  # one row an output
    if not dry_run:
        messages = html_pages.parse_messages(pages).join(of.select("file", "target"), "file")
        merged = dedup.first_wins(messages, ["target", "guid"], ["file_ord", "msg_ord"])
        shell = html_pages.shells(pages).join(of.filter("file = first").select("file", "target"), "file")
        sinks.write_pages(sinks.page_pieces(merged, "target", shells=shell), out)
    return report


def convert_voice(spark: SparkSession, source: str, out: str, media: str | None = None, attachments: str | None = None, book_paths: list[str] | None = None, dry_run: bool = False) -> dict:
    """Voice conversation files as one page a thread, with the members of groups beside them."""
    pages = html_pages.with_order(html_pages.read_pages(spark, source))
    skipped = {r["kind"]: (r["n"], r["samples"]) for r in threads.skipped(pages).collect()}
    chunks = staged(html_pages.parse_chunks(pages.filter(T.file_kind(F.col("file")).isin("Text", "Group"))), "chunks")  # parsed once
    found = books(spark, book_paths or [])
    handles = contacts.handle_map(found) if found else None
    messages = threads.messages_of(threads.identify(chunks, contacts.numbers_by_name(handles) if handles is not None else None))
    messages = staged(messages, "messages")
    plan = staged(threads.plan(messages), "plan").orderBy(F.desc("n_messages"), "thread_key")
    report = {"skipped": skipped, "threads": [tuple(r) for r in plan.collect()]}
    store = files.inventory(spark, media).select("path") if media else spark.createDataFrame([], "path string")
    report["attachments"] = tuple(threads.attachment_totals(messages, store).first())
    report["unresolved"] = [r["att"] for r in threads.unresolved(messages, store).collect()]  # at most ten
    report["own_number"] = threads.own_number(chunks).first()["own_number"]
    if not dry_run:
        resolved = threads.resolve_attachments(messages, store)
        if attachments:
            kept = store.select(T.basename(F.col("path")).alias("name"), F.col("path").alias("source"))
            used = resolved.select(F.explode("resolved").alias("source")).distinct().join(kept, "source")
            sinks.copy_files(used.select("source", F.concat(F.lit(attachments.rstrip("/") + "/"), "name").alias("target")))
            resolved = resolved.withColumn("resolved", F.transform("resolved", lambda p: F.concat(F.lit(os.path.basename(attachments.rstrip("/")) + "/"), T.basename(p))))
        sinks.write_pages(threads.page_pieces(resolved, threads.thread_names(messages, handles), plan), out, ["ts", "place"])
        groups = threads.group_sidecar(messages).select(F.col("output_name").alias("file"), F.col("members").alias("handles"))
        sinks.write_document(participants.sidecar_pieces(groups), os.path.join(out, "group_participants.json"), ["file"])
    return report


def sanitize_archive(spark: SparkSession, root: str, out: str | None = None, html_dirs: list[str] | None = None, dry_run: bool = False) -> dict:
    """Normalises attachment names and the references to them.

    Without ``html_dirs`` every bad name below an attachment root changes; with them, only names that pages in
    these folders refer to.  With ``out`` the archive stays as it is, and changed pages and files are written there
    under their relative paths; without, pages are replaced and files renamed in place.  Changed names are recorded
    as exclude patterns, so that a later sync does not bring the old ones back, and in a log; files that came back under a
    logged old name go.  Files of one new name are told apart by their bytes (:func:`sanitize.settle`): copies go, others get a
    name of their own, and both are reported.  The report shows the first ``SHOWN`` of each list; the log has all renames.
    """
    root = os.path.abspath(root)
    read = html_pages.read_pages(spark, html_dirs or root, recursive=True)
    pages = read.select(F.col("path").alias("file"), F.col("text").alias("html"))
    tree = staged(files.inventory(spark, root).select("rel_path"), "tree")
    skipped = spark.createDataFrame([], "old_path string")
    if html_dirs:
        plan = staged(sanitize.scoped_plan(pages, tree.select(F.col("rel_path").alias("path"))), "plan")
        skipped = plan.filter("skipped").select("old_path")
        pairs = plan.filter("not skipped and old_path <> new_path").select("old_path", "new_path")
    else:
        pairs = sanitize.renames(sanitize.below_roots(tree).select(F.lit(root).alias("root"), "rel_path")).select("old_path", "new_path")
    log = files.read_log(spark, os.path.join(root, RENAMES))
    back = sanitize.heal_candidates(log, tree.select(F.col("rel_path").alias("path"))).select(F.col("old").alias("old_path"), F.col("new").alias("new_path"))
    settled = staged(sanitize.settle(pairs if out else pairs.union(back), tree, sinks.digests, root), "settled")  # files change below
    rewritten = sanitize.rewrite(pages, settled)
    totals = rewritten.agg(F.coalesce(F.sum("n_updated"), F.lit(0)).alias("refs"), F.count_if(F.col("n_updated") > 0).alias("pages")).first()
    excludes = files.read_patterns(spark, os.path.join(root, EXCLUDES))
    patterns = sanitize.new_excludes(settled.select(F.lit("").alias("rel_dir"), F.col("old_path").alias("old_name")), excludes)
    shown = lambda rows, *columns: [tuple(r) if len(columns) > 1 else r[0] for r in rows.select(*columns).orderBy(*columns).limit(SHOWN).collect()]
    report = {
        "roots": [r["root"] for r in sanitize.attachment_roots(tree).orderBy("root").collect()], "renames": shown(settled, "old_path", "new_path"), "n_renames": settled.count(), "skipped": shown(skipped, "old_path"),
        "duplicates": shown(settled.filter("action = 'remove'"), "old_path", "new_path"), "collisions": shown(settled.filter("collision"), "old_path", "new_path"),
        "references": totals["refs"], "pages": totals["pages"], "excludes": files.write_patterns(patterns, os.path.join(root, EXCLUDES), dry_run),
    }
    if dry_run:
        return report
    base = F.lit(root + "/")
    relative = F.when(F.startswith(F.col("file"), base), F.substring("file", len(root) + 2, 1 << 20)).otherwise(T.basename(F.col("file")))
    changed = rewritten.filter("n_updated > 0")
    if out:
        sinks.write_text_files(changed.select(relative.alias("name"), "html"), out, "name", "html")
        report["files"] = sinks.copy_files(settled.filter("action = 'move'").select(F.concat(base, "old_path").alias("source"), F.concat(F.lit(out.rstrip("/") + "/"), "new_path").alias("target")))
    else:
        # A repeated task finds no old reference in a page that was replaced already, and leaves it.
        sinks.write_text_files(changed.select(F.col("file").alias("name"), "html"), "/", "name", "html")
        acted = settled.filter("action is not null").select(F.concat(base, "old_path").alias("source"), F.concat(base, "new_path").alias("target"), "action")
        report["files"] = sinks.move_files(acted).filter("done").count()
        files.write_log(log.join(settled, log["old"] == settled["old_path"], "left_anti").union(settled.select("old_path", "new_path")), os.path.join(root, RENAMES))
    return report


def sync_store(spark: SparkSession, store: str, root: str, stamp: str, full: bool = False, since: str | None = None, dry_run: bool = False, book_folder: str | None = None, working: str | None = None) -> dict:
    """One incremental run over a message store.

    Messages from the window on are written as a table and as pages, one for each chat, below a new run folder; references
    lose the archive's own path; the members of group pages go into a file beside them, and the books, united, into tables.
    The commit mark comes last.  The lease lies in the working folder, which may be another one than the archive's.
    """
    tables = sqlite_source.read_messages(spark, store)
    handles, united = None, {}
    if book_folder:
        found = books(spark, sqlite_source.book_paths(book_folder if dry_run else refresh_books(spark, book_folder, os.path.join(root, "Contacts"))))
        united = contacts.union_books(found)
        handles = contacts.handle_map(found) if found else None
    root = os.path.abspath(root)
    messages = export.thread_messages(tables, handles, os.path.join(root, "Attachments"), os.path.join(root, "StickerCache"))

    def pages(folder: str) -> dict:
        """The rest of the run, from the messages just written."""
        rows = export.rendered(spark.read.parquet(os.path.join(folder, "messages")))
        pieces = sinks.page_pieces(dedup.first_wins(rows, ["file", "guid"], ["ts_key"]), "file", F.regexp_replace("file", r"\.html$", ""))
        pieces = pieces.withColumn("text", T.strip_prefix(F.col("text"), F.lit(root + "/")))
        n = sinks.write_pages(pieces, os.path.join(folder, "html"))
        members = n > 0 and sinks.write_document(participants.shared_sidecar_pieces(staged(participants.resolved_chats(html_pages.read_candidates(spark, os.path.join(folder, "html")), tables), "chats"), participants.member_lists(tables)), os.path.join(folder, "group_participants.json"), ["file"])
        for name, table in united.items():
            sinks.write_version(table, os.path.join(folder, "book", name))
        return {"pages": n, "participants": bool(members), "books": sorted(united)}

    return incremental.sync(messages, root, stamp, "ts", full, since, dry_run, pages, working=working)
