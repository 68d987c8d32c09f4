"""Registered queries that run whole jobs on archives made from the synthetic tables, and return what they left behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators.ranks import ranked
from missivelake.plans import archive_queries as made
from missivelake.plans import workflows
from missivelake.plans.archive_queries import DIV_SQL, HANDLES, PAGE_GUID_SQL, TS, TS_SQL, read_back, read_lines, spark_of, text, work_folder
from missivelake.plans.catalogue import query
from missivelake.sources import files, html_pages, sinks, sqlite_source

#: Pages that the messages of all conversations are dealt to.
PAGES = 20


def dealt_pages(t, named) -> str:
    """Writes the conversations' messages as exported pages, each below the names that ``named`` gives it; returns the folder."""
    id_ = F.concat(F.lit("BBBBBBBB-0000-4000-8000-"), F.lpad(text("conv_id"), 6, "0"), F.lpad(text("turn"), 6, "0"))
    one = F.concat(F.lit('<div class="message"><p><span class="timestamp"><a href="sms://open?message-guid='), id_, F.lit('">'), T.display_time(F.expr(TS)), F.lit("</a></span></p><b>"), F.col("role"), F.lit("</b></div>"))
    rows = t("conversations").select(F.explode(F.array_distinct(named)).alias("name"), F.lit(1).alias("kind"), one.alias("text"), "conv_id", "turn")
    ends = rows.select("name").distinct().select("name", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.lit("<html><head><title>t</title></head><body>\n").alias("text")), F.struct(F.lit(2).alias("kind"), F.lit("\n</body></html>").alias("text")))).alias("x"))
    folder = work_folder(spark_of(rows))
    sinks.write_pages(rows.unionByName(ends.select("name", "x.*"), allowMissingColumns=True), folder, ["conv_id", "turn"])
    return folder


def listed(spark, folder: str) -> list[str]:
    """The pages of a folder by name: as many as the fixture deals to."""
    return sorted(r["path"] for r in files.inventory(spark, folder).select("path").collect())


@query(f"""WITH m AS (SELECT *, {TS_SQL} AS ts, lpad(CAST(conv_id % {PAGES} AS VARCHAR), 2, '0') AS a, lpad(CAST((conv_id + 1) % {PAGES} AS VARCHAR), 2, '0') AS b FROM conversations)
SELECT {PAGE_GUID_SQL} AS guid, row_number() OVER (ORDER BY ts, least(a, b), conv_id, turn) AS pos FROM m""")
def job_merge(t):
    """Twenty named pages, each message in two of them, merged into one: its messages in their order."""
    spark = spark_of(t("conversations"))
    name = lambda k: F.concat(F.lpad((k % PAGES).cast("string"), 2, "0"), F.lit(".html"))
    folder = dealt_pages(t, F.array(name(F.col("conv_id")), name(F.col("conv_id") + 1)))
    out = work_folder(spark) + "/merged.html"
    workflows.merge_pages(spark, listed(spark, folder), out)
    lines = read_lines(spark, out).select(F.regexp_extract("value", T.MESSAGE_GUID, 1).alias("guid"), "block", "at", F.lit("all").alias("of")).filter("guid <> ''")
    return ranked(lines, ["of"], ["block", "at"], "pos").select("guid", "pos")


@query(f"""WITH {HANDLES}, m AS (SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN '+155500' || lpad(CAST(conv_id % 40 AS VARCHAR), 5, '0') ELSE coalesce(s_name || '@X.com', 'stray') END AS stem FROM conversations LEFT JOIN supplier ON s_suppkey = conv_id % 10 + 1),
f AS (SELECT stem, count(*) AS n, CASE WHEN stem LIKE '+%' THEN right(stem, 10) ELSE lower(stem) END AS norm_handle FROM m GROUP BY stem),
p AS (SELECT f.*, coalesce(person_key, 'file:' || stem) AS g, display_name FROM f LEFT JOIN h USING (norm_handle))
SELECT arg_min(stem, (-n, stem)) || '.html' AS target, min(display_name) AS display_name, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_messages FROM p GROUP BY g""")
def job_group(t):
    """Pages named after numbers and addresses, merged by person: the outputs that were written."""
    spark = spark_of(t("conversations"))
    suppliers = t("supplier").select(F.col("s_suppkey").alias("__k"), "s_name")
    k = F.col("conv_id")
    named = t("conversations").join(suppliers, k % 10 + 1 == F.col("__k"), "left")
    stem = F.when(k % 2 == 0, F.concat(F.lit("+155500"), F.lpad((k % 40).cast("string"), 5, "0"))).otherwise(F.coalesce(F.concat("s_name", F.lit("@X.com")), F.lit("stray")))
    folder = dealt_pages(lambda _: named, F.array(F.concat(stem, F.lit(".html"))))
    out = work_folder(spark)
    report = workflows.group_by_contact(spark, listed(spark, folder), sqlite_source.book_paths(made.book_folder(t)), out)
    told = spark.createDataFrame(report, "target string, display_name string, n_files long, told long")  # one row an output
    pages = read_back(spark, out).select(F.col("file").alias("target"), F.size(T.message_guids(F.col("text"))).cast("long").alias("n_messages"))
    return told.join(pages, "target").filter("told = n_messages").select("target", "display_name", "n_files", "n_messages")


#: The job knows the contacts' names, which stand for the numbers of conversations of two.
NAMED_PAGES = made.ORACLE_VOICE_PAGES.replace("coalesce(max(CASE WHEN NOT is_me", "coalesce(CASE WHEN thread_kind = '1:1' AND max(k) < 25 THEN 'user' || max(k) END, max(CASE WHEN NOT is_me")
NAMED_PAGES = NAMED_PAGES.replace("""<img src="' || att || '\"""", """<img src="' || CASE WHEN conv_id % 2 = 0 THEN 'Attachments/' || att || '.jpg' END || '\"""")


@query(NAMED_PAGES)
def job_voice(t):
    """Voice files converted by the job: every thread's page."""
    spark = spark_of(t("conversations"))
    source, out = work_folder(spark), work_folder(spark)
    stamp = F.regexp_extract("file", r" - Text - (\d+)Z", 1)
    named = F.concat(F.regexp_extract("file", r"^(.* - Text - )\d+Z", 1), F.lpad(stamp, 18, "0"), F.lit("Z.html"))  # stamps of one length, which sort as they rise
    sinks.write_text_files(made.voice_files(t).withColumn("file", named), source, "file", "text")
    contacts = t("nation").select(F.col("n_nationkey").alias("Z_PK"), F.concat(F.lit("user"), text("n_nationkey")).alias("ZFIRSTNAME"), F.lit(None).cast("string").alias("ZLASTNAME"), F.lit(None).cast("string").alias("ZORGANIZATION"))
    numbers = t("nation").select(F.col("n_nationkey").cast("long").alias("ROWID"), F.col("n_nationkey").cast("long").alias("ZOWNER"), F.concat(F.lit("555"), F.lpad(text("n_nationkey"), 7, "0")).alias("ZFULLNUMBER"))
    book = sqlite_source.write_tables(work_folder(spark), {"ZABCDRECORD": contacts, "ZABCDPHONENUMBER": numbers})
    store = work_folder(spark)
    sinks.write_text_files(made.media(t).select("path", F.lit("x").alias("text")), store, "path", "text")
    workflows.convert_voice(spark, source, out, store, f"{out}/Attachments", [book])
    return read_back(spark, out).select("file", F.col("text").alias("html"))


def full_store(t) -> dict[str, DataFrame]:
    """The store of ``archive_queries`` with ids as pages have them."""
    tables = made.store(t)
    return tables | {"message": tables["message"].withColumn("guid", F.concat(F.lit(made.GUIDS), F.lpad(text("ROWID"), 12, "0")))}


SINCE = "2002-01-01"
STORE_PAGES = made.ORACLE_THREADS.replace("'G' || c_custkey AS guid", f"'{made.GUIDS}' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS guid, c_custkey")


@query(f"""WITH x AS ({STORE_PAGES}) SELECT file, guid, strftime(TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS ts_key FROM x
WHERE c_custkey % 11 <> 0 AND TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey AS INTEGER)) >= TIMESTAMP '{SINCE}'""")
def job_sync(t):
    """A sync from a day on, with refreshed contact books: the messages of the pages it wrote."""
    spark = spark_of(t("customer"))
    store = sqlite_source.write_tables(work_folder(spark) + "/chat", full_store(t))
    done = workflows.sync_store(spark, store, work_folder(spark), "2030-01-01_000000", since=SINCE, book_folder=made.book_folder(t), working=work_folder(spark))
    return html_pages.read_messages(spark, f"{done['folder']}/html", "div").select("file", "guid", "ts_key")


@query(f"""WITH {made.NAMES}, r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey > (SELECT count(*) FROM customer) THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'zero_byte' ELSE 'ok' END AS status
FROM orders JOIN customer ON o_custkey = c_custkey JOIN chats ON c_nationkey = c WHERE o_orderkey % 5 NOT IN (1, 2))
SELECT unnest(['message_count', 'attachment_rows', 'integrity_check', 'zero_byte_attachments', 'missing_attachments', 'copied']) AS key,
unnest([CAST((SELECT count(*) FROM customer) AS VARCHAR), CAST((SELECT count(*) FROM orders) AS VARCHAR), 'ok', CAST(count(*) FILTER (status = 'zero_byte') AS VARCHAR), CAST(count(*) FILTER (status = 'missing') AS VARCHAR), CAST((SELECT count(*) FROM customer) AS VARCHAR)]) AS value FROM r""")
def job_snapshot(t):
    """A snapshot of a store and its attachments, and what its manifest says."""
    spark = spark_of(t("customer"))
    store = sqlite_source.write_tables(work_folder(spark) + "/chat", full_store(t))
    live, root, k = work_folder(spark), work_folder(spark), F.col("c_custkey")
    there = t("customer").select(F.concat((k % 100).cast("string"), F.lit("/"), text("c_custkey"), F.lit(".jpg")).alias("name"), F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("x")).alias("text"))
    sinks.write_text_files(there, live, "name", "text")
    done = workflows.snapshot(spark, store, root, "2030-01-01_000000", live)
    lines = spark.read.text(f"{done['folder']}/manifest.txt").select(F.split("value", ": ", 2).alias("p")).select(F.col("p")[0].alias("key"), F.col("p")[1].alias("value"))
    wanted = lines.filter(F.col("key").isin("message_count", "attachment_rows", "integrity_check", "zero_byte_attachments", "missing_attachments"))
    return wanted.union(files.inventory(spark, f"{root}/Attachments").agg(F.count("*").cast("string").alias("value")).select(F.lit("copied"), "value"))


@query(f"""WITH {made.COLLIDING}, s AS (SELECT DISTINCT CASE WHEN holds THEN old_path ELSE stem || CASE WHEN bytes = winner THEN '' ELSE '_' || sha256(bytes)[1:8] END || '.jpg' END AS rel_path, length(bytes) AS length FROM h),
d AS (SELECT g, old_path, CASE WHEN holds THEN old_path ELSE stem || CASE WHEN bytes = winner THEN '' ELSE '_' || sha256(bytes)[1:8] END || '.jpg' END AS new_path FROM h)
SELECT rel_path, CAST(length AS BIGINT) AS length, NULL AS text FROM s
UNION ALL SELECT 'pages/' || g || '.html', CAST(sum(length(new_path) + 13) - 1 AS BIGINT), string_agg('<img src="' || new_path || '">', chr(10) ORDER BY old_path) FROM d GROUP BY g""")
def job_sanitize(t):
    """An archive whose names were normalised in place, after a dry run: all files, and the pages that refer to them."""
    spark = spark_of(t("customer"))
    root = work_folder(spark)
    rows = made.colliding_files(t)
    sinks.write_text_files(rows, root, "name", "text")
    page = F.concat(F.lit('<img src="'), F.col("name"), F.lit('">'))
    sinks.write_pages(rows.select(F.concat(F.lit("pages/"), F.col("g").cast("string"), F.lit(".html")).alias("name"), F.lit(1).alias("kind"), page.alias("text"), F.col("name").alias("at")), root, ["at"])
    told = [workflows.sanitize_archive(spark, root, dry_run=dry) for dry in (True, False)]
    assert all(told[0][k] == told[1][k] for k in told[0])  # a dry run tells what a run does
    texts = html_pages.read_pages(spark, f"{root}/pages").select(F.concat(F.lit("pages/"), "file").alias("rel_path"), "text")
    tree = files.inventory(spark, root).filter(~F.col("rel_path").startswith(".")).select("rel_path", "length")
    return tree.join(texts, "rel_path", "left")
