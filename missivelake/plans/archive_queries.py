"""Registered queries that run the archive operators on archives made from the synthetic tables.

A store's tables, contact books, exported pages and voice files are built with DataFrame functions; each query hands them to the
operator that a job would use.  The DuckDB counterparts start from the same tables, not from the built ones.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators import audit, contacts, dedup, export, participants, sanitize, threads
from missivelake.operators.ranks import ranked
from missivelake.plans.catalogue import query
from missivelake.sources import files, html_pages, sinks, sqlite_source
from missivelake.sources.stores import bucketed, scratch, sent, staged
from missivelake.streaming import incremental


def text(c: str) -> Column:
    return F.col(c).cast("string")


def work_folder(spark: SparkSession) -> str:
    """A new folder's address that all executors see."""
    return scratch(spark, "archive")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """(file, text): the pages below a folder."""
    return html_pages.read_pages(spark, folder).select("file", "text")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, block, at): the lines of a file in the order of the two numbers; several tasks may read it."""
    lines = spark.read.text(path)
    return lines.select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


# A message store: orders as attachments, customers as messages, nations as chats, suppliers as handles.


def store(t) -> dict[str, DataFrame]:
    orders, customer, nation, supplier = t("orders"), t("customer"), t("nation"), t("supplier")
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    path = (
        F.when(k % 5 == 0, F.concat(F.lit("x/StickerCache/s"), text("o_orderkey"), F.lit(".png")))
        .when(k % 5 == 1, F.concat(F.lit("elsewhere/"), text("o_orderkey")))
        .when(k % 5 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("~/L/Attachments/"), (k % 100).cast("string"), F.lit("/"), text("o_orderkey"), F.lit(".jpg")))
    )
    return {
        "attachment": orders.select(k.alias("ROWID"), path.alias("filename"), F.when(k % 3 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("transfer_name")),
        "message_attachment_join": orders.select(F.col("o_custkey").alias("message_id"), k.alias("attachment_id")),
        "message": customer.select(c.alias("ROWID"), F.concat(F.lit("G"), text("c_custkey")).alias("guid"), F.when(c % 11 == 0, F.lit(0)).otherwise(c * 86400).cast("long").alias("date"), F.col("c_name").alias("text"), (c % 2).alias("is_from_me"), (c % 10 + 1).alias("handle_id")),
        "chat": nation.select(F.col("n_nationkey").alias("ROWID"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("")).otherwise(F.col("n_name")).alias("display_name"), F.concat(F.lit("chat"), text("n_nationkey")).alias("chat_identifier")),
        "chat_message_join": customer.select(F.col("c_nationkey").alias("chat_id"), c.alias("message_id")),
        "chat_handle_join": supplier.select(F.col("s_nationkey").alias("chat_id"), F.col("s_suppkey").alias("handle_id")),
        "handle": supplier.select(F.col("s_suppkey").alias("ROWID"), F.col("s_name").alias("id")),
    }


def classified(t) -> tuple[DataFrame, DataFrame]:
    """The classified references with the codes of their chats' names, and (code, chat)."""
    k = F.col("o_orderkey")
    path = F.when(k % 5 == 0, F.concat(F.lit("/s/s"), text("o_orderkey"), F.lit(".png"))).otherwise(F.concat(F.lit("/a/"), (k % 100).cast("string"), F.lit("/"), text("o_orderkey"), F.lit(".jpg")))
    inventory = t("orders").filter("o_orderkey % 4 <> 0 and o_orderkey % 5 not in (1, 2)").select(path.alias("path"), F.when(k % 7 == 0, F.lit(0)).otherwise(k).cast("long").alias("length"))
    pattern = F.concat((k % 100).cast("string"), F.lit("/"), text("o_orderkey"), F.when(k % 24 == 0, F.lit("?jpg")).otherwise(F.lit(".jpg")))
    patterns = t("orders").filter("o_orderkey % 8 = 0").select(pattern.alias("pattern"))
    tables = store(t)
    codes, names = audit.chat_codes(tables)
    return audit.classify(audit.coded_references(tables, codes), inventory, patterns, "/a", "/s"), names


NAMES = """m AS (SELECT s_nationkey AS c, string_agg(s_name, ', ' ORDER BY s_name) AS members FROM supplier GROUP BY 1),
chats AS (SELECT n_nationkey AS c, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE n_name END, members, 'chat' || n_nationkey) AS chat FROM nation LEFT JOIN m ON c = n_nationkey)"""
REFS = f"""{NAMES},
a AS (SELECT o_orderkey AS k, o_custkey, CASE o_orderkey % 5 WHEN 0 THEN 's' || o_orderkey || '.png' ELSE (o_orderkey % 100) || '/' || o_orderkey || '.jpg' END AS tail,
 CASE o_orderkey % 5 WHEN 0 THEN 'x/StickerCache/' ELSE '~/L/Attachments/' END AS head, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS named FROM orders WHERE o_orderkey % 5 NOT IN (1, 2)),
r AS (SELECT chat, coalesce(named, tail) AS file, CASE WHEN c_custkey % 11 <> 0 THEN strftime(TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey AS INTEGER)), '%Y-%m-%dT%H:%M:%S+00:00') END AS sent,
 tail, head || tail AS stored_path, CASE k % 5 WHEN 0 THEN '/s/' ELSE '/a/' END || tail AS path,
 CASE WHEN k % 4 = 0 THEN CASE WHEN k % 8 = 0 AND k % 5 <> 0 THEN 'ok' ELSE 'missing' END WHEN k % 7 = 0 THEN 'zero_byte' ELSE 'ok' END AS status
 FROM a JOIN customer ON o_custkey = c_custkey JOIN chats ON c_nationkey = c)"""


@query(f"WITH {REFS} SELECT * FROM r")
def audit_references(t):
    """References joined over five tables, resolved, looked up and classified."""
    return audit.named(*classified(t))


@query(f"WITH {REFS} SELECT chat AS chat_name, count(*) AS n_refs, min(stored_path) AS least FROM r GROUP BY chat")
def audit_join(t):
    """Four inner joins with their fan-out, counted per chat."""
    return audit.references_by_chat(store(t))


@query(f"""WITH {REFS}, s AS (SELECT chat, file, path, CAST(regexp_extract(path, '([0-9]+)[.]', 1) AS BIGINT) AS k FROM r),
x AS (SELECT chat, file, path, CASE WHEN k % 4 = 0 THEN 'missing' WHEN k % 7 = 0 THEN 'zero_byte' ELSE 'ok' END AS was, CASE WHEN k % 9 = 0 THEN 'missing' WHEN k % 7 = 0 AND k % 2 = 1 THEN 'zero_byte' ELSE 'ok' END AS now FROM s)
SELECT chat, file, path, was, now FROM x WHERE was <> now""")
def audit_changed(t):
    """References whose status has changed between two kept inventories, all in buckets of the path."""
    k = F.col("o_orderkey")
    path = F.when(k % 5 == 0, F.concat(F.lit("/s/s"), text("o_orderkey"), F.lit(".png"))).otherwise(F.concat(F.lit("/a/"), (k % 100).cast("string"), F.lit("/"), text("o_orderkey"), F.lit(".jpg")))
    before = t("orders").filter(k % 4 != 0).select(path.alias("path"), F.when(k % 7 == 0, F.lit(0)).otherwise(k).cast("long").alias("length"))
    after = t("orders").filter(k % 9 != 0).select(path.alias("path"), F.when((k % 7 == 0) & (k % 2 == 1), F.lit(0)).otherwise(k).cast("long").alias("length"))
    done, names = classified(t)
    refs = bucketed(done.select("code", "file", "path"), "path", "refs", 8)
    return audit.named(audit.audit_changes(refs, bucketed(before, "path", "inventory", 8), bucketed(after, "path", "inventory", 8)), names)


@query(f"WITH {REFS} SELECT chat, file, sent, tail, stored_path, path, status FROM r WHERE status <> 'ok'")
def audit_problems(t):
    return audit.problems(*classified(t))


REPORT = """b AS (SELECT status, chat, coalesce(sent, 'undated') AS sent, file, row_number() OVER (PARTITION BY status, chat ORDER BY sent NULLS LAST, file) AS rn,
 count(*) OVER (PARTITION BY status, chat) AS n FROM r WHERE status <> 'ok')"""


@query(f"""WITH {REFS}, {REPORT} SELECT status, chat, rn, '  ' || sent || '  ' || file AS line FROM b WHERE rn <= 8
UNION ALL SELECT status, chat, 0, chat || ' (' || n || ')' FROM b WHERE rn = 1 UNION ALL SELECT status, chat, 9, '  … and ' || (n - 8) || ' more' FROM b WHERE rn = 1 AND n > 8""")
def audit_report(t):
    """The text report: eight problems a chat, and how many more."""
    done, names = classified(t)
    return audit.report_lines(done, names=names).withColumn("rn", F.col("rn").cast("long")).drop("code")


@query(f"""WITH {REFS} SELECT status AS list, row_number() OVER (PARTITION BY status ORDER BY sent NULLS LAST, chat, file, tail, stored_path) AS pos, chat, file, sent, tail, stored_path,
(SELECT count(*) FILTER (status = 'ok') || ',' || count(*) FILTER (status = 'zero_byte') || ',' || count(*) FILTER (status = 'missing') || ',' || count(*) FROM r) AS totals FROM r WHERE status <> 'ok'""")
def audit_json(t):
    """The audit's document, written in pieces and read back: its records in their order, and its totals."""
    done, names = classified(t)
    done = staged(done, "audit")
    spark, path = done.sparkSession, work_folder(done.sparkSession) + "/audit.json"
    sinks.write_document(audit.document_pieces(done, "now", "db", "/a", names), path, audit.RECORD_ORDER)
    lines = read_lines(spark, path)
    head = lines.filter("value like '{\"generated%'").select(F.regexp_replace("value", ",$", "}").alias("value")).first()["value"]
    middle = lines.filter("value = '\"missing\":['").select("block", "at").first()
    before = (F.col("block") < middle["block"]) | ((F.col("block") == middle["block"]) & (F.col("at") < middle["at"]))
    fields = "chat string, chat_ref long, file string, sent string, tail string, stored_path string"
    entry = F.from_json(F.concat(F.lit("{"), F.regexp_replace("value", ",$", ""), F.lit("}")), "map<string,string>")
    long = staged(lines.filter("value rlike '^\"[0-9]+\":'").select(F.explode(entry).alias("code", "long_name")).select(F.col("code").cast("long").alias("chat_ref"), "long_name"), "chats")
    records = lines.filter("value like '{\"chat%'").select(F.when(before, F.lit("zero_byte")).otherwise(F.lit("missing")).alias("list"), "block", "at", F.from_json(F.regexp_replace("value", ",$", ""), fields).alias("r"))
    totals = F.from_json(F.get_json_object(F.lit(head), "$.totals"), "ok string, zero_byte string, missing string, referenced string")
    placed = ranked(records, ["list"], ["block", "at"], "pos").select("list", "pos", "r.*", F.concat_ws(",", totals["ok"], totals["zero_byte"], totals["missing"], totals["referenced"]).alias("totals"))
    chat = F.coalesce("chat", "long_name").alias("chat")
    return placed.join(sent(long, "long_name"), "chat_ref", "left").select("list", "pos", chat, "file", "sent", "tail", "stored_path", "totals")


ORACLE_THREADS = f"""WITH {NAMES}, g AS (SELECT DISTINCT s_nationkey AS c, s_name FROM supplier),
o AS (SELECT c, s_name, row_number() OVER w AS i, count(*) OVER (PARTITION BY c) AS n, sum(strlen(s_name) + 2) OVER w - 2 AS bytes, sum(strlen(s_name) + 2) OVER (PARTITION BY c) - 2 AS whole FROM g WINDOW w AS (PARTITION BY c ORDER BY s_name)),
l AS (SELECT c, CASE WHEN max(whole) <= 200 THEN string_agg(s_name, ', ' ORDER BY s_name)
 ELSE string_agg(s_name, ', ' ORDER BY s_name) FILTER (bytes <= 160) || ', +' || (max(n) - count(*) FILTER (bytes <= 160)) || ' more' END AS listed FROM o GROUP BY c),
x AS (SELECT n_nationkey AS c, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE n_name END, listed, 'chat' || n_nationkey) AS name FROM nation LEFT JOIN l ON l.c = n_nationkey),
p AS (SELECT o_custkey, string_agg(CASE o_orderkey % 5 WHEN 0 THEN '/s/s' || o_orderkey || '.png' ELSE '/a/' || (o_orderkey % 100) || '/' || o_orderkey || '.jpg' END, ';' ORDER BY o_orderkey) AS attachments FROM orders WHERE o_orderkey % 5 NOT IN (1, 2) GROUP BY o_custkey)
SELECT name || '.html' AS file, 'G' || c_custkey AS guid, coalesce(s_name, 'Unknown') AS sender, c_custkey % 2 = 1 AS is_me, c_name AS text, coalesce(attachments, '') AS attachments
FROM customer JOIN x ON c_nationkey = x.c LEFT JOIN p ON o_custkey = c_custkey LEFT JOIN supplier ON s_suppkey = c_custkey % 10 + 1"""


@query(ORACLE_THREADS)
def thread_messages(t):
    """What a run exports of each message and chat."""
    return export.thread_messages(store(t), None, "/a", "/s").select("file", "guid", "sender", "is_me", "text", F.array_join("attachments", ";").alias("attachments"))


# Contact books: customers and suppliers.


def book(rows: DataFrame, key: str, name: str) -> dict[str, DataFrame]:
    k = F.col(key)
    owner = F.when(k % 13 != 0, k)
    return {
        "record": rows.select(k.alias("Z_PK"), F.when(k % 3 != 0, F.col(name)).alias("ZFIRSTNAME"), F.lit("").alias("ZLASTNAME"), F.when(k % 2 == 0, F.lit("Org")).alias("ZORGANIZATION")),
        "phone": rows.select(k.alias("ROWID"), owner.alias("ZOWNER"), F.concat(F.lit("+1 (555) 00"), F.lpad((k % 500).cast("string"), 5, "0")).alias("ZFULLNUMBER")),
        "email": rows.select(k.alias("ROWID"), owner.alias("ZOWNER"), F.concat(F.lit(" "), F.col(name), F.lit("@X.com ")).alias("ZADDRESS")),
    }


def handles(t) -> DataFrame:
    return contacts.handle_map([book(t("customer"), "c_custkey", "c_name"), book(t("supplier"), "s_suppkey", "s_name")])


HANDLES = """e AS (SELECT 0 AS b, c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_name FROM supplier),
n AS (SELECT b, k, name, b || ':' || k AS person_key, CASE WHEN k % 3 <> 0 THEN name WHEN k % 2 = 0 THEN 'Org' ELSE 'record' || k END AS display_name FROM e WHERE k % 13 <> 0),
u AS (SELECT '55500' || lpad(CAST(k % 500 AS VARCHAR), 5, '0') AS norm_handle, b * 10 AS o, * FROM n UNION ALL SELECT lower(name) || '@x.com', b * 10 + 1, * FROM n),
h AS (SELECT norm_handle, arg_max(person_key, o * 100000000 + k) AS person_key, arg_max(display_name, o * 100000000 + k) AS display_name FROM u GROUP BY 1)"""


@query(f"WITH {HANDLES} SELECT * FROM h")
def handle_map(t):
    """Every handle's person over two books: the last entry wins, phones before e-mails."""
    return handles(t)


GUIDS = "AAAAAAAA-0000-4000-8000-"


@query(f"""WITH {HANDLES}, f AS (SELECT c_custkey AS o, CASE WHEN c_custkey % 2 = 0 THEN '+155500' || lpad(CAST(c_custkey % 600 AS VARCHAR), 5, '0') || '/' ELSE 'Stray ' END || c_custkey AS d,
 CASE WHEN c_custkey % 2 = 0 THEN '55500' || lpad(CAST(c_custkey % 600 AS VARCHAR), 5, '0') END AS norm_handle, c_custkey % 4 + 1 AS n FROM customer),
p AS (SELECT CASE WHEN d LIKE '+%' THEN 'run' || o || '/+1' || f.norm_handle ELSE 'Stray ' || o END || '.html' AS file, n, o, coalesce(person_key, 'file:' || o) AS g, person_key, display_name FROM f LEFT JOIN h USING (norm_handle))
SELECT min(person_key) AS person_key, min(display_name) AS display_name, string_agg(file || '=' || n, ';' ORDER BY n DESC, o) AS files, CAST(sum(n) AS BIGINT) AS n_messages, arg_min(file, -n * 100000000 + o) AS output_name FROM p GROUP BY g""")
def grouped_files(t):
    """Pages by person: the page with most ids first, pages without a contact by themselves."""
    k = F.col("c_custkey")
    file = F.when(k % 2 == 0, F.concat(F.lit("run"), text("c_custkey"), F.lit("/+155500"), F.lpad((k % 600).cast("string"), 5, "0"))).otherwise(F.concat(F.lit("Stray "), text("c_custkey")))
    ids = F.transform(F.sequence(F.lit(1), k % 4 + 1), lambda i: F.concat(F.lit(GUIDS), F.lpad(i.cast("string"), 12, "0")))
    pages = t("customer").select(F.concat(file, F.lit(".html")).alias("file"), k.alias("file_ord"), F.array_join(F.concat(ids, ids), " ").alias("text"))
    plan = contacts.plan_groups(pages, handles(t))
    return plan.select("person_key", "display_name", F.array_join(F.transform("files", lambda f: F.concat(f["file"], F.lit("="), f["n"].cast("string"))), ";").alias("files"), "n_messages", "output_name")


# Group pages: users as groups, events as messages.


def guid(column: str) -> Column:
    return F.concat(F.lit(GUIDS), F.lpad(text(column), 12, "0"))


def group_pages(t) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The pages of users, and a store's tables that know a third of their messages."""
    place = F.array_sort(F.collect_list(F.struct("ts", "event_id")))
    body = F.array_join(F.transform(place, lambda x: F.concat(F.lit("<a href='sms://open?message-guid="), F.lit(GUIDS), F.lpad(x["event_id"].cast("string"), 12, "0"), F.lit("'>"))), "\n")
    name = F.when(F.col("user_id") % 5 == 0, F.lit("Family")).otherwise(F.lit("A, B "))
    pages = t("events").groupBy("user_id").agg(body.alias("text")).select(F.concat(name, text("user_id"), F.lit(".html")).alias("file"), "text")
    known = t("events").filter("event_id % 3 = 0")
    tables = {
        "message": known.select(F.col("event_id").alias("ROWID"), guid("event_id").alias("guid")),
        "chat_message_join": known.select((F.col("event_id") % 30).alias("chat_id"), F.col("event_id").alias("message_id")),
        "chat_handle_join": t("supplier").select(F.col("s_nationkey").alias("chat_id"), F.col("s_suppkey").alias("handle_id")),
        "handle": t("supplier").select(F.col("s_suppkey").alias("ROWID"), F.col("s_name").alias("id")),
    }
    return pages, tables


MEMBERS = """g AS (SELECT user_id, list(event_id ORDER BY ts, event_id) AS g FROM events WHERE user_id % 5 <> 0 GROUP BY user_id),
c AS (SELECT user_id, unnest(list_concat(list_reverse(g)[1:10], g[1:5])) AS id, unnest(range(1, len(list_concat(list_reverse(g)[1:10], g[1:5])) + 1)) AS pos FROM g),
f AS (SELECT user_id, arg_min(id, pos) % 30 AS chat FROM c WHERE id % 3 = 0 GROUP BY user_id),
m AS (SELECT user_id, list(s_name ORDER BY s_name) AS handles FROM f JOIN supplier ON s_nationkey = chat GROUP BY user_id)"""


@query(f"WITH {MEMBERS} SELECT 'A, B ' || user_id || '.html' AS file, array_to_string(handles, ',') AS handles FROM m")
def group_members(t):
    """The members of each group page, through its newest and oldest ids."""
    return participants.participants(*group_pages(t)).select("file", F.array_join("handles", ",").alias("handles"))


@query(f"""WITH {MEMBERS}, s AS (SELECT 'A, B ' || user_id || '.html' AS file, array_to_string(handles, ',') AS handles FROM m) SELECT file, handles, row_number() OVER (ORDER BY file) AS pos FROM s""")
def members_sidecar(t):
    """The members' file, written in pieces and read back in its order."""
    pages, tables = group_pages(t)
    chats, spark = staged(participants.page_chats(pages, tables), "chats"), spark_of(pages)
    path = work_folder(spark) + "/members.json"
    sinks.write_document(participants.shared_sidecar_pieces(chats, participants.member_lists(tables)), path, ["file"])
    entry = F.from_json(F.concat(F.lit("{"), F.regexp_replace("value", ",$", ""), F.lit("}")), "map<string,string>")
    lines = read_lines(spark, path).withColumn("own", F.col("value").startswith("  "))
    entries = lines.filter("own").select("block", "at", F.explode(entry).alias("file", "listed"), F.lit("all").alias("of")).withColumn("ref", F.get_json_object("listed", "$.members_ref").cast("long"))
    long = staged(lines.filter("not own and value rlike '^\"-?[0-9]+\":'").select(F.explode(entry).alias("k", "long_list")).select(F.col("k").cast("long").alias("ref"), "long_list"), "long")
    placed = ranked(entries, ["of"], ["block", "at"], "pos").join(sent(long, "long_list"), "ref", "left")
    return placed.select("file", F.array_join(F.from_json(F.coalesce("long_list", "listed"), "array<string>"), ",").alias("handles"), "pos")


# Exported pages and voice files: conversations.

TS = "timestampadd(MINUTE, cast(turn as int), timestampadd(DAY, cast(conv_id % 300 as int), timestamp_ntz'2020-01-01 08:00:00'))"
TS_SQL = "(TIMESTAMP '2020-01-01 08:00:00' + to_days(CAST(conv_id % 300 AS INTEGER)) + to_minutes(CAST(turn AS INTEGER)))"
SHOWN_SQL = f"strftime({TS_SQL}, '%b %d, %Y ') || (CASE WHEN hour({TS_SQL}) % 12 = 0 THEN 12 ELSE hour({TS_SQL}) % 12 END) || strftime({TS_SQL}, ':%M:%S %p')"
PAGE_GUID_SQL = "'BBBBBBBB-0000-4000-8000-' || lpad(CAST(conv_id AS VARCHAR), 6, '0') || lpad(CAST(turn AS VARCHAR), 6, '0')"
DIV_SQL = f"""'<div class="message"><p><span class="timestamp"><a href="sms://open?message-guid=' || {PAGE_GUID_SQL} || '">' || {SHOWN_SQL} || '</a></span></p><b>' || role || '</b></div>'"""


def exported(t) -> DataFrame:
    """(file, file_ord, text): each conversation as an exported page."""
    id_ = F.concat(F.lit("BBBBBBBB-0000-4000-8000-"), F.lpad(text("conv_id"), 6, "0"), F.lpad(text("turn"), 6, "0"))
    one = F.concat(F.lit('<div class="message"><p><span class="timestamp"><a href="sms://open?message-guid='), id_, F.lit('">'), T.display_time(F.expr(TS)), F.lit("</a></span></p><b>"), F.col("role"), F.lit("</b></div>"))
    rows = t("conversations").select("conv_id", F.struct("turn", one.alias("html")).alias("m"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["html"]), "\n")
    page = F.concat(F.lit("<!DOCTYPE html><html><head><title>t</title></head><body><h1>x</h1>\n"), body, F.lit("\n</body></html>"))
    return rows.groupBy("conv_id").agg(page.alias("text")).select(F.concat(text("conv_id"), F.lit(".html")).alias("file"), F.col("conv_id").alias("file_ord"), "text")


@query(f"""WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS msg_ord FROM conversations)
SELECT unnest(['shape', 'div']) AS mode, conv_id || '.html' AS file, conv_id AS file_ord, msg_ord, {PAGE_GUID_SQL} AS guid, {SHOWN_SQL} AS ts_text, strftime({TS_SQL}, '%Y-%m-%dT%H:%M:%S') AS ts_key, {DIV_SQL} AS html FROM c""")
def page_messages(t):
    """The messages of pages, found by shape and by element."""
    pages = exported(t)
    parts = [html_pages.parse_messages(pages, mode).withColumn("mode", F.lit(mode)) for mode in ("shape", "div")]
    return parts[0].unionByName(parts[1]).withColumn("msg_ord", F.col("msg_ord").cast("long"))


@query(f"""SELECT conv_id || '.html' AS file, count(*) AS n, count(*) AS n_ids, count(*) AS n_dated, substr(arg_min({DIV_SQL}, turn), 1, 120) AS sample FROM conversations GROUP BY conv_id""")
def page_inspect(t):
    return html_pages.inspect(html_pages.parse_messages(exported(t)))


@query(f"""SELECT conv_id % 7 AS thread, count(*) AS n_messages, '<!DOCTYPE html><html><head><title>t</title></head><body><h1>x</h1>' || chr(10) || repeat(chr(10), CAST(arg_min(n - 1, conv_id) AS INTEGER)) || chr(10)
 || string_agg({DIV_SQL}, chr(10) ORDER BY {TS_SQL}, conv_id, turn) || '</body></html>' AS html FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) GROUP BY 1""")
def merged_in_shell(t):
    """Several pages merged within the first one's shell, every message twice among the inputs."""
    pages = exported(t).withColumn("thread", F.col("file_ord") % 7)
    rows = html_pages.parse_messages(pages).withColumn("thread", F.col("file_ord") % 7)
    merged = dedup.first_wins(rows.union(rows.withColumn("file_ord", F.col("file_ord") + 1_000_000)), ["thread", "guid"], ["file_ord", "msg_ord"])
    first = pages.groupBy("thread").agg(F.min_by("file", "file_ord").alias("file"))
    shells = html_pages.shells(pages).join(first, "file").select("thread", "before", "after")
    folder = work_folder(pages.sparkSession)
    sinks.write_pages(sinks.page_pieces(merged, "thread", text("thread"), shells).withColumn("name", F.concat("name", F.lit(".html"))), folder)
    counts = merged.groupBy("thread").agg(F.count("*").alias("n_messages"))
    return read_back(pages.sparkSession, folder).select(T.stem(F.col("file")).cast("long").alias("thread"), F.col("text").alias("html")).join(counts, "thread")


def voice_files(t) -> DataFrame:
    """(file, file_ord, text): each conversation as a voice file; every fourth is a group, every fourth outgoing only."""
    kind, k = F.col("conv_id") % 4, F.expr("(conv_id div 4) % 50")
    number = lambda n: F.concat(F.lit("+1555"), F.lpad(n.cast("string"), 7, "0"))
    user = F.concat(F.lit("User"), k.cast("string"))
    is_me = (F.col("role") == "user") | (kind == 1)
    picture = F.when(F.col("turn") % 3 == 0, F.concat(F.lit('<img src="pic-'), text("conv_id"), F.lit("-"), text("turn"), F.lit('">'))).otherwise(F.lit(""))
    one = F.concat(
        F.lit('<div class="message"><abbr class="dt" title="'), F.date_format(F.expr(TS), "yyyy-MM-dd'T'HH:mm:ss"), F.lit('-05:00">x</abbr><cite class="sender vcard"><a class="tel" href="tel:'),
        F.when(is_me, F.lit("+15550009999")).otherwise(number(k)), F.lit('"><span class="fn">'), F.when(is_me, F.lit("Me")).otherwise(user),
        F.lit("</span></a></cite><q>m "), text("conv_id"), F.lit("-"), text("turn"), F.lit("</q>"), picture, F.lit("</div>"),
    )
    made = t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("html")))), lambda m: m["html"]), "").alias("body"))
    person = lambda n: F.concat(F.lit('<cite class="sender"><a class="tel" href="tel:'), number(n), F.lit('">p</a></cite>'))
    box = F.when(kind == 3, F.concat(F.lit('<div class="participants">'), person(k + 1), person(k), F.lit("</div>"))).otherwise(F.lit(""))
    title = F.when(kind == 3, F.lit("Group")).when(kind == 2, F.lit("Me to")).otherwise(F.concat(F.lit("Me to "), user))
    page = F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body>"), box, F.col("body"), F.lit("</body></html>"))
    named = F.when(kind == 3, F.lit("Group Conversation")).when(kind == 1, user).otherwise(number(k))
    return made.select(F.concat(named, F.lit(" - Text - "), text("conv_id"), F.lit("Z.html")).alias("file"), F.col("conv_id").alias("file_ord"), page.alias("text"))


def voice_messages_of(t) -> DataFrame:
    contact = t("nation").select(F.concat(F.lit("user"), text("n_nationkey")).alias("name"), F.concat(F.lit("555"), F.lpad(text("n_nationkey"), 7, "0")).alias("number"))
    return threads.messages_of(threads.identify(html_pages.parse_chunks(voice_files(t)), contact))


VOICE = f"""c AS (SELECT *, conv_id % 4 AS kind, (conv_id // 4) % 50 AS k, role = 'user' OR conv_id % 4 = 1 AS is_me FROM conversations),
num AS (SELECT *, '+1555' || lpad(CAST(k AS VARCHAR), 7, '0') AS number, '+1555' || lpad(CAST(k + 1 AS VARCHAR), 7, '0') AS next,
 CASE kind WHEN 3 THEN 'Group Conversation' WHEN 1 THEN 'User' || k ELSE '+1555' || lpad(CAST(k AS VARCHAR), 7, '0') END || ' - Text - ' || conv_id || 'Z.html' AS file,
 strftime({TS_SQL}, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS ts_iso, 'm ' || conv_id || '-' || turn AS body,
 CASE WHEN is_me THEN '+15550009999' ELSE '+1555' || lpad(CAST(k AS VARCHAR), 7, '0') END AS tel,
 CASE WHEN turn % 3 = 0 THEN 'pic-' || conv_id || '-' || turn END AS att FROM c),
sib AS (SELECT DISTINCT k AS sk FROM c WHERE kind = 0 AND NOT is_me),
v AS (SELECT *, CASE kind WHEN 3 THEN 'group' ELSE '1:1' END AS thread_kind,
 CASE WHEN kind = 3 THEN number || ', ' || next WHEN kind = 1 AND sk IS NULL AND k >= 25 THEN 'label:User' || k ELSE number END AS thread_key FROM num LEFT JOIN sib ON sk = k),
hashed AS (SELECT *, sha1(unhex('6f1f7c9a00004a1a9c1a676f6f676c65') || encode(ts_iso || '|' || tel || '|' || body)) AS hh FROM v),
w AS (SELECT *, upper(hh[1:8] || '-' || hh[9:12] || '-5' || hh[14:16] || '-' || substr('89AB89AB89AB89AB', strpos('0123456789abcdef', hh[17:17]), 1) || hh[18:20] || '-' || hh[21:32]) AS guid FROM hashed)"""


@query(f"""WITH {VOICE} SELECT file, conv_id AS file_ord, CASE kind WHEN 3 THEN 'Group' WHEN 2 THEN '' ELSE 'User' || k END AS label, CASE WHEN kind = 3 THEN next || ',' || number ELSE '' END AS participants,
max(CASE WHEN is_me THEN tel END) AS own_number, count(*) AS n, arg_min(CASE WHEN is_me THEN 'Me' ELSE 'User' || k END, turn) AS sender FROM v GROUP BY ALL""")
def voice_chunks(t):
    """What is read of each voice file."""
    rows = html_pages.parse_chunks(voice_files(t))
    return rows.select("file", "file_ord", "label", F.array_join("participants", ",").alias("participants"), "own_number", F.size("messages").cast("long").alias("n"), F.col("messages")[0]["display_name"].alias("sender"))


@query(f"""WITH {VOICE} SELECT max(tel) AS own_number FROM v WHERE conv_id = (SELECT max(conv_id) FROM v WHERE is_me) AND is_me""")
def voice_owner(t):
    """The owner's number, by the last file that has one."""
    return threads.own_number(html_pages.parse_chunks(voice_files(t)))


@query(f"WITH {VOICE} SELECT DISTINCT file, thread_kind AS kind, thread_key, CASE WHEN kind = 3 THEN number || ',' || next END AS members FROM v")
def voice_identity(t):
    """Each file's thread: its numbers, a sibling's, the contact's, the label."""
    contact = t("nation").select(F.concat(F.lit("user"), text("n_nationkey")).alias("name"), F.concat(F.lit("555"), F.lpad(text("n_nationkey"), 7, "0")).alias("number"))
    return threads.identify(html_pages.parse_chunks(voice_files(t)), contact).select("file", "kind", "thread_key", F.array_join("members", ",").alias("members"))


@query(f"WITH {VOICE} SELECT thread_kind AS kind, thread_key, guid, ts_iso, body AS text FROM w")
def voice_messages(t):
    return voice_messages_of(t).select("kind", "thread_key", "guid", F.col("m.ts_iso").alias("ts_iso"), F.col("m.text_html").alias("text"))


OUTPUT = "CASE WHEN thread_key LIKE 'label:%' THEN substr(thread_key, 7) ELSE thread_key END || '.html'"


@query(f"WITH {VOICE} SELECT thread_kind AS kind, thread_key, {OUTPUT} AS output_name, count(*) AS n_messages, count(att) AS n_attachments FROM v GROUP BY ALL")
def voice_plan(t):
    return threads.plan(voice_messages_of(t))


@query(f"WITH {VOICE} SELECT {OUTPUT} AS output_name, any_value(number || ',' || next) AS members FROM v WHERE kind = 3 GROUP BY thread_key")
def voice_groups(t):
    return threads.group_sidecar(voice_messages_of(t)).select("output_name", F.array_join("members", ",").alias("members"))


@query(f"WITH {VOICE} SELECT thread_kind AS kind, thread_key, coalesce(max(CASE WHEN NOT is_me THEN 'User' || k END), thread_key) AS display_name FROM v GROUP BY thread_kind, thread_key")
def voice_names(t):
    return threads.thread_names(voice_messages_of(t))


def media(t) -> DataFrame:
    rows = t("conversations").filter("turn % 3 = 0 and conv_id % 2 = 0")
    path = F.concat(F.lit("/pic-"), text("conv_id"), F.lit("-"), text("turn"))
    return rows.select(F.concat(F.lit("m"), path, F.lit(".jpg")).alias("path")).union(rows.select(F.concat(F.lit("n"), path, F.lit(".gif"))))


@query(f"WITH {VOICE} SELECT guid, CASE WHEN att IS NOT NULL AND conv_id % 2 = 0 THEN 'm/' || att || '.jpg' ELSE '' END AS resolved, CAST(att IS NOT NULL AND conv_id % 2 = 1 AS BIGINT) AS n_missing FROM w")
def voice_attachments(t):
    """Attachment names replaced by the least of their media files."""
    return threads.resolve_attachments(voice_messages_of(t), media(t)).select("guid", F.array_join("resolved", ";").alias("resolved"), "n_missing")


@query(f"WITH {VOICE} SELECT count(DISTINCT CASE WHEN conv_id % 2 = 0 THEN att END) AS resolved, count(CASE WHEN conv_id % 2 = 1 THEN att END) AS missing FROM v")
def voice_attachment_totals(t):
    return threads.attachment_totals(voice_messages_of(t), media(t))


@query(f"WITH {VOICE} SELECT DISTINCT att FROM v WHERE conv_id % 2 = 1 AND att IS NOT NULL ORDER BY att LIMIT 10")
def voice_unresolved(t):
    """The first ten names without a media file."""
    return threads.unresolved(voice_messages_of(t), media(t))


ORACLE_VOICE_PAGES = f"""WITH {VOICE}, names AS (SELECT thread_kind AS nk, thread_key AS nt, coalesce(max(CASE WHEN NOT is_me THEN 'User' || k END), thread_key) AS display_name FROM v GROUP BY thread_kind, thread_key),
x AS (SELECT *, '<div class="message"><div class="' || CASE WHEN is_me THEN 'sent SMS GoogleVoice' ELSE 'received GoogleVoice' END || '"><p><span class="timestamp"><a href="sms://open?message-guid=' || guid || '">' || {SHOWN_SQL}
 || '</a></span><span class="sender">' || CASE WHEN is_me THEN 'Me' WHEN kind = 3 THEN 'User' || k ELSE display_name END || '</span></p><hr><div class="message_part"><span class="bubble">' || body || '</span>'
 || coalesce('<div class="attachment"><img src="' || att || '" loading="lazy"></div>', '') || '</div></div></div>' AS html FROM w JOIN names ON nk = thread_kind AND nt = thread_key)
SELECT {OUTPUT} AS file, '<!DOCTYPE html><html><head><meta charset="utf-8"><title>' || display_name || '</title></head><body>' || chr(10) || string_agg(html, chr(10) ORDER BY {TS_SQL}, conv_id, turn) || chr(10) || '</body></html>' AS html FROM x GROUP BY thread_kind, thread_key, display_name"""


@query(ORACLE_VOICE_PAGES)
def voice_pages(t):
    """Every thread as one page, written from sorted pieces and read back."""
    messages = voice_messages_of(t)
    spark, folder = messages.sparkSession, work_folder(messages.sparkSession)
    sinks.write_pages(threads.page_pieces(messages, threads.thread_names(messages), threads.plan(messages)), folder, ["ts", "place"])
    return read_back(spark, folder).select("file", F.col("text").alias("html"))


# Paths and references.


@query("""WITH p AS (SELECT CASE page_id % 4 WHEN 0 THEN 'run' || page_id % 30 || '/Attachments/x/' WHEN 1 THEN 'StickerCache/' WHEN 2 THEN 'a/attachments/b/StickerCache/' ELSE 'none/' END AS d, page_id FROM pages)
SELECT DISTINCT unnest(CASE page_id % 4 WHEN 0 THEN ['run' || page_id % 30 || '/Attachments'] WHEN 1 THEN ['StickerCache'] WHEN 2 THEN ['a/attachments', 'a/attachments/b/StickerCache'] ELSE [] END) AS root FROM p""")
def attachment_roots(t):
    k = F.col("page_id") % 4
    folder = F.when(k == 0, F.concat(F.lit("run"), (F.col("page_id") % 30).cast("string"), F.lit("/Attachments/x/"))).when(k == 1, F.lit("StickerCache/")).when(k == 2, F.lit("a/attachments/b/StickerCache/")).otherwise(F.lit("none/"))
    return sanitize.attachment_roots(t("pages").select(F.concat(folder, text("page_id")).alias("rel_path")))


def referring(t) -> DataFrame:
    """(file, html): pages that refer to a badly named file, to one below a badly named folder, or to a good one."""
    k = F.col("page_id") % 3
    path = F.when(k == 0, F.concat(F.lit("Attachments/p:"), (F.col("page_id") % 50).cast("string"))).when(k == 1, F.concat(F.lit("Attachments/d:r/x?"), (F.col("page_id") % 20).cast("string"))).otherwise(F.lit("StickerCache/good"))
    return t("pages").select(F.col("page_id").alias("file"), F.concat(F.lit('<img src="'), path, F.lit('.jpg"> <a href="'), path, F.lit('.jpg">')).alias("html"))


@query("""SELECT DISTINCT old_path, CASE WHEN skipped THEN 'Attachments/d:r/x-' || page_id % 20 ELSE 'Attachments/p-' || page_id % 50 END || '.jpg' AS new_path, skipped, NOT skipped AND page_id % 50 < 25 AS "exists"
FROM (SELECT page_id, page_id % 3 = 1 AS skipped, CASE WHEN page_id % 3 = 1 THEN 'Attachments/d:r/x?' || page_id % 20 ELSE 'Attachments/p:' || page_id % 50 END || '.jpg' AS old_path FROM pages WHERE page_id % 3 < 2)""")
def scoped_plan(t):
    """What would be renamed for the pages in scope; names below a bad folder are left alone."""
    files_ = t("pages").filter("page_id % 50 < 25").select(F.concat(F.lit("Attachments/p:"), (F.col("page_id") % 50).cast("string"), F.lit(".jpg")).alias("path"))
    return sanitize.scoped_plan(referring(t), files_)


@query("""SELECT page_id, CAST(CASE WHEN page_id % 3 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n FROM pages""")
def scoped_refs(t):
    """How many references of each page a scoped plan changes."""
    pages = referring(t)
    plan = sanitize.scoped_plan(pages, pages.select(F.lit("none").alias("path"))).filter("not skipped")
    return sanitize.rewrite(pages, plan).select(F.col("file").alias("page_id"), F.col("n_updated").alias("n"))


@query("SELECT 'p:' || page_id AS old, 'p-' || page_id AS new FROM pages WHERE page_id % 6 = 0")
def healed(t):
    """Logged renames whose old and new file both exist."""
    name = lambda sign: F.concat(F.lit(f"p{sign}"), text("page_id"))
    log = t("pages").select(name(":").alias("old"), name("-").alias("new"))
    there = t("pages").filter("page_id % 2 = 0").select(name(":").alias("path")).union(t("pages").filter("page_id % 3 = 0").select(name("-")))
    return sanitize.heal_candidates(log, there).select("old", "new")


# Runs and files.


@query("SELECT event_id, NOT event_id % 2 = 0 AS is_day FROM events")
def day_shapes(t):
    day = F.date_format("ts", "yyyy-MM-dd")
    return t("events").select("event_id", T.is_day(F.when(F.col("event_id") % 2 == 0, F.concat(day, F.lit("T"))).otherwise(day)).alias("is_day"))


def spark_of(frame: DataFrame) -> SparkSession:
    return frame.sparkSession


@query("SELECT event_id, ts, event_type FROM events")
def committed_runs(t):
    """Two runs with a day of overlap, and one that never committed, read back as one archive."""
    rows = t("events").select("event_id", "ts", "event_type")
    root = work_folder(spark_of(rows))
    incremental.sync(rows.filter("ts < timestamp_ntz'2024-01-15 12:00:00'"), root, "2024-01-15_120000")
    incremental.run_folder(spark_of(rows), root, "2024-01-29_000000")
    incremental.sync(rows, root, "2024-02-01_000000")
    return incremental.archive(spark_of(rows), root, "event_id", ["ts"])


@query("""SELECT strftime(TIMESTAMP '2024-01-01' + to_days(CAST(r_regionkey AS INTEGER)), '%Y-%m-%d_000000') AS stamp, r_regionkey * 100 AS messages, CASE WHEN r_regionkey <> 2 THEN r_regionkey END AS attachments,
CASE WHEN r_regionkey > 0 THEN 100 END AS more_messages, CASE WHEN r_regionkey NOT IN (0, 2, 3) THEN 1 END AS more_attachments FROM region""")
def snapshot_growth(t):
    """How the counts of written manifests have grown."""
    from missivelake.plans import workflows

    root = work_folder(spark_of(t("region")))
    k = F.col("r_regionkey")
    counts = {"message_count": (k * 100).cast("string"), "attachment_rows": F.when(k == 2, F.lit("?")).otherwise(k.cast("string"))}
    lines = [F.concat(F.lit(f"{key}: "), counts.get(key, F.lit("?")), F.lit("\n")) for key in sinks.MANIFEST_KEYS]
    name = F.concat(F.lit("snapshots/2024-01-"), F.lpad((k + 1).cast("string"), 2, "0"), F.lit("_000000/manifest.txt"))
    sinks.write_text_files(t("region").select(name.alias("name"), F.concat(*lines).alias("text")), root, "name", "text")
    return workflows.growth(spark_of(t("region")), root)


def nation_files(t) -> str:
    """A tree with one file a nation; every fifth is empty."""
    rows = t("nation").select(F.concat(F.lit("f"), text("n_regionkey"), F.lit("/"), F.col("n_name"), F.lit(".html")).alias("name"), F.when(F.col("n_nationkey") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<p>"), F.col("n_name"))).alias("text"))
    root = work_folder(spark_of(rows))
    sinks.write_text_files(rows, root, "name", "text")
    return root


NATION_FILES = "SELECT 'f' || n_regionkey || '/' || n_name || '.html' AS rel_path, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE '<p>' || n_name END AS text, n_nationkey AS k FROM nation"


@query(f"SELECT rel_path, CAST(length(text) AS BIGINT) AS length FROM ({NATION_FILES})")
def file_inventory(t):
    """Every file of a tree, empty ones too."""
    return files.inventory(spark_of(t("nation")), nation_files(t)).select("rel_path", "length")


@query(f"SELECT regexp_replace(rel_path, '.*/', '') AS file, rel_path, text, row_number() OVER (ORDER BY regexp_replace(rel_path, '.*/', '')) AS place FROM ({NATION_FILES}) WHERE text <> ''")
def page_files(t):
    """Written pages read back in the order of their names."""
    root = nation_files(t)
    pages = html_pages.with_order(html_pages.read_pages(spark_of(t("nation")), root, recursive=True)).filter("text <> ''")
    placed = ranked(pages.withColumn("of", F.lit(root)), ["of"], ["file_ord"])
    return placed.select("file", F.substring("path", len(root) + 2, 1000).alias("rel_path"), "text", "place")


@query(f"SELECT rel_path, CASE WHEN k % 3 = 0 THEN 'changed' ELSE 'new' END AS change FROM ({NATION_FILES}) WHERE k % 3 <> 1 AND k <> 5")
def sync_plan(t):
    """What an additive copy of a tree would bring: files that are new or changed, without excluded ones."""
    from missivelake.plans import workflows

    spark, source = spark_of(t("nation")), nation_files(t)
    target = work_folder(spark)
    nations = t("nation").select("n_nationkey", F.concat(F.lit("f"), text("n_regionkey"), F.lit("/"), F.col("n_name"), F.lit(".html")).alias("rel_path"))
    paths = lambda folder: F.concat(F.lit(folder + "/"), "rel_path")
    sinks.copy_files(nations.filter("n_nationkey % 3 = 1").select(paths(source).alias("source"), paths(target).alias("target")))
    sinks.write_text_files(nations.filter("n_nationkey % 3 = 0").select("rel_path", F.lit("other text, longer").alias("text")), target, "rel_path", "text")
    patterns = nations.filter("n_nationkey = 5").select(F.regexp_replace("rel_path", "^f.", "f?").alias("pattern"))
    return workflows.plan_sync(spark, source, target, patterns).select(F.substring("target", len(target) + 2, 1000).alias("rel_path"), "change")


@query(f"SELECT rel_path, CAST(length(text) AS BIGINT) AS length FROM (SELECT CASE WHEN k % 2 = 0 THEN 'new/' || rel_path ELSE rel_path END AS rel_path, text FROM ({NATION_FILES}))")
def moved_files(t):
    """A tree after half of its files were renamed; a repeated move changes nothing."""
    root = nation_files(t)
    old = F.concat(F.lit("f"), text("n_regionkey"), F.lit("/"), F.col("n_name"), F.lit(".html"))
    moves = t("nation").filter("n_nationkey % 2 = 0").select(F.concat(F.lit(root + "/"), old).alias("source"), F.concat(F.lit(root + "/new/"), old).alias("target"), F.lit("move").alias("action"))
    for _ in range(2):
        sinks.move_files(moves)
    return files.inventory(spark_of(t("nation")), root).select("rel_path", "length")


COLLIDING = """p AS (SELECT c_custkey AS k, c_custkey // 4 AS g, c_custkey % 4 AS v FROM customer),
f AS (SELECT g, 'Attachments/' || (g % 10) || '/n' || CASE v WHEN 0 THEN ':' WHEN 1 THEN '?' WHEN 2 THEN '|' ELSE '-' END || g || '.jpg' AS old_path, 'Attachments/' || (g % 10) || '/n-' || g AS stem,
 v = 3 AS holds, CASE WHEN v = 3 OR (g + v) % 3 = 0 THEN 'same ' || g ELSE 'bytes ' || (k - k % 2) END AS bytes FROM p),
h AS (SELECT *, first_value(bytes) OVER (PARTITION BY g ORDER BY holds DESC, old_path) AS winner, bool_or(holds) OVER (PARTITION BY g) AS held, row_number() OVER (PARTITION BY g, bytes ORDER BY holds DESC, old_path) AS nth FROM f)"""


def colliding_files(t) -> DataFrame:
    """(g, name, text): up to four files of one new name, one of which may have it already."""
    k = F.col("c_custkey")
    g, v = F.floor(k / 4), k % 4
    sign = F.when(v == 0, F.lit(":")).when(v == 1, F.lit("?")).when(v == 2, F.lit("|")).otherwise(F.lit("-"))
    name = F.concat(F.lit("Attachments/"), (g % 10).cast("string"), F.lit("/n"), sign, g.cast("string"), F.lit(".jpg"))
    content = F.when((v == 3) | ((g + v) % 3 == 0), F.concat(F.lit("same "), g.cast("string"))).otherwise(F.concat(F.lit("bytes "), (k - k % 2).cast("string")))
    return t("customer").select(g.alias("g"), name.alias("name"), content.alias("text"))


@query(f"""WITH {COLLIDING} SELECT old_path, stem || CASE WHEN bytes = winner THEN '' ELSE '_' || sha256(bytes)[1:8] END || '.jpg' AS new_path, CASE WHEN nth = 1 THEN 'move' ELSE 'remove' END AS action, bytes <> winner AS collision FROM h WHERE NOT holds""")
def colliding_names(t):
    """Files whose new names clash: copies of the bytes that keep a name go, other bytes get a name of their own."""
    spark = spark_of(t("customer"))
    root = work_folder(spark)
    sinks.write_text_files(colliding_files(t), root, "name", "text")
    tree = files.inventory(spark, root).select("rel_path")
    pairs = sanitize.renames(sanitize.below_roots(tree).select(F.lit("r").alias("root"), "rel_path"))
    return sanitize.settle(pairs, tree, sinks.digests, root).select("old_path", "new_path", "action", "collision")


@query("SELECT DISTINCT n_name AS pattern, n_name AS old, 'x-' || n_name AS new FROM nation")
def state_files(t):
    """The exclude list and the rename log, written and read back."""
    spark = spark_of(t("nation"))
    root = work_folder(spark)
    names = t("nation").select(F.col("n_name").alias("pattern"))
    files.write_patterns(names.union(names), os.path.join(root, "excludes"))
    files.write_log(names.select(F.col("pattern").alias("old"), F.concat(F.lit("x-"), "pattern").alias("new")), os.path.join(root, "log"))
    return files.read_patterns(spark, os.path.join(root, "excludes")).join(files.read_log(spark, os.path.join(root, "log")), F.col("pattern") == F.col("old"))


@query("SELECT 'G' || c_custkey AS guid, c_custkey * 86400 AS date FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey * 86400 >= 8640000")
def sqlite_messages(t):
    """A store's shards, written and read by tasks, with a pushed filter."""
    spark = spark_of(t("customer"))
    path = sqlite_source.write_tables(work_folder(spark), {"message": store(t)["message"]})
    return sqlite_source.read_table(spark, path, "message").filter("date >= 8640000").select("guid", "date")


@query(f"WITH {NAMES} SELECT chat AS chat_name, c AS chat_id FROM chats")
def sqlite_chats(t):
    """A store's tables joined for the names of its chats."""
    spark = spark_of(t("customer"))
    tables = sqlite_source.read_messages(spark, sqlite_source.write_tables(work_folder(spark), store(t)))
    return audit.chat_names(tables["chat"], tables["chat_handle_join"], tables["handle"])


def book_folder(t) -> str:
    """A main book and an account's book in their places."""
    folder = work_folder(spark_of(t("customer")))
    names = {"record": "ZABCDRECORD", "phone": "ZABCDPHONENUMBER", "email": "ZABCDEMAILADDRESS"}
    for place, rows in ((".", book(t("customer"), "c_custkey", "c_name")), ("Sources/1", book(t("supplier"), "s_suppkey", "s_name"))):
        sqlite_source.write_tables(f"{folder}/{place}/AddressBook-v22.abcddb", {names[k]: v for k, v in rows.items()})
    return folder


@query(f"WITH {HANDLES} SELECT * FROM h")
def sqlite_books(t):
    """The handle map of a main book and an account's book, found in their folder."""
    spark, folder = spark_of(t("customer")), book_folder(t)
    return contacts.handle_map([b for p in sqlite_source.book_paths(folder) if (b := sqlite_source.read_book(spark, p)) is not None])


@query("SELECT 'G' || c_custkey % 300 AS guid, min(c_custkey) AS ROWID, min(c_custkey) * 86400 AS date FROM customer GROUP BY c_custkey % 300")
def followed_store(t):
    """A store's table followed as a stream, one copy of each id, the first by rowid."""
    spark = spark_of(t("customer"))
    k = F.col("c_custkey")
    rows = t("customer").select(k.alias("ROWID"), F.concat(F.lit("G"), (k % 300).cast("string")).alias("guid"), (k * 86400).cast("long").alias("date"))
    folder = work_folder(spark)
    stream = sqlite_source.follow_table(spark, sqlite_source.write_tables(f"{folder}/store", {"message": rows}), "message").withColumn("ts", T.apple_time(F.col("date")))
    incremental.follow(stream, "guid", "ROWID", "ts", f"{folder}/rows", f"{folder}/state").awaitTermination()
    return incremental.followed(spark, f"{folder}/rows", "guid", "ROWID").select("guid", "ROWID", "date")
