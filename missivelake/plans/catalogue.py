"""Registered archive queries on the synthetic tables and their DuckDB counterparts.

The synthetic tables hold no chats, so each operator runs on an analogue: documents as messages, events as
timed messages, orders and customers as chats and handles, pages as exported conversations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators import audit, contacts, dedup, participants, ranks, sanitize, threads
from missivelake.sources import html_pages, sinks
from missivelake.sources.stores import scratch
from missivelake.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None):
    """Registers a function of (table reader) under its name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


@query("SELECT min(doc_id) AS doc_id, text, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY text")
def dedup_first(t):
    """The first copy of each text."""
    return dedup.first_wins(t("documents").select("doc_id", "text", "lang", "source", "n_chars"), ["text"], ["doc_id"])


@query("SELECT text, max(doc_id) AS doc_id, min(doc_id) AS place, arg_max(source, doc_id) AS source FROM documents GROUP BY text")
def dedup_last(t):
    """The last copy of each text, at the place of the first."""
    rows = t("documents").select("text", "doc_id", "source")
    rows = rows.withColumn("ord", F.col("doc_id"))
    return dedup.last_wins(rows, ["text"], ["ord"]).select("text", "doc_id", F.col("first_ord").alias("place"), "source")


@query("""WITH f AS (SELECT text, arg_min(source, doc_id) AS source FROM documents GROUP BY text),
n AS (SELECT source, count(*) AS n_new FROM f GROUP BY source)
SELECT d.source, count(*) AS n_in, coalesce(max(n.n_new), 0) AS n_new FROM documents d LEFT JOIN n ON n.source = d.source GROUP BY d.source""")
def new_after_dedup(t):
    """Messages per file, and those that no earlier file has."""
    return dedup.contribution(t("documents").select("text", "doc_id", "source"), ["text"], ["doc_id"], "source")


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= (SELECT CAST(max(ts) AS DATE) - INTERVAL 1 DAY FROM events)")
def watermark_window(t):
    """Rows from the day before the newest run on."""
    rows = t("events").select("event_id", "ts", "event_type")
    newest = rows.agg(F.date_format(F.max("ts"), "yyyy-MM-dd_HHmmss")).first()[0]
    return incremental.window(rows, "ts", incremental.start_day([(newest, True)] if newest else []))


def _classified(t):
    joined = t("documents").join(t("labels").select(F.col("doc_id").alias("__id"), F.col("quality").cast("long").alias("length")), F.col("doc_id") == F.col("__id"), "left")
    return joined.select("source", "doc_id", audit.status_of(F.col("length"), F.lit(False)).alias("status"))


@query("""WITH c AS (SELECT d.source, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.quality = 0 THEN 'zero_byte' ELSE 'ok' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT source, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'zero_byte') AS zero_byte, count(*) FILTER (status = 'missing') AS missing, count(*) AS referenced FROM c GROUP BY source""")
def audit_status(t):
    """References classified against an inventory and counted."""
    return _classified(t).groupBy("source").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "zero_byte", "missing")], F.count("*").alias("referenced"))


@query("""WITH c AS (SELECT d.source, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.quality = 0 THEN 'zero_byte' ELSE 'ok' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'zero_byte') AS zero_byte, count(*) FILTER (status = 'missing') AS missing, count(*) AS referenced FROM c""")
def audit_totals(t):
    return audit.totals(_classified(t))


@query("""WITH m AS (SELECT d.source, d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n_total FROM m)
SELECT source, doc_id, rn, n_total, greatest(n_total - 8, 0) AS n_more FROM r WHERE rn <= 8""")
def audit_top8(t):
    """The first eight problems per group, and how many more there are."""
    missing = t("documents").select("source", "doc_id").join(t("labels").select("doc_id"), "doc_id", "left_anti")
    return audit.top_per_group(missing, ["source"], [F.col("doc_id")]).select("source", "doc_id", "rn", "n_total", "n_more")


@query("""SELECT r.r_regionkey, coalesce(nullif(CASE WHEN r.r_regionkey % 2 = 0 THEN '' ELSE r.r_name END, ''),
(SELECT string_agg(n_name, ', ' ORDER BY n_name) FROM nation n WHERE n.n_regionkey = r.r_regionkey), 'unknown') AS chat_name FROM region r""")
def chat_name(t):
    """Display name, else the members, else the identifier."""
    chat = t("region").select(F.col("r_regionkey").alias("ROWID"), F.when(F.col("r_regionkey") % 2 == 0, F.lit("")).otherwise(F.col("r_name")).alias("display_name"), F.lit("unknown").alias("chat_identifier"))
    links = t("nation").select(F.col("n_regionkey").alias("chat_id"), F.col("n_nationkey").alias("handle_id"))
    handle = t("nation").select(F.col("n_nationkey").alias("ROWID"), F.col("n_name").alias("id"))
    return audit.chat_names(chat, links, handle).select(F.col("chat_id").alias("r_regionkey"), "chat_name")


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS members, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def participant_sets(t):
    """The sorted set of participants of each thread."""
    found = participants.member_sets(t("events"), "user_id", "event_type")
    return found.select("user_id", F.array_join("members", ",").alias("members"), F.size("members").cast("long").alias("n"))


@query("""SELECT c_custkey AS pk, c_name AS name FROM customer
UNION ALL SELECT s_suppkey + (SELECT coalesce(max(c_custkey), 0) + 1000000 FROM customer), s_name FROM supplier""")
def contacts_union(t):
    """Two books united, the second one's keys shifted."""
    books = [{"record": t("customer").select(F.col("c_custkey").alias("Z_PK"), F.col("c_name").alias("name"))}, {"record": t("supplier").select(F.col("s_suppkey").alias("Z_PK"), F.col("s_name").alias("name"))}]
    return contacts.union_books(books)["record"].select(F.col("Z_PK").alias("pk"), "name")


@query(r"""WITH n AS (SELECT doc_id, unnest(regexp_extract_all(text, '\+?[0-9]?[ -]?\([0-9]{3}\) [0-9]{3}-[0-9]{4}')) AS raw FROM documents),
d AS (SELECT doc_id, raw, regexp_replace(raw, '[^0-9]', '', 'g') AS x FROM n)
SELECT doc_id, raw, CASE WHEN length(x) >= 10 THEN right(x, 10) ELSE x END AS handle, length(x) >= 4 AS is_number FROM d""")
def norm_phone(t):
    """Phone numbers in texts, normalised."""
    raw = t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(\+?[0-9]?[ -]?\([0-9]{3}\) [0-9]{3}-[0-9]{4})"), F.lit(1))).alias("raw"))
    return raw.select("doc_id", "raw", T.norm_handle(F.col("raw")).alias("handle"), T.looks_like_number(F.col("raw")).alias("is_number"))


@query("SELECT event_id, lower(trim(' ' || upper(event_type) || '@Example.com ')) AS handle FROM events")
def norm_email(t):
    return t("events").select("event_id", T.norm_handle(F.concat(F.lit(" "), F.upper("event_type"), F.lit("@Example.com "))).alias("handle"))


@query("""WITH u AS (SELECT c.c_nationkey AS k, e.user_id, count(*) AS n FROM events e JOIN customer c ON e.user_id = c.c_custkey GROUP BY ALL)
SELECT k AS nationkey, arg_max(user_id, n * 1000000 - user_id) AS name, CAST(sum(n) AS BIGINT) AS total FROM u GROUP BY k""")
def argmax_name(t):
    """Per person the file with most messages, ties to the first, and the sum."""
    counted = t("events").join(t("customer").select(F.col("c_custkey"), F.col("c_nationkey").alias("nationkey")), F.col("user_id") == F.col("c_custkey")).groupBy("nationkey", "user_id").agg(F.count("*").alias("n"))
    return contacts.leading(counted.withColumn("place", F.col("user_id")), "nationkey", "user_id", "place").select(F.col("group_key").alias("nationkey"), F.col("output_name").alias("name"), F.col("n_messages").alias("total"))


@query(r"SELECT page_id, translate(url, ':|\<>?*[]', '---------') AS clean, regexp_matches(url, '[:|\\<>?*\[\]]') AS is_bad FROM pages")
def sanitize_names(t):
    return t("pages").select("page_id", T.sanitize_component(F.col("url")).alias("clean"), T.is_bad_component(F.col("url")).alias("is_bad"))


@query("""WITH p AS (SELECT DISTINCT translate(url, ':|\\<>?*[]', '?????????') AS pattern FROM pages)
SELECT DISTINCT g.page_id, g.url FROM pages g, p WHERE length(g.url) = length(p.pattern)
AND len(list_filter(range(1, length(g.url) + 1), lambda i: substr(p.pattern, i, 1) <> '?' AND substr(p.pattern, i, 1) <> substr(g.url, i, 1))) = 0""")
def exclude_pattern(t):
    """Names that a wildcard pattern excludes."""
    patterns = t("pages").select(T.exclude_pattern(F.col("url")).alias("pattern"))
    return audit.excluded(t("pages").select("page_id", "url"), patterns, "url")


@query("""SELECT page_id, CAST(len(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS INTEGER) AS n, CAST(len(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS INTEGER) AS n_distinct FROM pages""")
def refs(t):
    """References of each page, with repeats and without."""
    found = T.references(F.replace("html", F.lit('href="'), F.lit('href="Attachments/')))
    return t("pages").select("page_id", F.size(found).alias("n"), F.size(F.array_distinct(found)).alias("n_distinct"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '^Me to *', '')) AS label FROM pages")
def title(t):
    return t("pages").select("page_id", T.title_label(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("label"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') END AS iso FROM events""")
def apple_time(t):
    """Timestamps counted from 2001 in nanoseconds or, for every third row, in seconds; zero is no time."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - T.APPLE_EPOCH_SECONDS
    raw = F.when(F.col("event_id") % 7 == 0, F.lit(0)).when(F.col("event_id") % 3 == 0, seconds).otherwise(seconds * 1_000_000_000 + 123_456_789)
    return t("events").select("event_id", T.apple_iso(raw.cast("long")).alias("iso"))


@query("""SELECT event_id, strftime(ts, '%b %d, %Y ') || CAST(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS VARCHAR) || strftime(ts, ':%M:%S %p') AS shown,
strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_key FROM events""")
def human_ts(t):
    """The displayed time, and its sortable key read back from it (with a double space)."""
    shown = T.display_time(F.col("ts"))
    return t("events").select("event_id", shown.alias("shown"), T.time_key(F.regexp_replace(shown, r"(\d{4}) ", "$1  ")).alias("ts_key"))


@query("""WITH h AS (SELECT event_id, sha1(unhex('6f1f7c9a00004a1a9c1a676f6f676c65') || encode(CAST(ts AS VARCHAR)[1:10] || '|' || CAST(event_id AS VARCHAR) || '|' || event_type)) AS h FROM events)
SELECT event_id, upper(h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89AB89AB89AB89AB', strpos('0123456789abcdef', h[17:17]), 1) || h[18:20] || '-' || h[21:32]) AS guid FROM h""")
def uuid5(t):
    """Ids of messages that have none."""
    return t("events").select("event_id", T.message_uuid(F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"), F.col("event_type")).alias("guid"))


@query("""WITH g AS (SELECT user_id, list(event_id ORDER BY ts, event_id) AS g FROM events GROUP BY user_id)
SELECT user_id, array_to_string(list_concat(list_reverse(g)[1:10], g[1:5]), ',') AS ids FROM g""")
def tail10_head5(t):
    """The ten newest ids in reverse, then the five oldest."""
    few = ranks.newest_and_oldest(t("events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "event_id"))), lambda x: x["event_id"].cast("string"))  # at most fifteen
    return few.groupBy("user_id").agg(F.array_join(listed, ",").alias("ids"))


@query("""WITH e AS (SELECT conv_id, turn, '<p>' || replace(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') || ': ' || coalesce(text, '') || '</p>' AS html FROM conversations)
SELECT conv_id, count(*) AS n_messages, '<!DOCTYPE html><html><head><meta charset="utf-8"><title>' || CAST(conv_id AS VARCHAR) || '</title></head><body>' || chr(10) || string_agg(html, chr(10) ORDER BY turn, html) || chr(10) || '</body></html>' AS html FROM e GROUP BY conv_id""")
def thread_render(t):
    """Each conversation as one page in order."""
    html = F.concat(F.lit("<p>"), T.html_escape(F.col("role")), F.lit(": "), F.coalesce("text", F.lit("")), F.lit("</p>"))
    rows = t("conversations").select("conv_id", F.lpad(F.col("turn").cast("string"), 12, "0").alias("ts_key"), F.lit(0).alias("file_ord"), F.lit(0).alias("msg_ord"), html.alias("html"))
    spark = rows.sparkSession
    folder = scratch(spark, "pages")
    sinks.write_pages(sinks.page_pieces(rows, "conv_id", F.col("conv_id").cast("string")).withColumn("name", F.concat("name", F.lit(".html"))), folder)
    pages = html_pages.read_pages(spark, folder).select(T.stem(F.col("file")).cast("long").alias("conv_id"), F.col("text").alias("html"))
    return pages.join(rows.groupBy("conv_id").agg(F.count("*").alias("n_messages")), "conv_id")


@query("""WITH n AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'Ann - Missed - ' WHEN page_id % 5 = 1 THEN 'Ann - voicemail - ' WHEN page_id % 5 = 2 THEN 'Ann - Text - ' WHEN page_id % 5 = 3 THEN 'Group Conversation - ' ELSE 'notes ' END || CAST(page_id AS VARCHAR) || '.html' AS file FROM pages),
k AS (SELECT file, CASE WHEN file LIKE '%Missed%' THEN 'Missed' WHEN file LIKE '%voicemail%' THEN 'Voicemail' WHEN file LIKE '%Text%' THEN 'Text' WHEN file LIKE 'Group%' THEN 'Group' ELSE 'Unrecognized' END AS kind FROM n)
SELECT kind, count(*) AS n, array_to_string(list(file ORDER BY file)[1:5], ';') AS samples FROM k WHERE kind NOT IN ('Text', 'Group') GROUP BY kind""")
def kind(t):
    """Files by kind with samples, text conversations apart."""
    k = F.col("page_id") % 5
    name = F.when(k == 0, F.lit("Ann - Missed - ")).when(k == 1, F.lit("Ann - voicemail - ")).when(k == 2, F.lit("Ann - Text - ")).when(k == 3, F.lit("Group Conversation - ")).otherwise(F.lit("notes "))
    return threads.skipped(t("pages").select(F.concat(name, F.col("page_id").cast("string"), F.lit(".html")).alias("file"))).select("kind", "n", F.array_join("samples", ";").alias("samples"))


@query("""WITH g AS (SELECT c_nationkey, list(DISTINCT c_name ORDER BY c_name) AS m FROM customer GROUP BY c_nationkey),
k AS (SELECT c_nationkey, m, array_to_string(m, ', ') AS whole, len(list_filter(range(1, len(m) + 1), lambda i: strlen(array_to_string(m[1:i], ', ')) <= 160)) AS k FROM g)
SELECT c_nationkey, CASE WHEN strlen(whole) > 200 THEN array_to_string(m[1:k], ', ') || ', +' || CAST(len(m) - k AS VARCHAR) || ' more' ELSE whole END AS name FROM k""")
def group_filename(t):
    """Group names within a byte budget."""
    return t("customer").groupBy("c_nationkey").agg(F.collect_set("c_name").alias("m")).select("c_nationkey", T.group_name(F.col("m")).alias("name"))


@query("SELECT page_id, regexp_matches(regexp_replace(regexp_replace(file, '.*/', ''), '[.][^.]+$', ''), '[, ]') AS is_group FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'a/+1555, +1666.html' WHEN page_id % 3 = 1 THEN 'b/Family.html' ELSE 'c/Real Group.html' END AS file FROM pages)")
def is_group(t):
    k = F.col("page_id") % 3
    file = F.when(k == 0, F.lit("a/+1555, +1666.html")).when(k == 1, F.lit("b/Family.html")).otherwise(F.lit("c/Real Group.html"))
    return t("pages").select("page_id", T.is_group_filename(file).alias("is_group"))


@query("SELECT doc_id, source FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def standalone(t):
    """Files whose handle no contact has."""
    files = t("documents").select("doc_id", "source", F.concat((F.col("doc_id") + 1_000_000).cast("string"), F.lit(".html")).alias("file"))
    handles = t("labels").select((F.col("doc_id") + 1_000_000).cast("string").alias("norm_handle"))
    return contacts.standalone(files, handles).select("doc_id", "source")


@query("""WITH p AS (SELECT page_id, 'Attachments/' || split_part(url, '/', 3) || '/' || CASE WHEN page_id % 2 = 0 THEN 'a:b' ELSE 'ab' END || '.jpg' AS path FROM pages),
q AS (SELECT page_id, path, replace(path, ':', '-') AS new FROM p)
SELECT page_id, '<img src="' || new || '"> text ' || path AS html, CAST(CASE WHEN new <> path THEN 1 ELSE 0 END AS BIGINT) AS n_updated FROM q""")
def rewrite_refs(t):
    """References to renamed files rewritten; the same path as plain text stays."""
    path = F.concat(F.lit("Attachments/"), F.split("url", "/")[2], F.lit("/"), F.when(F.col("page_id") % 2 == 0, F.lit("a:b")).otherwise(F.lit("ab")), F.lit(".jpg"))
    pages = t("pages").select(F.col("page_id").alias("file"), path.alias("path"))
    pages = pages.select("file", F.concat(F.lit('<img src="'), F.col("path"), F.lit('"> text '), F.col("path")).alias("html"))
    plan = sanitize.scoped_plan(pages, pages.select(F.lit("none").alias("path")))
    return sanitize.rewrite(pages, plan.filter("not skipped")).select(F.col("file").alias("page_id"), "html", F.col("n_updated").cast("long").alias("n_updated"))


@query("SELECT page_id, array_to_string(list_transform(string_split(url, '/'), lambda x: translate(x, ':|\\<>?*[]', '---------')), '/') AS clean FROM pages")
def rel_path(t):
    return t("pages").select("page_id", T.sanitize_path(F.col("url")).alias("clean"))


@query("""WITH e AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '~/L/Attachments/' ELSE '' END || CASE WHEN page_id % 4 = 0 THEN 'x/StickerCache/' ELSE '' END || url AS stored FROM pages)
SELECT page_id, CASE WHEN strpos(stored, 'StickerCache/') > 0 THEN '/s/' || substr(stored, strpos(stored, 'StickerCache/') + 13)
 WHEN strpos(stored, 'Attachments/') > 0 THEN '/a/' || substr(stored, strpos(stored, 'Attachments/') + 12) END AS path FROM e""")
def resolve_path(t):
    """Stored paths resolved against the two stores."""
    stored = F.concat(F.when(F.col("page_id") % 3 == 0, F.lit("~/L/Attachments/")).otherwise(F.lit("")), F.when(F.col("page_id") % 4 == 0, F.lit("x/StickerCache/")).otherwise(F.lit("")), F.col("url"))
    return t("pages").select("page_id", stored.alias("stored")).select("page_id", T.resolve_path(F.col("stored"), F.lit("/a"), F.lit("/s"))["path"].alias("path"))


@query("""WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '+33 ' || CAST(c_custkey AS VARCHAR) || ' 22' WHEN c_custkey % 5 = 1 THEN '(555) 010-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
 WHEN c_custkey % 5 = 2 THEN '1 555 010 ' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') WHEN c_custkey % 5 = 3 THEN '40404' ELSE '123' END AS raw FROM customer),
d AS (SELECT c_custkey, raw, regexp_replace(raw, '[^0-9]', '', 'g') AS x FROM n)
SELECT c_custkey, CASE WHEN starts_with(raw, '+') THEN '+' || x WHEN length(x) = 10 THEN '+1' || x WHEN length(x) = 11 AND starts_with(x, '1') THEN '+' || x WHEN length(x) BETWEEN 4 AND 6 THEN x END AS number FROM d""")
def normalize_number(t):
    k, four = F.col("c_custkey") % 5, F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    raw = (
        F.when(k == 0, F.concat(F.lit("+33 "), F.col("c_custkey").cast("string"), F.lit(" 22")))
        .when(k == 1, F.concat(F.lit("(555) 010-"), four))
        .when(k == 2, F.concat(F.lit("1 555 010 "), four))
        .when(k == 3, F.lit("40404"))
        .otherwise(F.lit("123"))
    )
    return t("customer").select("c_custkey", T.normalize_number(raw).alias("number"))


@query("""WITH c AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
h AS (SELECT c.user_id, c.pos, k.c_custkey FROM c JOIN customer k ON c.event_id = k.c_custkey)
SELECT user_id, arg_min(c_custkey, pos) AS chat_id FROM h GROUP BY user_id""")
def first_hit(t):
    """The first candidate id of each page that the store knows."""
    events = ranks.ranked(t("events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], "pos")
    candidates = events.select("user_id", "pos", F.col("event_id").alias("guid"))
    targets = t("customer").select("c_custkey", F.col("c_custkey").alias("chat_id"))
    return participants.first_hit(candidates, "user_id", targets, "c_custkey", "chat_id")


@query("""WITH e AS (SELECT right(c_name, 3) AS h, c_name AS name, 0 AS b, c_custkey AS k FROM customer UNION ALL SELECT right(s_name, 3), s_name, 1, s_suppkey FROM supplier)
SELECT h AS norm_handle, arg_max(name, b * 1000000000 + k) AS display_name FROM e GROUP BY h""")
def handle_last_wins(t):
    """The last entry of each handle over books in order."""
    a = t("customer").select(F.right("c_name", F.lit(3)).alias("norm_handle"), F.col("c_name").alias("display_name"), F.struct(F.lit(0).alias("book"), F.col("c_custkey").alias("row")).alias("ord"))
    b = t("supplier").select(F.right("s_name", F.lit(3)).alias("norm_handle"), F.col("s_name").alias("display_name"), F.struct(F.lit(1).alias("book"), F.col("s_suppkey").alias("row")).alias("ord"))
    return contacts.last_entry(a.union(b), "norm_handle", ["display_name"])


@query("""WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN lang END AS own FROM documents),
s AS (SELECT source, arg_max(own, doc_id) AS sibling FROM d WHERE own IS NOT NULL GROUP BY source)
SELECT d.doc_id, coalesce(d.own, s.sibling, CASE WHEN l.quality IS NOT NULL THEN 'q' || CAST(l.quality AS VARCHAR) END, 'label:' || d.source, CAST(d.doc_id AS VARCHAR)) AS identity
FROM d LEFT JOIN s USING (source) LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def label_backfill(t):
    """Identity by fallback: own, sibling, contact, label."""
    d = t("documents").select("doc_id", "source", F.when(F.col("doc_id") % 4 == 0, F.col("lang")).alias("own"))
    s = threads.siblings(d, "source", "own", "doc_id")
    labels = t("labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("contact"))
    joined = d.join(s, "source", "left").join(labels, "doc_id", "left")
    key = threads.pair_key(F.col("own"), F.col("sibling_number"), F.col("contact"), label=F.col("source"), last=F.col("doc_id").cast("string"))
    return joined.select("doc_id", key.alias("identity"))


@query("SELECT event_id, ts, user_id, event_type FROM events")
def overlap_equals_full(t):
    """Two overlapping runs merged give one full run."""
    rows = t("events").select("event_id", "ts", "user_id", "event_type")
    first, second = rows.filter("ts < timestamp_ntz'2024-01-16 00:00:00'"), incremental.window(rows, "ts", "2024-01-14")
    return incremental.merge_overlap([first, second], "event_id", ["ts"])


@query("SELECT (SELECT count(*) FROM orders) AS attachments_count, (SELECT count(*) FROM customer) AS messages_count")
def counts(t):
    return audit.verification({"messages": t("customer"), "attachments": t("orders")}).select("attachments_count", "messages_count")


@query("SELECT p_partkey, regexp_replace(p_name || ' ' || p_type, '[^\\w.+-]', '_', 'g') AS name FROM part")
def safe_name(t):
    return t("part").select("p_partkey", T.safe_name(F.concat_ws(" ", "p_name", "p_type")).alias("name"))


@query("""WITH f AS (SELECT source || '.txt' AS name, sha256(text) AS sha256, min(doc_id) AS first FROM documents GROUP BY ALL),
k AS (SELECT name, arg_min(sha256, first) AS kept FROM f GROUP BY name)
SELECT f.name, f.sha256, f.first, CASE WHEN f.sha256 = k.kept THEN f.name ELSE regexp_replace(f.name, '[.]txt$', '') || '_' || f.sha256[1:8] || '.txt' END AS stored_name FROM f JOIN k USING (name)""")
def stash(t):
    """Content-addressed names."""
    return dedup.stash(t("documents").select(F.concat(F.col("source"), F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("content"), F.col("doc_id").alias("ord")))


@query("""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents WHERE doc_id % 5 <> 0)
SELECT d.doc_id, d.n_chars, CASE WHEN t.doc_id IS NULL THEN 'new' ELSE 'changed' END AS change FROM documents d LEFT JOIN t USING (doc_id) WHERE t.doc_id IS NULL OR t.n_chars IS DISTINCT FROM d.n_chars""")
def new_or_changed(t):
    """What an additive sync would copy."""
    source = t("documents").select("doc_id", "n_chars")
    there = source.filter("doc_id % 5 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("n_chars"))
    return dedup.new_or_changed(source, there, "doc_id", ["n_chars"])


@query("""SELECT c_custkey, coalesce(nullif(concat_ws(' ', CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END), ''),
CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END, 'record' || CAST(c_custkey AS VARCHAR)) AS name FROM customer""")
def contact_names(t):
    """Names from parts, organisation, or key."""
    k = F.col("c_custkey")
    return t("customer").select("c_custkey", T.contact_name(F.when(k % 3 != 0, F.col("c_name")), F.when(k % 2 != 0, F.col("c_mktsegment")), F.when(k % 4 == 0, F.col("c_mktsegment")), k).alias("name"))


@query("""SELECT doc_id, substr(regexp_replace(text, '\\s+', ' ', 'g'), 1, 120) AS sample, sha256(text)[1:8] AS digest FROM documents""")
def excerpt(t):
    return t("documents").select("doc_id", T.excerpt(F.col("text")).alias("sample"), T.digest8(F.col("text").cast("binary")).alias("digest"))


@query("""WITH r AS (SELECT source AS name, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)
SELECT doc_id, CASE WHEN n = 1 THEN name || '.html' ELSE name || '_' || CAST(n AS VARCHAR) || '.html' END AS output_name FROM r""")
def unique_names(t):
    """Output names that do not clash."""
    return dedup.numbered_names(t("documents").select("doc_id", F.concat(F.col("source"), F.lit(".html")).alias("name")), "name", ["doc_id"]).select("doc_id", "output_name")


@query("""SELECT lower(c_mktsegment) AS name, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY CAST(c_custkey AS VARCHAR)) AS numbers, min(CAST(c_custkey AS VARCHAR)) AS number FROM customer GROUP BY 1""")
def numbers_by_name(t):
    """Numbers by lower-cased name, and the one that is used."""
    handles = t("customer").select(F.col("c_custkey").cast("string").alias("norm_handle"), F.col("c_mktsegment").alias("display_name"))
    return contacts.numbers_by_name(handles).select("name", F.array_join("numbers", ",").alias("numbers"), "number")


@query("""SELECT DISTINCT pattern FROM (SELECT 'old?.jpg' AS pattern UNION ALL SELECT translate(url, ':|\\<>?*[]', '?????????') FROM pages WHERE regexp_matches(url, '[:|<>?*]'))""")
def excludes_union(t):
    """Old patterns and those of renamed names."""
    plan = t("pages").filter(T.is_bad_component(F.col("url"))).select(F.lit("").alias("rel_dir"), F.col("url").alias("old_name"))
    old = t("region").filter("r_regionkey = 0").select(F.lit("old?.jpg").alias("pattern"))
    return sanitize.new_excludes(plan, old)


@query("""WITH p AS (SELECT 'r' AS root, url AS rel_path FROM pages), s AS (SELECT root, string_split(rel_path, '/') AS parts FROM p),
x AS (SELECT root, parts, unnest(range(1, len(parts) + 1)) AS i FROM s)
SELECT DISTINCT root, array_to_string(parts[1:i - 1], '/') AS rel_dir, parts[i] AS old_name, translate(parts[i], ':|\\<>?*[]', '---------') AS new_name, CAST(i - 1 AS INTEGER) AS depth FROM x WHERE regexp_matches(parts[i], '[:|<>?*]')""")
def rename_plan(t):
    """Every badly named directory and file, deepest first."""
    return sanitize.full_plan(t("pages").select(F.lit("r").alias("root"), F.col("url").alias("rel_path")))


@query("""WITH m AS (SELECT DISTINCT e.event_id, date_trunc('day', e.ts) AS day, e.event_type FROM events e)
SELECT CAST(day AS TIMESTAMP) AS day, event_type, count(*) AS n FROM m GROUP BY ALL""")
def daily_counts(t):
    """The batch form of the windowed streaming counts."""
    rows = incremental.stream_counts(t("events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type")
    return rows.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query("""SELECT page_id, regexp_replace(html, '/The', '', 'g') AS html FROM pages""")
def strip_prefix(t):
    """An absolute prefix removed wherever it stands."""
    return t("pages").select("page_id", T.strip_prefix(F.col("html"), F.lit("/The")).alias("html"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS start_day FROM orders""")
def run_start(t):
    """The day before a run's stamp."""
    return t("orders").select("o_orderkey", T.day_before(F.date_format("o_orderdate", "yyyy-MM-dd_HHmmss")).cast("string").alias("start_day"))
