"""The attachment audit: references joined to their files, classified, counted and reported."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators.ranks import first_few, ranked
from missivelake.sources.stores import few, sent, staged


def chat_names(chat: DataFrame, chat_handle: DataFrame, handle: DataFrame) -> DataFrame:
    """(chat_id, chat_name): the display name, else the members by handle, else the identifier."""
    members = chat_handle.join(handle, chat_handle["handle_id"] == handle["ROWID"]).groupBy("chat_id").agg(F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("members"))
    return chat.join(members, chat["ROWID"] == members["chat_id"], "left").select(chat["ROWID"].alias("chat_id"), F.coalesce(F.nullif(F.col("display_name"), F.lit("")), F.col("members"), F.col("chat_identifier")).alias("chat_name"))


def is_stored_path(path: Column) -> Column:
    return path.isNotNull() & (path.ilike("%Attachments/%") | path.ilike("%StickerCache/%"))


#: What stands for a chat without a name.
UNKNOWN = "(unknown chat)"


def chat_codes(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(chat_id, code) and (code, chat): a number for each chat name, which sorts as the names do.

    A name may list thousands of members and stand in millions of rows: rows that move, are sorted or kept hold its number, and
    :func:`named` puts the name in its place at the end.
    """
    chats = chat_names(tables["chat"], tables["chat_handle_join"], tables["handle"]).select("chat_id", F.coalesce(F.nullif("chat_name", F.lit("")), F.lit(UNKNOWN)).alias("chat"))
    chats = staged(chats, "chats")
    names = staged(ranked(chats.select("chat", F.lit(0).alias("of")).distinct(), ["of"], ["chat"], "code").select("code", "chat"), "names")
    return staged(chats.join(names, "chat").select("chat_id", "code"), "codes"), names


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with the chat's name in the place of its code."""
    return rows.join(sent(names, "chat"), "code").select(*["chat" if c == "code" else c for c in rows.columns])


def attachment_references(tables: dict[str, DataFrame]) -> DataFrame:
    """One row for each (attachment, message, chat): chat_name, transfer_name, stored_path, msg_date."""
    names = chat_names(tables["chat"], tables["chat_handle_join"], tables["handle"])
    return chat_references(tables).join(names, "chat_id").select("chat_name", "transfer_name", "stored_path", "msg_date")


def references_by_chat(tables: dict[str, DataFrame]) -> DataFrame:
    """(chat_name, n_refs, least): the references of each chat name and the least of their paths, counted by chat before names are joined."""
    names = chat_names(tables["chat"], tables["chat_handle_join"], tables["handle"])
    counted = chat_references(tables).groupBy("chat_id").agg(F.count("*").alias("n_refs"), F.min("stored_path").alias("least"))
    return counted.join(names, "chat_id").groupBy("chat_name").agg(F.sum("n_refs").alias("n_refs"), F.min("least").alias("least"))


def coded_references(tables: dict[str, DataFrame], codes: DataFrame) -> DataFrame:
    """:func:`attachment_references` with the number of the chat's name, from :func:`chat_codes`."""
    return chat_references(tables).join(codes, "chat_id").select("code", "transfer_name", "stored_path", "msg_date")


def chat_references(tables: dict[str, DataFrame]) -> DataFrame:
    """One row for each (attachment, message, chat): chat_id, transfer_name, stored_path, msg_date."""
    a = tables["attachment"].filter(is_stored_path(F.col("filename"))).select(F.col("ROWID").alias("attachment_id"), F.col("filename").alias("stored_path"), "transfer_name")
    m = tables["message"].select(F.col("ROWID").alias("message_id"), F.col("date").alias("msg_date"))
    return a.join(tables["message_attachment_join"], "attachment_id").join(m, "message_id").join(tables["chat_message_join"], "message_id").select("chat_id", "transfer_name", "stored_path", "msg_date")


def _by_shape(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """The distinct (value) that a pattern without a star matches.

    patterns: (n, at, size, piece, regex): a literal piece of ``size`` characters from ``at`` on, in values of length ``n``.
    Each value meets the few shapes of its length, and by equality the patterns with its own piece there; only those are
    matched as expressions.
    """
    shapes = patterns.select("n", "at", "size").distinct()  # few: lengths and places, not patterns
    pieces = values.withColumn("n", F.length("value")).join(shapes, "n").withColumn("piece", F.expr("substring(value, at, size)"))
    return pieces.join(patterns, ["n", "at", "size", "piece"]).filter("value rlike regex").select("value").distinct()


#: Lengths of the pieces by which values and patterns with a star meet.
PIECES = (1, 2, 4, 8, 16, 32)


def _by_piece(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """The distinct (value) that a pattern with a star matches, wherever its stars stand.

    patterns: (pattern, regex).  A pattern's longest literal run is cut to the longest of ``PIECES`` that it holds, at
    every place; of these pieces the one that the fewest values hold stands for the pattern.  A value has to hold it too, so
    they meet by equality, and only then is the expression tried.  Patterns without any literal match by length alone: of them only the
    shortest counts.
    """
    runs = patterns.withColumn("run", F.array_max(F.transform(F.split("pattern", "[?*]"), lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))["run"])
    free = runs.filter("run = ''").agg(F.min(F.length(F.replace("pattern", F.lit("*"), F.lit("")))).alias("least"))
    size = F.lit(0)
    for n in PIECES:
        size = F.when(F.length("run") >= n, F.lit(n)).otherwise(size)
    own = runs.filter("run <> ''").withColumn("size", size)
    cut = F.transform(F.sequence(F.lit(1), F.length("run") - F.col("size") + 1), lambda i: F.substring("run", i, F.col("size")))
    own = own.select("pattern", "regex", F.explode(F.array_distinct(cut)).alias("piece"))
    wanted = own.select("piece").distinct()
    every = lambda n: F.when(F.length("value") >= n, F.transform(F.sequence(F.lit(1), F.length("value") - n + 1), lambda i: F.substring("value", i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    sizes = [r["n"] for r in wanted.select(F.length("piece").alias("n")).distinct().collect()]  # at most six
    if sizes:
        held = values.select("value", F.explode(F.array_distinct(F.concat(*[every(n) for n in sorted(sizes)]))).alias("piece")).join(wanted, "piece", "left_semi")
        held = staged(held, "pieces")
        often = held.groupBy("piece").agg(F.count("*").alias("n"))
        chosen = own.join(often, "piece").groupBy("pattern", "regex").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"), F.count("*").alias("n"))
        # A pattern with a piece that no value holds matches nothing.
        whole = own.groupBy("pattern").agg(F.count("*").alias("n"))
        chosen = chosen.join(whole, ["pattern", "n"]).select("regex", "piece")
        found = held.join(chosen, "piece").filter("value rlike regex").select("value")
    else:
        found = values.limit(0)
    least = free.first()["least"]
    return (found if least is None else found.union(values.filter(F.length("value") >= least))).distinct()


def excluded(refs: DataFrame, patterns: DataFrame, column: str = "tail") -> DataFrame:
    """Rows whose value an exclude pattern matches.

    Patterns without a wildcard meet by equality.  Those whose wildcards are single characters meet by length and by
    their longest literal piece, those with a star by the rarest piece of their longest literal run.
    """
    literal = patterns.filter(~F.col("pattern").rlike(r"[?*]")).select(F.col("pattern").alias("value")).distinct()
    wild = staged(patterns.filter(F.col("pattern").rlike(r"[?*]")).select("pattern", T.pattern_regex(F.col("pattern")).alias("regex")).distinct(), "patterns")
    parts = F.split("pattern", "[?]")
    piece = F.array_max(F.transform(parts, lambda p, i: F.struct(F.length(p).alias("size"), (F.aggregate(F.slice(parts, F.lit(1), i), F.lit(1), lambda a, x: a + F.length(x) + 1)).alias("at"), p.alias("piece"))))
    single = wild.filter("not contains(pattern, '*')").withColumn("p", piece).select(F.length("pattern").alias("n"), "p.at", "p.size", "p.piece", "regex")
    star = wild.filter("contains(pattern, '*')").select("pattern", "regex")
    values = refs.filter(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    known = literal.union(_by_shape(values, single))
    if not star.isEmpty():
        known = known.union(_by_piece(values, star))
    return refs.join(known.distinct(), F.col(column) == F.col("value"), "left_semi")


def classify(refs: DataFrame, inventory: DataFrame, patterns: DataFrame | None = None, attachments: str = "", stickers: str = "") -> DataFrame:
    """Adds path, tail, file, sent and status (ok, zero_byte, missing) to attachment references.

    inventory: (path, length).  A missing file whose tail an exclude pattern matches is ok.  References with a ``code`` keep it.
    """
    coded = "code" in refs.columns
    resolved = T.resolve_path(F.col("stored_path"), F.lit(attachments), F.lit(stickers))
    rows = refs.withColumn("__r", resolved).select(
        F.col("code") if coded else F.coalesce(F.nullif("chat_name", F.lit("")), F.lit(UNKNOWN)).alias("chat"),
        F.col("__r.path").alias("path"),
        F.col("__r.tail").alias("tail"),
        T.either(F.col("transfer_name"), F.col("__r.tail")).alias("file"),
        T.apple_iso(F.col("msg_date")).alias("sent"),
        "stored_path",
    )
    joined = rows.join(inventory.select(F.col("path").alias("__path"), "length"), F.col("path") == F.col("__path"), "left").drop("__path")
    joined = joined.withColumn("__known", F.lit(False))
    if patterns is not None:
        known = excluded(joined.filter("length is null").select("tail").distinct(), patterns).withColumn("__hit", F.lit(True))
        joined = joined.drop("__known").join(known, "tail", "left").withColumn("__known", F.coalesce("__hit", F.lit(False))).drop("__hit")
    return joined.select("code" if coded else "chat", "file", "sent", "tail", "stored_path", "path", status_of(F.col("length"), F.col("__known")).alias("status"))


def status_of(length: Column, known: Column) -> Column:
    return F.when(length.isNull() & known, F.lit("ok")).when(length.isNull(), F.lit("missing")).when(length == 0, F.lit("zero_byte")).otherwise(F.lit("ok"))


def changed_paths(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, was, now): the lengths of files that appeared, went or changed between two inventories (path, length).

    Inventories that were kept in buckets of the path meet without an exchange.
    """
    old = before.select(F.col("path").alias("__path"), F.col("length").alias("was"), F.lit(True).alias("__old"))
    both = old.join(after.select("path", F.col("length").alias("now"), F.lit(True).alias("__new")), F.col("__path") == F.col("path"), "full_outer")
    return both.filter(F.col("__old").isNull() | F.col("__new").isNull() | ~F.col("was").eqNullSafe(F.col("now"))).select(F.coalesce("path", "__path").alias("path"), "was", "now")


def audit_changes(refs: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """``refs`` (path, …) whose status another inventory changes, with the status before (``was``) and now (``now``).

    Only references to files that changed are looked at; with references and inventories kept in buckets of the path, an audit of an
    unchanged archive reads them side by side and moves nothing.
    """
    changed = changed_paths(before, after).select(F.col("path").alias("__changed"), F.col("was").alias("__was"), F.col("now").alias("__now"))
    rows = refs.join(changed, F.col("path") == F.col("__changed"))
    known = F.lit(False)
    told = rows.withColumn("was", status_of(F.col("__was"), known)).withColumn("now", status_of(F.col("__now"), known))
    return told.filter("was <> now").select(*refs.columns, "was", "now")


def totals(classified: DataFrame) -> DataFrame:
    """One row: ok, zero_byte, missing, referenced."""
    return classified.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "zero_byte", "missing")], F.count("*").alias("referenced"))


def problems(classified: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Zero-byte and missing rows, oldest first, undated last; ``names`` (code, chat) are those of coded rows."""
    bad = classified.filter("status <> 'ok'")
    if names is None:
        return bad.orderBy("status", F.col("sent").asc_nulls_last(), "chat", "file")
    # The place is read behind the join: a sort below a join that nothing asks for is dropped.
    placed = bad.orderBy("status", F.col("sent").asc_nulls_last(), "code", "file").withColumn("__at", F.monotonically_increasing_id())
    told = named(placed, names)
    return (told.filter("__at >= 0") if few(names, "chat") else told.orderBy("__at")).drop("__at")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], most: int = 8) -> DataFrame:
    """The first rows of each group, with the group's size and how many are not shown."""
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n_total"))  # counted with map-side combination
    return first_few(rows, group, order, most, "rn").join(sizes, group).withColumn("n_more", F.greatest(F.col("n_total") - most, F.lit(0)))


#: The order of an audit's records: oldest first, undated last.
RECORD_ORDER = ["undated", "sent", "chat", "file", "tail", "stored_path"]


#: Bytes of a chat's name that an audit's records hold; longer ones stand once in the document.
NAME_BYTES = 4096


def document_pieces(classified: DataFrame, generated: str, snapshot: str, attachments: str, names: DataFrame | None = None) -> DataFrame:
    """(kind, text, and ``RECORD_ORDER``): the audit as pieces of one JSON document, a record a line; both lists oldest first.

    Kinds 1 and 3 are the records of zero-byte and missing files, the even ones what stands around them.  No row holds a list.
    ``names`` (code, chat) are those of coded rows.  Names of more than ``NAME_BYTES`` bytes, of which a document would hold copies in all
    records, stand once in an object "chats" behind the lists, by their code, which records have as "chat_ref" in the place of "chat".
    """
    rest = F.to_json(F.struct("file", "sent", "tail", "stored_path"), {"ignoreNullFields": "false"})
    long = None
    if names is None:
        record = F.to_json(F.struct("chat", "file", "sent", "tail", "stored_path"), {"ignoreNullFields": "false"})
    else:
        is_long = F.octet_length("chat") > NAME_BYTES
        begin = F.when(is_long, F.to_json(F.struct(F.col("code").alias("chat_ref")))).otherwise(F.to_json(F.struct("chat")))
        classified = classified.join(names.select("code", F.regexp_replace(begin, r"\}$", ",").alias("__begin")), "code").withColumn("chat", F.col("code"))
        record = F.concat("__begin", F.substring(rest, 2, 1 << 30))
        entry = F.regexp_replace(F.regexp_replace(F.to_json(F.create_map(F.col("code").cast("string"), F.col("chat"))), r"^\{", ""), r"\}$", "")
        long = names.filter(is_long).select(F.lit(5).alias("kind"), entry.alias("text"), F.col("code").alias("chat"))
        long = None if long.isEmpty() else long
    kind = F.when(F.col("status") == "zero_byte", F.lit(1)).otherwise(F.lit(3)).alias("kind")
    records = classified.filter("status <> 'ok'").select(kind, record.alias("text"), F.col("sent").isNull().alias("undated"), "sent", "chat", "file", "tail", "stored_path")
    fields = F.struct(
        F.lit(generated).alias("generated"), F.lit(snapshot).alias("snapshot_db"), F.lit(attachments).alias("shared_attachments"), F.struct("ok", "zero_byte", "missing", "referenced").alias("totals"),
    )
    head = F.concat(F.regexp_replace(F.to_json(fields), r"\}$", ""), F.lit(',\n"zero_byte":[\n'))
    tail = [(4, F.lit("\n]}\n"))] if long is None else [(4, F.lit('\n],\n"chats":{\n')), (6, F.lit("\n}}\n"))]
    around = F.array(*[F.struct(F.lit(k).alias("kind"), text.alias("text")) for k, text in ((0, head), (2, F.lit('\n],\n"missing":[\n')), *tail)])
    nothing = [F.lit(False), *[F.lit(None).cast(records.schema[c].dataType).alias(c) for c in RECORD_ORDER[1:]]]
    records = records.union(totals(classified).select(F.explode(around).alias("x")).select("x.kind", "x.text", *nothing))
    return records if long is None else records.unionByName(long.withColumn("undated", F.lit(False)), allowMissingColumns=True)


def report_lines(classified: DataFrame, most: int = 8, names: DataFrame | None = None) -> DataFrame:
    """The text report: per status and chat the first files by time, then how many more; ``names`` (code, chat) are those of coded rows."""
    if names is not None:
        return coded_lines(classified, names, most)
    bad = classified.filter("status <> 'ok'")
    shown = top_per_group(bad, ["status", "chat"], [F.col("sent").asc_nulls_last(), F.col("file")], most)
    line = F.concat(F.lit("  "), F.coalesce("sent", F.lit("undated")), F.lit("  "), F.col("file"))
    body = shown.select("status", "chat", F.col("rn"), line.alias("line"))
    more = shown.filter("rn = 1 and n_more > 0").select("status", "chat", F.lit(most + 1).alias("rn"), F.format_string("  … and %d more", "n_more").alias("line"))
    head = shown.filter("rn = 1").select("status", "chat", F.lit(0).alias("rn"), F.format_string("%s (%d)", "chat", "n_total").alias("line"))
    return head.union(body).union(more).orderBy("status", "chat", "rn")


def coded_lines(classified: DataFrame, names: DataFrame, most: int) -> DataFrame:
    """(status, chat, rn, line, code): :func:`report_lines` of coded rows; only lines that are shown get the names."""
    shown = top_per_group(classified.filter("status <> 'ok'"), ["status", "code"], [F.col("sent").asc_nulls_last(), F.col("file")], most)
    line = F.concat(F.lit("  "), F.coalesce("sent", F.lit("undated")), F.lit("  "), F.col("file"))
    body = shown.select("status", "code", "rn", line.alias("line"), "n_total")
    more = shown.filter("rn = 1 and n_more > 0").select("status", "code", F.lit(most + 1).alias("rn"), F.format_string("  … and %d more", "n_more").alias("line"), "n_total")
    head = shown.filter("rn = 1").select("status", "code", F.lit(0).alias("rn"), F.lit(None).cast("string").alias("line"), "n_total")
    rows = head.union(body).union(more).join(sent(names, "chat"), "code")
    return rows.select("status", "chat", "rn", F.coalesce("line", F.format_string("%s (%d)", "chat", "n_total")).alias("line"), "code").orderBy("status", "code", "rn")


def verification(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of messages and attachments, as recorded with a snapshot."""
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in sorted(tables.items())]
    rows = reduce(DataFrame.union, counts)
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(f"{name}_count") for name in sorted(tables)])
