"""Voice conversations: identity of each chunk, threads, names, and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators.ranks import first_few


def chunk_facts(chunks: DataFrame) -> DataFrame:
    """Adds to chunks (file, file_ord, label, participants, messages, ...): the other party's number as the
    messages and as the file's name give it.  Within a chunk the least number stands for its set."""
    others = F.array_distinct(F.filter(F.transform("messages", lambda m: F.when(~m["is_me"], F.nullif(m["sender_tel"], F.lit("")))), lambda x: x.isNotNull()))
    return (
        chunks.filter(F.size("messages") > 0)
        .withColumn("message_number", F.array_min(others))
        .withColumn("file_number", T.number_of_filename(F.col("file")))
        .withColumn("is_group", F.coalesce(F.size("participants"), F.lit(0)) > 1)
    )


def siblings(rows: DataFrame, label: str, number: str, order: str) -> DataFrame:
    """(<label>, sibling_number): the number of the last row of each label that has one."""
    return rows.filter(F.col(number).isNotNull() & (F.coalesce(F.col(label), F.lit("")) != "")).groupBy(label).agg(F.max_by(number, order).alias("sibling_number"))


def pair_key(*numbers: Column, label: Column, last: Column) -> Column:
    """The first number there is, else label:<label>, else the last resort."""
    return F.coalesce(*numbers, F.when(F.coalesce(label, F.lit("")) != "", F.concat(F.lit("label:"), label)), last)


def identify(chunks: DataFrame, numbers_by_name: DataFrame | None = None) -> DataFrame:
    """Adds kind and thread_key.

    A group is its set of participants.  A conversation of two is the first of: a message's number, the file
    name's number, the number of another chunk with that label (of the last such file), the contact's number,
    label:<label>, the file's stem.
    """
    facts = chunk_facts(chunks)
    joined = facts.join(siblings(facts.filter("not is_group"), "label", "message_number", "file_ord"), "label", "left")
    if numbers_by_name is not None:
        joined = joined.join(numbers_by_name.select(F.col("name").alias("__name"), T.normalize_number(F.col("number")).alias("contact_number")), F.lower("label") == F.col("__name"), "left").drop("__name")
    else:
        joined = joined.withColumn("contact_number", F.lit(None).cast("string"))
    pair = pair_key(*map(F.col, ("message_number", "file_number", "sibling_number", "contact_number")), label=F.col("label"), last=T.stem(F.col("file")))
    members = F.array_sort(F.array_distinct("participants"))
    return joined.withColumn("kind", F.when(F.col("is_group"), F.lit("group")).otherwise(F.lit("1:1"))).withColumn("thread_key", F.when(F.col("is_group"), F.array_join(members, ", ")).otherwise(pair)).withColumn("members", F.when(F.col("is_group"), members))


def messages_of(identified: DataFrame) -> DataFrame:
    """One row a message, last copy of an id wins at the first copy's place."""
    rows = identified.select("kind", "thread_key", "members", "file_ord", F.posexplode("messages").alias("msg_ord", "m"))
    rows = rows.withColumn("guid", T.message_uuid(F.col("m.ts_iso"), F.col("m.sender_tel"), F.col("m.text_html")))
    place = F.struct("file_ord", "msg_ord")
    return rows.groupBy("kind", "thread_key", "guid").agg(F.max_by("m", place).alias("m"), F.min(place).alias("place"), F.first("members").alias("members"))


def thread_names(messages: DataFrame, handles: DataFrame | None = None) -> DataFrame:
    """(kind, thread_key, display_name): the contact's name, else the first name that is not a number."""
    real = F.when(~F.col("m.is_me") & ~T.looks_like_number(F.col("m.display_name")), F.col("m.display_name"))
    named = messages.groupBy("kind", "thread_key").agg(F.min_by(real, F.when(real.isNotNull(), F.col("place"))).alias("found"))
    if handles is None:
        return named.select("kind", "thread_key", F.coalesce("found", "thread_key").alias("display_name"))
    joined = named.join(handles.select("norm_handle", F.col("display_name").alias("contact")), T.norm_phone(F.col("thread_key")) == F.col("norm_handle"), "left")
    return joined.select("kind", "thread_key", F.coalesce(F.when(F.col("kind") == "1:1", F.col("contact")), "found", "thread_key").alias("display_name"))


def output_name(kind: Column, key: Column, members: Column) -> Column:
    label = F.when(key.startswith("label:"), T.safe_name(F.substring(key, 7, F.length(key)))).otherwise(key)
    return F.concat(F.when(kind == "group", T.group_name(members)).otherwise(label), F.lit(".html"))


def plan(messages: DataFrame) -> DataFrame:
    """(kind, thread_key, output_name, n_messages, n_attachments), most messages first."""
    grouped = messages.groupBy("kind", "thread_key").agg(F.first("members").alias("members"), F.count("*").alias("n_messages"), F.sum(F.size("m.attachments")).alias("n_attachments"))
    return grouped.select("kind", "thread_key", output_name(F.col("kind"), F.col("thread_key"), F.col("members")).alias("output_name"), "n_messages", "n_attachments").orderBy(F.desc("n_messages"), "thread_key")


def resolve_attachments(messages: DataFrame, media: DataFrame) -> DataFrame:
    """Replaces attachment names by media paths: the least path whose name without suffix is the attachment.

    media: (path).  Attachments without a file stay out; adds n_missing.
    """
    files = media.groupBy(T.stem(F.col("path")).alias("att")).agg(F.min("path").alias("media_path"))
    refs = messages.select("kind", "thread_key", "guid", F.posexplode_outer("m.attachments").alias("pos", "att"))
    found = refs.join(files, "att", "left").groupBy("kind", "thread_key", "guid").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("media_path").isNotNull(), F.struct("pos", "media_path")))), lambda x: x["media_path"]).alias("resolved"),
        F.count_if(F.col("att").isNotNull() & F.col("media_path").isNull()).alias("n_missing"),
    )
    return messages.join(found, ["kind", "thread_key", "guid"])


def attachment_totals(messages: DataFrame, media: DataFrame) -> DataFrame:
    """Resolved attachments by distinct name, missing ones by reference."""
    files = media.select(T.stem(F.col("path")).alias("att"), F.lit(True).alias("there")).distinct()
    refs = messages.select(F.explode("m.attachments").alias("att")).join(files, "att", "left")
    return refs.agg(F.count_distinct(F.when(F.col("there"), F.col("att"))).alias("resolved"), F.count_if(F.col("there").isNull()).alias("missing"))


def unresolved(messages: DataFrame, media: DataFrame, most: int = 10) -> DataFrame:
    """(att): the first distinct attachment names without a file, by name."""
    files = media.select(T.stem(F.col("path")).alias("att")).distinct()
    return messages.select(F.explode("m.attachments").alias("att")).distinct().join(files, "att", "left_anti").orderBy("att").limit(most)


def own_number(chunks: DataFrame) -> DataFrame:
    """(own_number): the owner's number as the last file that has one gives it."""
    return chunks.agg(F.max_by("own_number", F.when(F.col("own_number").isNotNull(), F.col("file_ord"))).alias("own_number"))


def page_pieces(messages: DataFrame, names: DataFrame, outputs: DataFrame) -> DataFrame:
    """(name, kind, text, ts, place): each thread's page as sorted pieces: its head, its messages in time order, its tail.

    outputs: (kind, thread_key, output_name).
    """
    joined = messages.join(names, ["kind", "thread_key"]).join(outputs.select("kind", "thread_key", F.col("output_name").alias("name")), ["kind", "thread_key"])
    attachments = F.col("resolved") if "resolved" in messages.columns else F.col("m.attachments")
    wall = F.to_timestamp_ntz(F.regexp_extract("m.ts_iso", r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})", 1), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    sender = F.when(F.col("kind") == "1:1", F.col("display_name")).otherwise(F.col("m.display_name"))
    one = T.render_message(F.col("guid"), T.display_time(wall), sender, F.col("m.is_me"), F.col("m.text_html"), attachments)
    body = joined.select("name", F.lit(1).alias("kind"), one.alias("text"), F.try_to_timestamp(F.col("m.ts_iso")).alias("ts"), "place")
    head = F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), T.html_escape(F.col("display_name")), F.lit("</title></head><body>\n"))
    pages = joined.groupBy("name").agg(F.min(F.struct("thread_key", "display_name")).alias("t")).select("name", F.col("t.display_name").alias("display_name"))
    nowhere = [F.lit(None).cast("timestamp"), F.lit(None).cast(body.schema["place"].dataType)]
    return body.union(pages.select("name", F.lit(0), head, *nowhere)).union(pages.select("name", F.lit(2), F.lit("\n</body></html>"), *nowhere))


def skipped(files: DataFrame) -> DataFrame:
    """(kind, n, samples): files that are no text conversations, by kind, with the first five names."""
    kinds = files.withColumn("kind", T.file_kind(F.col("file"))).filter(~F.col("kind").isin("Text", "Group")).select("kind", "file")
    samples = first_few(kinds, ["kind"], ["file"], 5).groupBy("kind").agg(F.array_sort(F.collect_list("file")).alias("samples"))
    return kinds.groupBy("kind").agg(F.count("*").alias("n")).join(samples, "kind").select("kind", "n", "samples")


def group_sidecar(messages: DataFrame) -> DataFrame:
    """(output_name, members) of groups."""
    groups = messages.filter("kind = 'group'").groupBy("kind", "thread_key").agg(F.first("members").alias("members"))
    return groups.select(output_name(F.col("kind"), F.col("thread_key"), F.col("members")).alias("output_name"), "members")
