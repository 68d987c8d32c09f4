"""Messages of a store as pages, one for each chat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.operators import audit
from missivelake.operators.participants import member_sets


def page_names(tables: dict[str, DataFrame]) -> DataFrame:
    """(chat_id, file): the display name, else the members within the byte budget, else the identifier.

    Slashes become dashes.  Chats of one name share a page, as one person's chats of several services do.
    """
    members = tables["chat_handle_join"].join(tables["handle"], F.col("handle_id") == F.col("ROWID"))
    members = member_sets(members.select("chat_id", "id"), "chat_id", "id")
    named = tables["chat"].join(members, F.col("ROWID") == F.col("chat_id"), "left")
    name = F.coalesce(F.nullif("display_name", F.lit("")), T.group_name(F.col("members")), F.nullif("chat_identifier", F.lit("")), F.lit("unknown"))
    return named.select(F.col("ROWID").alias("chat_id"), F.concat(F.translate(name, "/", "-"), F.lit(".html")).alias("file"))


def thread_messages(tables: dict[str, DataFrame], handles: DataFrame | None = None, attachments: str = "", stickers: str = "") -> DataFrame:
    """(file, guid, ts, sender, is_me, text, attachments): one row for each message and chat.

    The sender is the contact's name, else the handle.  Columns that a store lacks count as null; messages without a chat
    stay out.  Attachments are paths resolved against the two stores, in the order of their keys.
    """
    message = tables["message"]
    for name, kind in (("text", "string"), ("is_from_me", "bigint"), ("handle_id", "bigint")):
        if name not in message.columns:
            message = message.withColumn(name, F.lit(None).cast(kind))
    message = message.select(F.col("ROWID").alias("message_id"), "guid", T.apple_time(F.col("date")).alias("ts"), "text", (F.coalesce("is_from_me", F.lit(0)) == 1).alias("is_me"), "handle_id")
    stored = tables["attachment"].filter(audit.is_stored_path(F.col("filename"))).select(F.col("ROWID").alias("attachment_id"), F.coalesce(T.resolve_path(F.col("filename"), F.lit(attachments), F.lit(stickers))["path"], "filename").alias("path"))
    of_message = tables["message_attachment_join"].join(stored, "attachment_id").groupBy("message_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("attachment_id", "path"))), lambda x: x["path"]).alias("attachments"))
    senders = tables["handle"].select(F.col("ROWID").alias("handle_id"), F.col("id").alias("handle"), T.norm_handle(F.col("id")).alias("norm_handle"))
    if handles is not None:
        senders = senders.join(handles.select("norm_handle", "display_name"), "norm_handle", "left")
    else:
        senders = senders.withColumn("display_name", F.lit(None).cast("string"))
    rows = message.join(tables["chat_message_join"], "message_id").join(page_names(tables), "chat_id").join(of_message, "message_id", "left").join(senders, "handle_id", "left")
    return rows.select("file", "guid", "ts", T.sender_display(F.col("display_name"), F.col("handle")).alias("sender"), "is_me", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("attachments", F.array().cast("array<string>")).alias("attachments")).distinct()


def rendered(messages: DataFrame) -> DataFrame:
    """``messages`` as (file, guid, ts_key, file_ord, msg_ord, html), what ``sinks.merged_pages`` takes."""
    html = T.render_message(F.col("guid"), F.coalesce(T.display_time(F.col("ts")), F.lit("")), F.col("sender"), F.col("is_me"), T.html_escape(F.col("text")), F.col("attachments"))
    key = F.coalesce(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
    return messages.select("file", "guid", key.alias("ts_key"), F.lit(0).alias("file_ord"), F.lit(0).alias("msg_ord"), html.alias("html"))
