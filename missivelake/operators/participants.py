"""Members of group conversations, found through the newest and oldest message ids of each page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.sources.stores import sent, staged

#: Bytes of a member list that a page's entry holds; longer ones stand once in the document.
LIST_BYTES = 4096


def member_sets(rows: DataFrame, group: str, member: str) -> DataFrame:
    """(<group>, members): the sorted distinct members of each group."""
    return rows.groupBy(group).agg(F.array_sort(F.collect_set(member)).alias("members"))


def candidate_ids(pages: DataFrame) -> DataFrame:
    """(file, pos, guid) for group pages: the ten last ids in reverse, then the five first."""
    groups = pages.filter(T.is_group_filename(F.col("file")))
    return groups.select("file", F.posexplode(T.candidate_guids(T.message_guids(F.col("text")))).alias("pos", "guid"))


def first_hit(candidates: DataFrame, key: str, targets: DataFrame, target_key: str, target_value: str) -> DataFrame:
    """(<key>, <target_value>): the value of the first candidate, by ``pos``, that the targets hold."""
    hits = candidates.join(targets.select(F.col(target_key).alias("guid"), target_value), "guid")
    return hits.groupBy(key).agg(F.min(F.struct("pos", target_value)).alias("hit")).select(key, F.col(f"hit.{target_value}").alias(target_value))


def page_chats(pages: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(file, chat_id): the chat of each group page's first id that resolves."""
    return resolved_chats(candidate_ids(pages), tables)


def resolved_chats(candidates: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """:func:`page_chats` of (file, pos, guid), the ids that pages are known by."""
    chat_of = tables["message"].join(tables["chat_message_join"], F.col("ROWID") == F.col("message_id")).groupBy("guid").agg(F.min("chat_id").alias("chat_id"))
    return first_hit(candidates, "file", chat_of, "guid", "chat_id")


def member_lists(tables: dict[str, DataFrame]) -> DataFrame:
    """(chat_id, handles, listed): the members of each chat once, as an array and as JSON; duplicates stay."""
    members = tables["chat_handle_join"].join(tables["handle"], F.col("handle_id") == F.col("ROWID")).select("chat_id", "id")
    lists = members.groupBy("chat_id").agg(F.array_sort(F.collect_list("id")).alias("handles"))
    return staged(lists.withColumn("listed", F.to_json("handles")), "members")


def participants(pages: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(file, handles): the members of the chat of each group page's first id that resolves.

    Duplicate members stay; a chat without members leaves its page unresolved, and no further id is tried.  The lists of chats, not their
    members, meet the pages, and do not move with them.
    """
    return page_chats(pages, tables).join(sent(member_lists(tables), "listed"), "chat_id").select("file", "handles")


def quoted(column: str) -> Column:
    """A text as a JSON string."""
    return F.regexp_replace(F.regexp_replace(F.to_json(F.array(column)), r"^\[", ""), r"\]$", "")


def sidecar_pieces(found: DataFrame) -> DataFrame:
    """(kind, text, file): the members as pieces of a JSON object file -> members, an entry a line; no pieces if nothing was resolved."""
    entries = found.select(F.lit(1).alias("kind"), F.concat(F.lit("  "), quoted("file"), F.lit(": "), F.to_json("handles")).alias("text"), "file")
    return between(entries, found, [(0, "{\n"), (2, "\n}\n")])


def between(entries: DataFrame, found: DataFrame, around: list[tuple[int, str]]) -> DataFrame:
    """``entries`` and what stands around them, unless nothing was found."""
    some = found.agg(F.min("file").alias("file")).filter("file is not null")
    ends = some.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(text).alias("text")) for k, text in around])).alias("x"), "file")
    return entries.union(ends.select("x.kind", "x.text", "file"))


def shared_sidecar_pieces(chats: DataFrame, lists: DataFrame, most: int = LIST_BYTES) -> DataFrame:
    """:func:`sidecar_pieces` of (file, chat_id) and the lists of chats, :func:`member_lists`.

    Lists of more than ``most`` bytes, of which a document would hold a copy for each page, stand once in an object "members" behind the
    pages, by their chat; their pages' entries are {"members_ref": chat}.
    """
    short = lists.select("chat_id", F.when(F.octet_length("listed") > most, F.to_json(F.struct(F.col("chat_id").alias("members_ref")))).otherwise(F.col("listed")).alias("listed"))
    found = staged(chats.join(short, "chat_id"), "pages")
    entries = found.select(F.lit(1).alias("kind"), F.concat(F.lit("  "), quoted("file"), F.lit(": "), F.col("listed")).alias("text"), "file")
    long = lists.filter(F.octet_length("listed") > most).join(chats.select("chat_id").distinct(), "chat_id", "left_semi")
    if long.isEmpty():
        return between(entries, found, [(0, "{\n"), (2, "\n}\n")])
    long = long.select(F.lit(3).alias("kind"), F.concat(F.lit('"'), F.col("chat_id").cast("string"), F.lit('":'), F.col("listed")).alias("text"), F.lit("").alias("file"))
    return between(entries.union(long), found, [(0, "{\n"), (2, ',\n"members":{\n'), (4, "\n}}\n")])
