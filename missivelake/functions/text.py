"""Column functions of the archive: every one is an expression over built-ins, so plans stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These formats, patterns and constants have to equal those of existing archives.
BAD_CHARACTERS = ":|\\<>?*[]"
GUID = "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
MESSAGE_GUID = "message-guid=([A-F0-9a-f-]+)"
ISO_TIME = r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(?::\d{2})?"
HUMAN_TIME = r"[A-Z][a-z]{2}\s+\d{1,2},\s+\d{4}\s+\d{1,2}:\d{2}:\d{2}\s*[AP]M"
REFERENCE = '(?:src|href)="((?:attachments|Attachments|StickerCache)/[^"]+)"'
CALL_KINDS = "Missed|Placed|Received|Voicemail|Recorded"
VOICE_NAMESPACE = "6f1f7c9a00004a1a9c1a676f6f676c65"
ATTACHMENT_MARKERS = ("StickerCache/", "Attachments/")
APPLE_EPOCH_SECONDS = 978307200
NANOSECONDS_FROM = 1_000_000_000_000
GROUP_NAME_BYTES, GROUP_NAME_KEPT_BYTES = 200, 160


def either(*values: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    as_columns = [F.col(v) if isinstance(v, str) else v for v in values]
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in as_columns])


def strip(value: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


# Handles and numbers


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)\D", "")


def norm_phone(value: Column) -> Column:
    """The last ten digits, or all if there are fewer."""
    return F.when(F.length(digits(value)) >= 10, F.right(digits(value), F.lit(10))).otherwise(digits(value))


def norm_email(value: Column) -> Column:
    return F.lower(strip(value))


def norm_handle(value: Column) -> Column:
    return F.when(value.contains("@"), norm_email(value)).otherwise(norm_phone(value))


def looks_like_number(value: Column) -> Column:
    """At least four digits and nothing but digits, white space, parentheses, plus and minus."""
    return (F.length(digits(value)) >= 4) & value.rlike(r"(?U)^[\d\s()+-]*$")


def normalize_number(value: Column) -> Column:
    """+ kept in full; ten digits get +1; eleven from 1 get +; four to six digits are short codes; else null."""
    d, n = digits(value), F.length(digits(value))
    return (
        F.when(strip(value).startswith("+"), F.concat(F.lit("+"), d))
        .when(n == 10, F.concat(F.lit("+1"), d))
        .when((n == 11) & d.startswith("1"), F.concat(F.lit("+"), d))
        .when(n.between(4, 6), d)
    )


def contact_of_filename(name: Column) -> Column:
    """The part of a call or text file's name before its kind, or empty."""
    return strip(F.regexp_extract(name, rf"(?i)^(.*?)[\s_]*-[\s_]*(?:Text|{CALL_KINDS})[\s_]*-", 1))


def number_of_filename(name: Column) -> Column:
    contact = contact_of_filename(name)
    return F.when(looks_like_number(contact), normalize_number(contact))


def file_kind(name: Column) -> Column:
    """Text or Group for conversations; the kind of call; else Unrecognized."""
    call = F.regexp_extract(name, rf"(?i)(?:^|[\s_-])({CALL_KINDS})(?:[\s_-]|$)", 1)
    return (
        F.when(call != "", F.initcap(call))
        .when(name.rlike(r"(?i)(?:^|[\s_-])Text(?:[\s_-]|$)"), F.lit("Text"))
        .when(name.rlike(r"(?i)^Group[\s_]Conversation"), F.lit("Group"))
        .otherwise(F.lit("Unrecognized"))
    )


def title_label(title: Column) -> Column:
    """A conversation's title without its leading "Me to"."""
    return strip(F.regexp_replace(strip(title), r"^Me to\s*", ""))


def is_group_filename(name: Column) -> Column:
    """Several members or a group's name: the stem holds a comma or a space."""
    return stem(name).rlike("[, ]")


def sender_display(name: Column, tel: Column) -> Column:
    return F.coalesce(either(name, tel), F.lit("Unknown"))


def contact_name(first: Column, last: Column, organization: Column, key: Column) -> Column:
    """First and last name, else the organisation, else record<key>."""
    person = F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))
    return F.coalesce(either(person, organization), F.concat(F.lit("record"), key.cast("string")))


# Paths and files


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def suffix(path: Column) -> Column:
    return F.regexp_extract(basename(path), r"[^.](\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    """The base name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(basename(path), r"(?<=[^.])\.[^.]+$", "")


def join_path(base: Column, tail: Column) -> Column:
    """An absolute tail discards the base; a null base gives null."""
    return F.when(base.isNull(), F.lit(None).cast("string")).when(tail.startswith("/"), tail).otherwise(F.concat_ws("/", F.regexp_replace(base, "/+$", ""), tail))


def resolve_path(stored: Column, attachments: Column, stickers: Column) -> Column:
    """struct(path, tail) of a stored attachment path: the tail after the first marker, the sticker store's
    marker tried first; (null, stored) without a marker."""
    found = F.struct(F.lit(None).cast("string").alias("path"), stored.alias("tail"))
    for marker, base in reversed(list(zip(ATTACHMENT_MARKERS, (stickers, attachments)))):
        at = F.instr(stored, marker)
        tail = F.substring(stored, at + len(marker), F.length(stored))
        found = F.when(at > 0, F.struct(join_path(base, tail).alias("path"), tail.alias("tail"))).otherwise(found)
    return found


def is_bad_component(name: Column) -> Column:
    return name.rlike(r"[:|\\<>?*\[\]]")


def sanitize_component(name: Column) -> Column:
    """Each bad character becomes one dash."""
    return F.translate(name, BAD_CHARACTERS, "-" * len(BAD_CHARACTERS))


def sanitize_path(path: Column) -> Column:
    return F.array_join(F.transform(F.split(path, "/"), sanitize_component), "/")


def has_bad_ancestor(path: Column) -> Column:
    """Whether a directory above the last component is bad."""
    parts = F.split(path, "/")
    return F.exists(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), is_bad_component)


def exclude_pattern(name: Column) -> Column:
    """A wildcard pattern for a name: each bad character becomes a question mark."""
    return F.translate(name, BAD_CHARACTERS, "?" * len(BAD_CHARACTERS))


def pattern_regex(pattern: Column) -> Column:
    """The anchored regular expression of a wildcard pattern; ? and * also match a slash."""
    quoted = F.regexp_replace(pattern, r"([.^$+(){}\[\]|\\])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def safe_name(label: Column) -> Column:
    """Everything but letters, digits, underscore, dot, plus and dash becomes an underscore."""
    return F.regexp_replace(label, r"(?U)[^\w.+-]", "_")


def group_name(members: Column, most: int = GROUP_NAME_BYTES, kept_bytes: int = GROUP_NAME_KEPT_BYTES) -> Column:
    """Sorted members joined by a comma; if too long in bytes, the members that fit and how many more."""
    names = F.array_sort(F.array_distinct(members))
    empty = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("full"))

    def add(state: Column, name: Column) -> Column:
        longer = F.array_append(state["kept"], name)
        full = state["full"] | (F.octet_length(F.array_join(longer, ", ")) > kept_bytes)
        return F.struct(F.when(full, state["kept"]).otherwise(longer).alias("kept"), full.alias("full"))

    kept = F.aggregate(names, empty, add, lambda s: s["kept"])
    whole = F.array_join(names, ", ")
    short = F.concat(F.array_join(kept, ", "), F.lit(", +"), (F.size(names) - F.size(kept)).cast("string"), F.lit(" more"))
    return F.when(F.octet_length(whole) > most, short).otherwise(whole)


# Time


def apple_time(value: Column) -> Column:
    """The instant of an Apple timestamp, in nanoseconds or seconds from 2001 on; null for null or zero."""
    in_seconds = F.when(value > NANOSECONDS_FROM, (value - F.pmod(value, F.lit(1_000_000_000))) / 1_000_000_000).otherwise(value)
    return F.when(value.isNotNull() & (value != 0), F.timestamp_seconds(in_seconds.cast("long") + APPLE_EPOCH_SECONDS))


def apple_iso(value: Column) -> Column:
    """ISO text with offset in the session's zone, whole seconds."""
    return F.date_format(apple_time(value), "yyyy-MM-dd'T'HH:mm:ssxxx")


def time_key(raw: Column) -> Column:
    """A sortable key of a displayed time: the human format, else the first ISO time, else the text itself."""
    text = F.regexp_replace(strip(F.coalesce(raw, F.lit(""))), r"\s+", " ")
    human = F.regexp_replace(F.regexp_extract(text, HUMAN_TIME, 0), r"(\d)([AP]M)$", "$1 $2")
    at = F.try_to_timestamp(human, F.lit("MMM d, yyyy h:mm:ss a"))
    iso = F.replace(F.regexp_extract(text, ISO_TIME, 0), F.lit(" "), F.lit("T"))
    return F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.nullif(iso, F.lit("")), text)


def display_time(wall_clock: Column) -> Column:
    """Jul 02, 2026 7:45:05 AM"""
    return F.date_format(wall_clock, "MMM dd, yyyy h:mm:ss a")


def day_before(stamp: Column) -> Column:
    """The date of a run stamp less one day."""
    return F.date_sub(F.to_date(F.substring(stamp, 1, 10)), 1)


def is_day(value: Column) -> Column:
    """The shape of a date; the calendar is not asked."""
    return value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")


# Messages


def guids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({GUID})"), F.lit(1))


def message_guids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(MESSAGE_GUID), F.lit(1))


def candidate_guids(found: Column, newest: int = 10, oldest: int = 5) -> Column:
    """The last ones in reverse, then the first ones."""
    return F.concat(F.slice(F.reverse(found), 1, newest), F.slice(found, 1, oldest))


def references(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(REFERENCE), F.lit(1))


def replace_references(html: Column, pairs: Column) -> Column:
    """Replaces paths by a map where they are the whole value of src or href; the same text elsewhere stays."""
    between = F.split(html, REFERENCE)
    found = F.regexp_extract_all(html, F.lit(REFERENCE), F.lit(0))
    path = F.regexp_extract_all(html, F.lit(REFERENCE), F.lit(1))
    attribute = F.transform(found, lambda x: F.substring_index(x, '"', 1))
    value = F.transform(path, lambda p: F.coalesce(F.try_element_at(pairs, p), p))
    changed = F.zip_with(attribute, value, lambda a, v: F.concat(a, F.lit('"'), v, F.lit('"')))
    return F.array_join(F.zip_with(between, changed, lambda b, c: F.concat(b, F.coalesce(c, F.lit("")))), "")


def strip_prefix(html: Column, prefix: Column) -> Column:
    return F.when(F.length(prefix) > 0, F.replace(html, prefix, F.lit(""))).otherwise(html)


def html_escape(value: Column) -> Column:
    out = value
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def excerpt(value: Column, length: int = 120) -> Column:
    return F.substring(F.regexp_replace(value, r"\s+", " "), 1, length)


def digest8(content: Column) -> Column:
    """The first eight hex digits of SHA-256."""
    return F.substring(F.sha2(content, 256), 1, 8)


def uuid5(key: Column, namespace: str = VOICE_NAMESPACE) -> Column:
    """The upper-case version-5 UUID of a key."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(key, "UTF-8")))
    variant = F.substring(F.lit("89AB"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)) + 1, F.lit(1))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.upper(F.concat_ws("-", *parts))


def message_uuid(ts_iso: Column, sender: Column, text: Column) -> Column:
    """The id of a message that has none: its time as written, sender and text."""
    return uuid5(F.concat_ws("|", ts_iso, F.coalesce(sender, F.lit("")), text))


def direction_class(is_me: Column) -> Column:
    return F.when(is_me, F.lit("sent SMS GoogleVoice")).otherwise(F.lit("received GoogleVoice"))


def render_message(guid: Column, shown_time: Column, sender: Column, is_me: Column, text: Column, attachments: Column) -> Column:
    """One message's markup: sender escaped, text as it is, no bubble for blank text, a block an attachment."""
    bubble = F.when(strip(text) != "", F.concat(F.lit('<span class="bubble">'), text, F.lit("</span>"))).otherwise(F.lit(""))
    blocks = F.array_join(F.transform(attachments, lambda a: F.concat(F.lit('<div class="attachment"><img src="'), a, F.lit('" loading="lazy"></div>'))), "")
    return F.concat(
        F.lit('<div class="message"><div class="'), direction_class(is_me), F.lit('"><p><span class="timestamp"><a href="sms://open?message-guid='), guid, F.lit('">'), shown_time,
        F.lit('</a></span><span class="sender">'), html_escape(F.when(is_me, F.lit("Me")).otherwise(sender)), F.lit('</span></p><hr><div class="message_part">'), bubble, blocks, F.lit("</div></div></div>"),
    )
