"""Substring deduplication with difference-cover anchors.

A window is ``WINDOW`` consecutive words.  Anchors are ``WINDOW - PERIOD + 1`` words long and are taken only
where the word position modulo ``PERIOD`` lies in a difference cover: for any two positions i and j some
shift below PERIOD brings both into the cover.  Two equal windows, however they are aligned, therefore hold
an equal anchor at the same shift, so windows without a shared anchor need no further look.

1. Each task hashes its anchors and sends, by hash range, one packed row a range: an anchor that several
   of its documents hold is sent once, marked, so a passage that very many documents share costs one entry a
   task.  Each range finds the anchors of more than one document and returns (document, position) of them.
2. Documents with shared anchors extend them: every window over such an anchor gets a 96-bit hash and is
   compared in the same way, each task sending a hash for its smallest doc_id only.  A window is removed
   from all documents but the smallest that holds it.
3. The words that removed windows cover are dropped.

Hash ranges follow from the length of all texts, so what one of them holds does not grow with the corpus.

Defined results: a null text has no words.  Rows with a null doc_id neither lose words nor make others lose
them.  Documents are compared by doc_id, so rows of one doc_id do not affect each other, and each loses only words that its
own windows cover.  Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, whole_text, written

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Characters of text for which there is one hash range: some two million anchors.
RANGE_CHARS = 32_000_000
#: Anchors that a task gathers before it sends them.
TASK_ANCHORS = 2_000_000
#: In place of a doc_id: several documents of the task hold the anchor.
MANY = -(1 << 63)
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass"))


class WordHashes:
    """64-bit hashes of words, the same in every process; the table of known words is bounded."""

    def __init__(self, most: int = 500_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def of(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            for k, h in enumerate(found):
                if h is None:
                    found[k] = known[words[k]] = xxh64_intdigest(words[k], 7)
        return np.array(found, np.uint64)


_hashes = WordHashes()


def rolled(words: np.ndarray, length: int, mix: np.uint64) -> np.ndarray:
    """A hash of each run of ``length`` words, by start."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(length):
        h = (h ^ words[k : k + n]) * mix
        h ^= h >> np.uint64(29)
    return h


def cover_positions(n: int) -> np.ndarray:
    """Anchor starts of a document of ``n`` words."""
    p = np.arange(max(0, n - ANCHOR + 1))
    return p[np.isin(p % PERIOD, COVER)]


def _pack_owners(owner: np.ndarray) -> bytes:
    """i64 as its least value and u32 differences where they fit; MANY fits as itself only."""
    if len(owner):
        least = int(owner.min())
        if int(owner.max()) - least < 1 << 32:
            return b"\x04" + np.int64(least).tobytes() + (owner - least).astype("<u4").tobytes()
    return b"\x08" + owner.astype("<i8").tobytes()


def _owners(packed: bytes) -> np.ndarray:
    if packed[0] == 4:
        return np.frombuffer(packed, "<u4", -1, 9).astype(np.int64) + np.frombuffer(packed, "<i8", 1, 1)[0]
    return np.frombuffer(packed, "<i8", -1, 1)


def _pack_places(place: np.ndarray) -> bytes:
    return b"\x02" + place.astype("<u2").tobytes() if not len(place) or place.max() < 1 << 16 else b"\x04" + place.astype("<u4").tobytes()


def _places(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if packed[0] == 2 else "<u4", -1, 1).astype(np.int64)


def _low_bytes(values: np.ndarray, n: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def _from_bytes(packed: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(packed) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(packed, np.uint8).reshape(-1, n)
    return out.view("<u8").ravel()


def _pack_tags(tag: np.ndarray) -> bytes:
    return tag.astype("<i8").tobytes() if tag.any() else b""


def _tags(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, "<i8") if packed else np.zeros(n, np.int64)


def _groups(h: np.ndarray, h2: np.ndarray, owner: np.ndarray, *rest: np.ndarray):
    """Entries sorted by hashes and owner; last, where each run of equal hashes starts, and its length."""
    order = np.lexsort((owner, h2, h))
    h, h2 = h[order], h2[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
    starts = np.flatnonzero(first)
    return h, h2, owner[order], *[x[order] for x in rest], starts, np.diff(np.append(starts, len(h)))


#: What is compared: anchors are reported if another document holds them (6 bytes of hash: a collision only
#: adds a window to look at), windows if a smaller doc_id holds them (12 bytes of hash).  The tag of an entry tells
#: rows of one doc_id apart; it is 0, and takes no room, where a doc_id stands in one row only.
ANCHORS, WINDOWS = "anchors", "windows"
HASH_BYTES = {ANCHORS: (6, 0), WINDOWS: (8, 4)}
ENTRY_SCHEMA = "range int, local int, hashes binary, seconds binary, owners binary, tags binary, places binary"
FOUND_SCHEMA = "bucket int, owners binary, tags binary, places binary"


def _send(kind: str, ranges: int, part: int, chunk: int, h: np.ndarray, h2: np.ndarray, owner: np.ndarray, tag: np.ndarray, place: np.ndarray):
    """Packed rows of one chunk of entries.  Entries that the chunk itself settles go along without their
    hashes, spread over all ranges; of the others each hash is sent for one owner."""
    import pyarrow as pa

    h, h2, owner, tag, place, starts, n = _groups(h, h2, owner, tag, place)
    least = np.repeat(owner[starts], n)
    if kind == ANCHORS:
        settled = np.repeat(owner[starts] != owner[starts + n - 1], n)
        send = ~settled
        send[starts] = True
        sent = np.where(settled, MANY, owner)[send]
    else:
        settled = owner > least
        send = ~settled
        sent = owner[send]
    h, h2, sent_tag, sent_place = h[send], h2[send], tag[send], place[send]
    cuts = np.searchsorted(h, np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)) if ranges > 1 else np.empty(0, np.int64)
    first, second = HASH_BYTES[kind]
    edges = [0, *cuts.tolist(), len(h)]
    rows = [
        (k, 0, _low_bytes(h[i:j], first), _low_bytes(h2[i:j], second) if second else b"", _pack_owners(sent[i:j]), _pack_tags(sent_tag[i:j]), _pack_places(sent_place[i:j]))
        for k, (i, j) in enumerate(zip(edges, edges[1:]))
        if j > i
    ]
    if settled.any():
        rows.append(((part * 31 + chunk) % ranges, 1, b"", b"", _pack_owners(owner[settled]), _pack_tags(tag[settled]), _pack_places(place[settled])))
    columns = list(zip(*rows)) if rows else [[]] * 7
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["range", "local", "hashes", "seconds", "owners", "tags", "places"])


def _by_bucket(buckets: int, owner: np.ndarray, tag: np.ndarray, place: np.ndarray):
    """One record a bucket of documents, so that the rows do not grow with documents times ranges."""
    import pyarrow as pa

    of = (owner.astype(np.uint64) * MIX1 >> np.uint64(33)).astype(np.int64) % buckets
    order = np.argsort(of, kind="stable")
    of, owner, tag, place = of[order], owner[order], tag[order], place[order]
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, np.int64)
    packed = [[pack(x) for x in np.split(values, starts[1:])] if len(of) else [] for pack, values in ((_pack_owners, owner), (_pack_tags, tag), (_pack_places, place))]
    return pa.Table.from_arrays([pa.array(of[starts], pa.int32()), *[pa.array(x, pa.binary()) for x in packed]], names=["bucket", "owners", "tags", "places"])


def _one_row_each(table):
    """(doc_id, tag, places) of one bucket: one row a document, positions sorted and distinct."""
    import pyarrow as pa

    owners = [_owners(x) for x in table.column("owners").to_pylist()]
    tag = np.concatenate([_tags(x, len(o)) for x, o in zip(table.column("tags").to_pylist(), owners, strict=True)])
    owner, place = np.concatenate(owners), np.concatenate([_places(x) for x in table.column("places").to_pylist()])
    order = np.lexsort((place, tag, owner))
    owner, tag, place = owner[order], tag[order], place[order]
    other = np.ones(len(owner), bool)
    other[1:] = (owner[1:] != owner[:-1]) | (tag[1:] != tag[:-1])
    new = other.copy()
    new[1:] |= place[1:] != place[:-1]
    owner, tag, place, other = owner[new], tag[new], place[new], other[new]
    starts = np.flatnonzero(other)
    return pa.Table.from_arrays([pa.array(owner[starts], pa.int64()), pa.array(tag[starts], pa.int64()), pa.array([_pack_places(x) for x in np.split(place, starts[1:])], pa.binary())], names=["doc_id", "tag", "places"])


def _compare(kind: str, sent: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, tag, places): the entries to report, one row a document."""
    first, second = HASH_BYTES[kind]
    buckets = max(1, ranges // 2)

    def one_range(table):
        h, h2, owner, tag, place, done = [], [], [], [], [], [[], [], []]
        for local, a, b, o, t, p in zip(*(table.column(c).to_pylist() for c in ("local", "hashes", "seconds", "owners", "tags", "places")), strict=True):
            o, p = _owners(o), _places(p)
            t = _tags(t, len(o))
            if local:
                for column, x in zip(done, (o, t, p)):
                    column.append(x)
            else:
                h.append(_from_bytes(a, first))
                h2.append(_from_bytes(b, second) if second else np.zeros(len(o), np.uint64))
                owner.append(o)
                tag.append(t)
                place.append(p)
        if h:
            _, _, o, t, p, starts, n = _groups(*(np.concatenate(x) for x in (h, h2, owner, tag, place)))
            least, most = np.repeat(o[starts], n), np.repeat(o[starts + n - 1], n)
            tell = (o != MANY) & ((least != most) | (least == MANY)) if kind == ANCHORS else o > least
            for column, x in zip(done, (o, t, p)):
                column.append(x[tell])
        return _by_bucket(buckets, *(np.concatenate(x) for x in done))

    # As many tasks as ranges, and no group larger than one range.
    found = sent.repartition(ranges, "range").groupBy("range").applyInArrow(one_range, FOUND_SCHEMA)
    return found.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_one_row_each, "doc_id long, tag long, places binary")


def shared_anchors(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, tag, places): positions of anchors that other documents hold too; all tags are 0."""

    def gather(batches):
        from pyspark import TaskContext

        part, chunk = TaskContext.get().partitionId(), 0
        hs, ids, ps, held = [], [], [], 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = words_of(text)
                if name is None or len(w) < WINDOW:
                    continue
                p = cover_positions(len(w))
                hs.append(rolled(_hashes.of(w), ANCHOR, MIX1)[p])
                ids.append(np.full(len(p), name, np.int64))
                ps.append(p)
                held += len(p)
                if held >= TASK_ANCHORS:
                    h = np.concatenate(hs)
                    yield _send(ANCHORS, ranges, part, chunk, h, np.zeros(len(h), np.uint64), np.concatenate(ids), np.zeros(len(h), np.int64), np.concatenate(ps))
                    hs, ids, ps, held, chunk = [], [], [], 0, chunk + 1
        if held:
            h = np.concatenate(hs)
            yield _send(ANCHORS, ranges, part, chunk, h, np.zeros(len(h), np.uint64), np.concatenate(ids), np.zeros(len(h), np.int64), np.concatenate(ps))

    return _compare(ANCHORS, docs.mapInArrow(gather, ENTRY_SCHEMA), ranges)


def duplicate_windows(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, tag, starts): starts of windows whose words also stand in a smaller doc_id.

    tag is 0, or for a doc_id of several rows xxhash64 of the text.
    """
    found = written(shared_anchors(docs, ranges), "shared-anchors")
    several = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("__id"))
    found = found.join(several, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "places", F.col("__id").isNotNull().alias("several"))
    # An inner join: only documents with shared anchors go on.
    rows = docs.filter("doc_id is not null").join(found.hint("shuffle_hash"), "doc_id")
    rows = rows.select("doc_id", F.when(F.col("several"), F.xxhash64("text")).otherwise(F.lit(0)).alias("tag"), "text", "places")

    def extend(batches):
        from pyspark import TaskContext

        part, chunk = TaskContext.get().partitionId(), 0
        held: list[list[np.ndarray]] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            for name, tag, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = _hashes.of(words_of(text))
                if len(w) < WINDOW:
                    continue
                p = _places(places)
                # A window over the anchor at p starts at p - PERIOD + 1 .. p.
                over = np.bincount(np.clip(p - PERIOD + 1, 0, len(w)), minlength=len(w) + 1) - np.bincount(np.clip(p + 1, 0, len(w)), minlength=len(w) + 1)
                s = np.flatnonzero(np.cumsum(over)[: len(w) - WINDOW + 1] > 0)
                for column, x in zip(held, (rolled(w, WINDOW, MIX1)[s], rolled(w, WINDOW, MIX2)[s] >> np.uint64(32), np.full(len(s), name, np.int64), np.full(len(s), tag, np.int64), s)):
                    column.append(x)
                size += len(s)
                if size >= TASK_ANCHORS:
                    yield _send(WINDOWS, ranges, part, chunk, *(np.concatenate(c) for c in held))
                    held, size, chunk = [[], [], [], [], []], 0, chunk + 1
        if size:
            yield _send(WINDOWS, ranges, part, chunk, *(np.concatenate(c) for c in held))

    return _compare(WINDOWS, rows.mapInArrow(extend, ENTRY_SCHEMA), ranges).withColumnRenamed("places", "starts")


def substring_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): kept words joined by one space."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // RANGE_CHARS))
    gone = written(duplicate_windows(rows, ranges), "removed-windows").withColumnRenamed("doc_id", "__id")
    own = (F.col("doc_id") == F.col("__id")) & ((F.col("tag") == 0) | (F.col("tag") == F.xxhash64("text")))
    joined = rows.join(gone.hint("shuffle_hash"), own, "left").select("doc_id", "text", "starts")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            words, removed, kept = [], [], []
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                w = words_of(text)
                words.append(len(w))
                if not starts:
                    removed.append(0)
                    kept.append(b" ".join(w))
                    continue
                over = np.zeros(len(w) + WINDOW + 1, np.int64)
                s = _places(starts)
                over[s] += 1
                over[s + WINDOW] -= 1
                stays = np.cumsum(over)[: len(w)] == 0
                removed.append(int(len(w) - stays.sum()))
                kept.append(b" ".join([x for x, y in zip(w, stays.tolist()) if y]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")


