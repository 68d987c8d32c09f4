"""Token-id files compressed by a pair grammar (Re-Pair), with random access.

Documents in ascending doc_id order are encoded and gathered into shards.  In each shard the frequent
adjacent pairs are replaced by nonterminals until none is left that pays; pairs never cross documents.  Pairs
are counted exactly, by sorting them.  Where frequent pairs overlap the more frequent one is replaced, so
that a round replaces every pair that no more frequent one disturbs, and the next round counts what
is new.  A shard stores its rules, the expansion length of every nonterminal, the symbol sequence, and where each
document starts in symbols and in ids, so any document or id range is decoded without the rest.

File format of a shard (little-endian): magic ``MLG`` and the bytes of a symbol (``2``, ``3`` or ``4``, as many as
the symbols need); u32 counts: documents, rules, symbols, base (ids below it are terminals); doc_ids i64 (null
as the smallest i64); per document symbol starts u32 (one more than documents), id starts u64 (one more);
rules as pairs of symbols; expansion lengths u32; symbols.  Shards are rows of a Parquet table (shard long, part
long, before long, n_ids long, blob binary), so Spark's committer makes them safe to rewrite when an executor is lost, on
any file system; ``before`` counts the ids of earlier shards of the same part.

Defined results: a null or empty text has only the end id.  Null doc_ids come first.  Documents with equal
doc_id are ordered by xxhash64 of their text.  An empty table gives no shard.  Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, whole_text, written
from .tokens import default_path, encoder

END_ID = 0
SHARD_IDS = 1 << 19
#: A rule takes the room of four symbols (its pair and its length), so a pair pays from five occurrences on.
LEAST_COUNT = 5
NULL_ID = -(1 << 63)
SHARD_SCHEMA = "shard long, part long, before long, n_ids long, blob binary"
HALF, LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.uint64) << HALF | right


def _counted(at: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs sorted by pair and position, and where each distinct pair starts among them."""
    symbol, place = int(seq.max()).bit_length(), len(seq).bit_length()
    if 2 * symbol + place <= 64:  # one number holds pair and position
        packed = (seq[at].astype(np.uint64) << np.uint64(symbol) | seq[at + 1]) << np.uint64(place) | at.astype(np.uint64)
        packed.sort()
        at = (packed & np.uint64((1 << place) - 1)).astype(np.int64)
        pair = packed >> np.uint64(place)
    else:
        pair = _pairs(seq[at], seq[at + 1])
        order = np.argsort(pair, kind="stable")
        at, pair = at[order], pair[order]
    return at, np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))


def _without_overlaps(at: np.ndarray, seq: np.ndarray) -> np.ndarray:
    """Drops every other position in runs of one symbol, whose pairs overlap themselves."""
    same = np.flatnonzero(seq[at] == seq[at + 1])
    if not len(same):
        return at
    where, index = at[same], np.arange(len(same))
    run = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(where) != 1]), index, 0))
    return np.delete(at, same[(index - run) % 2 == 1])


def _chosen(rank: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to replace and their ranks: the higher rank wins where pairs overlap.  ``rank`` is used up."""
    won, ranks = [], []
    while len(at):
        many = 4 * len(at) > len(rank)
        if many:  # neighbours are compared where they stand
            wins = rank[:-1] > rank[1:]
            wins[1:] &= rank[1:-1] > rank[:-2]
            w = np.flatnonzero(wins)
        else:
            own = rank[at]
            wins = (own > rank[at - 1]) & (own > rank[at + 1])  # the last entry of rank is an empty one
            w = at[wins]
        won.append(w)
        ranks.append(rank[w])
        rank[w] = rank[w - 1] = rank[w + 1] = 0
        at = np.flatnonzero(rank) if many else at[rank[at] > 0]
    return np.concatenate(won), np.concatenate(ranks)


class _Rules:
    """The rules so far, found by their pair."""

    def __init__(self, base: int):
        self.made: list[np.ndarray] = []
        self.pair, self.symbol = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.top = base

    def of(self, pair: np.ndarray) -> np.ndarray:
        """The symbol of each pair, or -1."""
        if not len(self.pair):
            return np.full(len(pair), -1)
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        return np.where(self.pair[at] == pair, self.symbol[at], -1)

    def add(self, pair: np.ndarray) -> np.ndarray:
        symbol = self.top + np.arange(len(pair))
        self.made.append(np.stack([pair >> HALF, pair & LOW], axis=1).astype(np.uint32))
        pairs, symbols = np.concatenate([self.pair, pair]), np.concatenate([self.symbol, symbol])
        order = np.argsort(pairs)
        self.pair, self.symbol, self.top = pairs[order], symbols[order], self.top + len(pair)
        return symbol

    def table(self) -> np.ndarray:
        return np.concatenate(self.made) if self.made else np.empty((0, 2), np.uint32)


def repair(seq: np.ndarray, last: np.ndarray, base: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, their last-of-document marks, rules as pairs); no pair is left ``least`` times.

    A pair that is too rare stays so unless a new occurrence of its symbols is made, so each round looks only at pairs
    that were frequent and at those beside new symbols.
    """
    rules = _Rules(base)
    live = np.ones(len(seq), bool)
    while len(seq) > 1:
        at = _without_overlaps(np.flatnonzero(live[:-1] & ~last[:-1]), seq)
        if not len(at):
            break
        at, starts = _counted(at, seq)
        n = np.diff(np.append(starts, len(at)))
        pair = _pairs(seq[at[starts]], seq[at[starts] + 1])
        frequent = (n >= least) | (rules.of(pair) >= 0)
        each = np.repeat(frequent, n)
        live[at[~each]] = False
        pair, n, at = pair[frequent], n[frequent], at[each]
        if not len(pair):
            break
        rank = np.zeros(len(seq) + 1, np.int32)
        by_rank = np.lexsort((pair, -n))[::-1]  # ranks count from 1
        number = np.empty(len(pair), np.int32)
        number[by_rank] = np.arange(1, len(pair) + 1, dtype=np.int32)
        rank[at] = np.repeat(number, n)
        at, found = _chosen(rank, np.flatnonzero(rank))
        which = by_rank[found - 1]
        symbol = rules.of(pair)
        known = symbol >= 0
        new = np.flatnonzero((np.bincount(which, minlength=len(pair)) >= least) & ~known)
        new = new[np.argsort(-n[new], kind="stable")]
        symbol[new] = rules.add(pair[new])
        made = symbol[which]
        at, made = at[made >= 0], made[made >= 0]
        seq[at], last[at] = made, last[at + 1]
        live[at] = live[np.maximum(at - 1, 0)] = True
        if known.any():  # more of a symbol that was there before
            more = np.zeros(rules.top, bool)
            more[symbol[known]] = True
            beside = np.flatnonzero(more[seq])
            live[beside] = live[np.maximum(beside - 1, 0)] = True
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last, live = seq[keep], last[keep], live[keep]
    return seq, last, rules.table()


def _put(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u4").reshape(-1, 1).view(np.uint8)[:, :width].tobytes()


def compress(ids: np.ndarray, lengths: np.ndarray, doc_ids: np.ndarray, least: int = LEAST_COUNT) -> bytes:
    """The shard of documents whose ids are concatenated in ``ids``."""
    base = int(ids.max()) + 1 if len(ids) else 1
    last = np.zeros(len(ids), bool)
    ends = np.cumsum(lengths)
    last[ends - 1] = True
    seq, last, table = repair(ids.astype(np.uint32), last, base, least)
    width = 2 if base + len(table) <= 1 << 16 else 3 if base + len(table) <= 1 << 24 else 4
    firsts = np.concatenate([[0], np.flatnonzero(last) + 1])
    parts = [
        b"MLG%d" % width,
        struct.pack("<4I", len(lengths), len(table), len(seq), base),
        doc_ids.astype("<i8").tobytes(),
        firsts.astype("<u4").tobytes(),
        np.concatenate([[0], ends]).astype("<u8").tobytes(),
        _put(table, width),
        _lengths(table, base).astype("<u4").tobytes(),
        _put(seq, width),
    ]
    return b"".join(parts)


def _lengths(table: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of each rule, which refers to earlier symbols only."""
    size = np.concatenate([np.ones(base, np.int64), np.zeros(len(table), np.int64)])
    open_ = np.arange(len(table))
    while len(open_):  # once a level of the grammar
        x, y = size[table[open_, 0]], size[table[open_, 1]]
        told = (x > 0) & (y > 0)
        size[base + open_[told]] = (x + y)[told]
        open_ = open_[~told]
    return size[base:]


class Shard:
    """Reads a shard; ``ids(k)`` decodes one document, ``span(start, end)`` any range of ids."""

    def __init__(self, blob: bytes):
        width = int(blob[3:4])
        n, rules, symbols, self.base = struct.unpack_from("<4I", blob, 4)
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(blob, kind, count, at)
            at += found.nbytes
            return found

        def take_symbols(count: int) -> np.ndarray:
            out = np.zeros((count, 4), np.uint8)
            out[:, :width] = take("u1", count * width).reshape(-1, width)
            return out.view("<u4").ravel()

        self.doc_ids, self.firsts, self.starts = take("<i8", n), take("<u4", n + 1), take("<u8", n + 1).astype(np.int64)
        self.rules = take_symbols(2 * rules).reshape(-1, 2)
        self.size = np.concatenate([np.ones(self.base, np.int64), take("<u4", rules)])
        self.seq = take_symbols(symbols)
        self._ends: np.ndarray | None = None
        self._written: np.ndarray | None = None

    def _written_out(self) -> np.ndarray:
        """The ids of every symbol, one after the other: terminals, then rules."""
        if self._written is None:
            out: list[bytes] = []
            one = lambda x: out[x - self.base] if x >= self.base else x.to_bytes(4, "little")
            for x, y in self.rules.tolist():
                out.append(one(x) + one(y))
            self._written = np.concatenate([np.arange(self.base, dtype=np.uint32), np.frombuffer(b"".join(out), "<u4")])
            self._from = np.cumsum(self.size) - self.size
        return self._written

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        written_out = self._written_out()
        size = self.size[symbols]
        ends = np.cumsum(size)
        if not len(ends):
            return np.empty(0, np.uint32)
        return written_out[np.repeat(self._from[symbols] - (ends - size), size) + np.arange(int(ends[-1]))]

    def ids(self, k: int) -> np.ndarray:
        return self._expand(self.seq[self.firsts[k] : self.firsts[k + 1]])

    def span(self, start: int, end: int) -> np.ndarray:
        """Ids start..end of the shard, found by the stored expansion lengths."""
        if self._ends is None:
            self._ends = np.cumsum(self.size[self.seq])
        a, b = np.searchsorted(self._ends, start, "right"), np.searchsorted(self._ends, end, "left") + 1
        before = int(self._ends[a - 1]) if a else 0
        return self._expand(self.seq[a:b])[start - before : end - before]

    def all(self) -> np.ndarray:
        return self._expand(self.seq)


def shards(docs: DataFrame, path: str | None = None, text: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """(shard, part, before, n_ids, blob) of all documents in ascending doc_id order; ``shard`` rises with doc_id."""
    small_batches(docs.sparkSession)
    path = path or default_path("byte_bpe_50k.json")
    value = whole_text(text)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        to_ids, end = encoder(path), struct.pack("<I", end_id)
        part, made, before = TaskContext.get().partitionId(), 0, 0
        packed: list[bytes] = []
        names: list[int] = []
        held = 0

        def flush():
            nonlocal packed, names, held, made, before
            lengths = np.array([len(p) // 4 for p in packed], np.int64)
            blob = compress(np.frombuffer(b"".join(packed), "<u4"), lengths, np.array(names, np.int64))
            numbers = [pa.array([x], pa.int64()) for x in ((part << 32) + made, part, before, held)]
            row = pa.RecordBatch.from_arrays([*numbers, pa.array([blob], pa.binary())], names=["shard", "part", "before", "n_ids", "blob"])
            packed, names, held, made, before = [], [], 0, made + 1, before + held
            return row

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), to_ids.encode(batch.column(1).to_pylist()), strict=True):
                packed.append(ids + end)
                names.append(NULL_ID if name is None else name)
                held += len(ids) // 4 + 1
                if held >= shard_ids:
                    yield flush()
        if packed:
            yield flush()

    return ordered.mapInArrow(encode, SHARD_SCHEMA)


def write_shards(docs: DataFrame, out: str, **options) -> None:
    """Writes the shard table to a new folder."""
    shards(docs, **options).write.parquet(out)


def read_documents(table: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) decoded from a shard table; start counts ids before it."""
    # One row a range partition, so their running total is a small table; the blobs stay where they are.
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("held"))
    earlier = parts.select(F.col("part").alias("__part"), (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("earlier"))
    placed = table.join(F.broadcast(earlier), F.col("part") == F.col("__part")).select("blob", (F.col("before") + F.col("earlier")).alias("at"))

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            for blob, at in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                shard = Shard(blob.as_py())
                ids = shard.all().astype("<u4").tobytes()
                starts = shard.starts
                for lo in range(0, len(shard.doc_ids), 2000):
                    hi = min(lo + 2000, len(shard.doc_ids))
                    names = [None if x == NULL_ID else x for x in shard.doc_ids[lo:hi].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, pa.int64()),
                            pa.array(starts[lo:hi] + at, pa.int64()),
                            pa.array(np.diff(starts[lo : hi + 1]), pa.int64()),
                            pa.array([ids[4 * s : 4 * e] for s, e in zip(starts[lo:hi].tolist(), starts[lo + 1 : hi + 1].tolist(), strict=True)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Writes the shards of ``docs`` to the shared folder and reads every document back."""
    return read_documents(written(shards(docs, **options), "grammar-ids"))


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
