"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The documents are read once for their n-grams and once for the alignment, however large the benchmark is:

1. The word n-grams of all items are hashed into a bit set of at most ``MOST_BITS`` bits, which is sent to the executors.
2. One pass over the documents keeps the n-grams that the bit set knows.  An equi-join with the items' n-grams counts
   the documents that hold each one, over all documents; what the bit set let through by chance is gone then.
3. Seeds of an item: all its rare n-grams (in at most ``RARE_SHARE`` of the documents or ``RARE_DOCS``), and
   the rarest n-gram of each stretch of ``STRETCH`` n-grams, so that an item that is copied everywhere keeps
   seeds too.
4. An equi-join of kept n-grams and seeds gives each document the items to align with, and where.  They are aligned word
   by word around those places (match 2, mismatch and gap -1).  A pair is reported when the best local score reaches
   ``share`` of the item's own and at least ``MIN_MATCHED`` words match (all of a shorter item's).

Words are runs of letters and digits, lower-cased.  Defined results: null texts have no words and match
nothing; items of fewer than ``N`` words form no n-gram and match nothing; rows with a null doc_id are
reported with a null doc_id; repeated documents or items (same id, same text) give one row each pair of
ids; an empty benchmark or table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, kept, rows_without, small_batches, whole_text, written

N, STRETCH = 3, 4
RARE_DOCS, RARE_SHARE = 20, 1e-5
SCORE, MIN_MATCHED = 0.5, 8
#: Bits for each n-gram of the benchmark, and the bound of the set (16 MB); beyond, it lets more through.
BITS_EACH, MOST_BITS = 32, 1 << 27
MATCH, MISS, GAP = 2, -1, -1
WORD = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
PAIR_SCHEMA = "doc_id long, item_id long, score double, matched long, start_word long, end_word long"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Hashes:
    """64-bit hashes of words, the same in every process; the table of known words is bounded."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def of(self, words: list[str]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            for k, h in enumerate(found):
                if h is None:
                    found[k] = known[words[k]] = xxh64_intdigest(words[k].encode("utf-8", "surrogatepass"), 3)
        return np.array(found, np.uint64)


def gram_hashes(words: list[str]) -> np.ndarray:
    """A hash of each n-gram of a text, by start."""
    n = len(words) - N + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, out = kept("benchmark words", Hashes).of(words), np.zeros(n, np.uint64)
    for k in range(N):
        out = (out ^ h[k : k + n]) * MIX
        out ^= out >> np.uint64(31)
    return out


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, first and last word of the region that it covers, end exclusive)."""
    m = len(region)
    score, start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    steps = np.arange(m + 1)
    best, span = 0, (0, 0)
    for w in item:
        hit = np.where(region == w, MATCH, MISS)
        diagonal, from_diagonal = score[:-1] + hit, start[:-1]
        up = score[1:] + GAP
        top = np.concatenate([[0], np.maximum(np.maximum(diagonal, up), 0)])
        begin = np.concatenate([[0], np.where(diagonal >= up, from_diagonal, start[1:])])
        begin = np.where(top == 0, steps, begin)
        # Gaps along the region: the best of what stands to the left, less its distance.
        lifted = top - GAP * steps
        peak = np.maximum.accumulate(lifted)
        at = np.maximum.accumulate(np.where(lifted == peak, steps, 0))
        score, start = peak + GAP * steps, begin[at]
        k = int(score.argmax())
        if score[k] > best:
            best, span = int(score[k]), (int(start[k]), k)
    return best, span[0], span[1]


def item_grams(items: DataFrame) -> DataFrame:
    """(gram, item, place): the n-grams of every item (item, text)."""

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            grams = [gram_hashes(words_of(t)) for t in batch.column(1).to_pylist()]
            sizes = [len(g) for g in grams]
            columns = [np.concatenate([x, *y]) for x, y in ((np.empty(0, np.int64), [g.view(np.int64) for g in grams]), (np.empty(0, np.int64), [np.repeat(np.asarray(batch.column(0)), sizes)]), (np.empty(0, np.int32), [np.arange(n, dtype=np.int32) for n in sizes]))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "item", "place"])

    return items.select("item", "text").mapInArrow(cut, "gram long, item long, place int")


def bit_set(grams: DataFrame) -> np.ndarray:
    """The bits of all n-grams, as bytes; at most ``MOST_BITS`` of them."""
    n = max(1, grams.select("gram").distinct().count())
    bits = min(MOST_BITS, 1 << (BITS_EACH * n - 1).bit_length())
    bit = F.shiftrightunsigned("gram", 65 - bits.bit_length())
    words = grams.select(bit.alias("bit")).groupBy((F.col("bit") / 64).cast("long").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("set"))
    found = words.toArrow()  # at most MOST_BITS / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("set").to_numpy()
    return out.view(np.uint8)


def known_grams(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """(doc_id, th, gram, place): the n-grams of all documents (doc_id, th, text) that the bit set knows."""
    table = rows.sparkSession.sparkContext.broadcast(bits)
    shift = np.uint64(65 - (8 * len(bits)).bit_length())

    def find(batches):
        import pyarrow as pa

        known = table.value
        for batch in batches:
            grams, places = [], []
            for t in batch.column(2).to_pylist():
                g = gram_hashes(words_of(t))
                bit = g >> shift
                p = np.flatnonzero(known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                grams.append(g[p].view(np.int64))
                places.append(p.astype(np.int32))
            of = pa.array(np.repeat(np.arange(len(places)), [len(p) for p in places]))
            columns = [batch.column(0).take(of), batch.column(1).take(of), pa.array(np.concatenate([np.empty(0, np.int64), *grams])), pa.array(np.concatenate([np.empty(0, np.int32), *places]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "gram", "place"])

    return rows.select("doc_id", "th", "text").mapInArrow(find, "doc_id long, th long, gram long, place int")


def seeds_of(grams: DataFrame, hits: DataFrame, rare: int) -> DataFrame:
    """(gram, item): the seeds of every item, by the number of documents that hold its n-grams."""
    # A document counts once; partial aggregation leaves one row a task and n-gram.
    held = hits.dropDuplicates(["doc_id", "th", "gram"]).groupBy("gram").agg(F.count("*").alias("n"))
    counted = grams.join(held, "gram", "left").select("gram", "item", "place", F.coalesce("n", F.lit(0)).alias("n"))
    stretch = F.floor(F.col("place") / STRETCH)
    rarest = counted.groupBy("item", stretch.alias("stretch")).agg(F.min_by("gram", F.struct("n", "place")).alias("gram"))
    return counted.filter(F.col("n") <= rare).select("gram", "item").union(rarest.select("gram", "item")).distinct()


def candidates(hits: DataFrame, seeds: DataFrame, items: DataFrame) -> DataFrame:
    """(cand_id, cand_th, found): per document the items that share seeds, with their text and the places."""
    pairs = hits.join(seeds, "gram").groupBy("doc_id", "th", "item").agg(F.sort_array(F.collect_set("place")).alias("places"))
    pairs = pairs.join(items, "item").groupBy(F.col("doc_id").alias("cand_id"), F.col("th").alias("cand_th"))
    return pairs.agg(F.collect_list(F.struct("item_id", F.col("text").alias("item_text"), "places")).alias("found"))


def best_place(own: np.ndarray, doc: np.ndarray, places: np.ndarray, share: float) -> tuple[int, int, int]:
    """The best alignment of an item with a document around the places of its seeds: (score, start, end)."""
    reach, best = 2 * len(own), (0, 0, 0)
    for part in np.split(places, np.flatnonzero(np.diff(places) > reach) + 1):
        lo, hi = max(0, int(part[0]) - reach), min(len(doc), int(part[-1]) + reach)
        region = doc[lo:hi]
        # No alignment scores more than the words both have.
        if np.isin(own, region).sum() < share * len(own):
            continue
        s, x, y = align(own, region)
        if s > best[0]:
            best = (s, lo + x, lo + y)
    return best


def aligned(rows: DataFrame, found: DataFrame, share: float) -> DataFrame:
    """The reported pairs of documents and their candidate items, see ``PAIR_SCHEMA``."""
    own = (F.col("th") == F.col("cand_th")) & F.col("doc_id").eqNullSafe(F.col("cand_id"))
    joined = rows.join(found.hint("shuffle_hash"), own).select("doc_id", "text", "found")

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for name, text, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers: dict[str, int] = {}
                doc = np.array([numbers.setdefault(w, len(numbers)) for w in words_of(text)], np.int64)
                for item in items:
                    coded = np.array([numbers.setdefault(w, len(numbers)) for w in words_of(item["item_text"])], np.int64)
                    s, x, y = best_place(coded, doc, np.array(item["places"], np.int64), share)
                    matched = int(np.isin(coded, doc[x:y]).sum())
                    if s and s >= share * MATCH * len(coded) and matched >= min(MIN_MATCHED, len(coded)):
                        out.append((name, item["item_id"], s / (MATCH * len(coded)), matched, x, y))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "item_id", "score", "matched", "start_word", "end_word"])

    return joined.mapInArrow(score, PAIR_SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: float = SCORE) -> DataFrame:
    """(doc_id, item_id, score, matched, start_word, end_word): one row for each leaked pair, its best place."""
    small_batches(docs.sparkSession)
    value = whole_text(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("text"), F.xxhash64(value).alias("th"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    grams = written(item_grams(items), "item-grams")
    hits = written(known_grams(rows, bit_set(grams)).join(grams.select("gram").distinct(), "gram", "left_semi"), "gram-hits")
    seeds = written(seeds_of(grams, hits, max(RARE_DOCS, int(RARE_SHARE * docs.count()))), "gram-seeds")
    found = written(candidates(hits, seeds, items), "leak-candidates")
    discard(grams, hits, seeds)
    # Repeated rows give the same pair again; the best row stays.
    best = F.max(F.struct("score", "matched", F.negative("start_word").alias("s"), "end_word")).alias("m")
    return aligned(rows, found, share).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.score", "m.matched", (-F.col("m.s")).alias("start_word"), "m.end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns; rows with a null doc_id stay."""
    leaked = contaminated(docs, benchmark, text).filter("doc_id is not null").select("doc_id").distinct()
    return rows_without(docs, leaked, F.col("doc_id").cast("long"))
