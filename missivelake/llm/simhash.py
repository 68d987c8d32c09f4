"""SimHash near-duplicates with deletion-variant signatures.

Fingerprints link at ``2`` or fewer differing bits.  A fingerprint is cut into two segments, so that of a
linked pair one segment differs by at most one bit; each segment is indexed once per wildcard position.
Linked fingerprints share such a key, so an equality join finds them all, and each candidate pair is
verified.  Only distinct fingerprints are indexed.

A key that more than ``MAX_PAIRED`` fingerprints share is not paired: its members are indexed again by the
other segment, cut in two in the same way, and so on down to four remaining bits, where a key has no more
than 256 possible members.  A linked pair that shares a key also shares a key one level down, so nothing
is lost and no level pairs an unbounded group.

Defined results: a null text is empty; texts without words have fingerprint zero and link like any other.
Rows with a null doc_id take part; ids in component_id ignore null unless the whole component has none.
Repeated rows share their result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, is_empty, rows_without, small_batches, spread, whole_text, written
from .components import components

WORDS, SEED, DISTANCE = 3, 42, 2
MAX_PAIRED = 64
#: Bits of the remaining segment at each level; its halves are indexed with one wildcard.
LEVELS = (64, 32, 16, 8)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of every shingle of a text, in order, repeats included."""
    import re

    from xxhash import xxh64_intdigest

    found = re.findall(rb"[^\x20\x09-\x0D]+", text.translate(str.maketrans(UPPER, LOWER)).encode("utf-8", "surrogatepass"))
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    lo = [0, *ends[: len(found) - words].tolist()]
    hi = (ends[words - 1 :] - 1).tolist()
    return np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(lo, hi)], np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The signed 64-bit fingerprint: a bit is set if more than half of the hashes have it."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp bigint) for every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))

    def compute(batches):
        import pyarrow as pa

        for batch in batches:
            found = [fingerprint_of(shingle_hashes(t, words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return rows.mapInArrow(compute, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _variants(members: DataFrame, bits: int) -> DataFrame:
    """(fp, key, low): the keys of one level.  ``low`` is the lowest bit of the segment left over.

    members: (fp, path, low); their segment of ``bits`` bits from ``low`` on is cut in two.
    """
    half = bits // 2

    def keys(which: int) -> Column:
        """Variants of one half; the other half is what is left."""
        start = F.col("low") + which * half
        segment = F.expr(f"shiftright(fp, cast(low + {which * half} as int))").bitwiseAND(F.lit((1 << half) - 1))
        left = F.col("low") + (1 - which) * half
        return F.transform(
            F.sequence(F.lit(0), F.lit(half - 1)),
            lambda i: F.struct((start + i).cast("int").alias("wild"), left.cast("int").alias("left"), segment.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("masked")),
        )

    spread = members.select("fp", "path", F.explode(F.concat(keys(0), keys(1))).alias("k"))
    # The path stands for every earlier key.  Keys are hashes: a collision only adds a candidate to verify.
    return spread.select("fp", F.xxhash64("path", "k.wild", "k.masked").alias("key"), F.col("k.left").alias("low"))


def _close(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def links(fps: DataFrame, distance: int = DISTANCE, max_paired: int = MAX_PAIRED) -> DataFrame:
    """(a, b) with a < b: pairs of distinct fingerprints that link.  A pair may appear more than once."""
    if distance > 2:
        raise ValueError("two segments find pairs of at most two differing bits")
    # The few bytes of all fingerprints come in few files; their many keys are made by every core.
    members = spread(fps, "fp").select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).alias("low"))
    found: list[DataFrame] = []
    tables: list[DataFrame] = []
    for level, bits in enumerate(LEVELS):
        keyed = _variants(members, bits)
        same = ["key"]
        sizes = keyed.groupBy(*same).agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
        sizes = written(sizes, "keys")
        tables.append(sizes)
        two = sizes.filter("n = 2").filter(_close(F.col("a"), F.col("b"), distance)).select("a", "b")
        last = level == len(LEVELS) - 1
        some = sizes.filter("n > 2") if last else sizes.filter(f"n > 2 and n <= {max_paired}")
        # Shuffled at every size: the members of all keys are too many to be read past a broadcast table of keys.
        grouped = keyed.join(some.select(*same).hint("shuffle_hash"), same).groupBy(*same).agg(F.sort_array(F.collect_list("fp")).alias("all"))
        pairs = F.flatten(
            F.transform(
                F.col("all"),
                lambda x, i: F.transform(F.filter(F.slice(F.col("all"), i + 2, F.size("all")), lambda y: _close(x, y, distance)), lambda y: F.struct(x.alias("a"), y.alias("b"))),
            )
        )
        more = grouped.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
        found += [two, more]
        if last:
            break
        hot = sizes.filter(f"n > {max_paired}").select(*same)
        if is_empty(hot):
            break
        members = written(keyed.join(hot, same).select("fp", F.col("key").alias("path"), "low"), "members")
        tables.append(members)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    out = written(out, "links")
    discard(*tables)
    return out


def near_dedup(docs: DataFrame, text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links."""
    prints = written(fingerprints(docs, text, words), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = written(classes, "classes")
    linked = links(classes.select("fp"), distance)
    joined = components(linked).withColumnRenamed("node", "fp")
    discard(linked)
    # A class without links is its own component.
    of = classes.join(joined, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = of.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = written(of.join(smallest, "component").select("fp", "component_id"), "components")
    discard(classes)
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all their columns.

    Rows with a null doc_id stay: nothing names them.
    """
    dropped = near_dedup(docs, text, words, distance).filter("doc_id <> component_id").select("doc_id").distinct()
    return rows_without(docs, dropped, F.col("doc_id").cast("long"))
