"""Near copies by SimHash signatures, completed by an exact similarity join on word shingles.

Every pair of documents whose shingle sets have at least the stated Jaccard similarity counts as an edge, and no other
pair does; components of edges are groups.

1. One pass gives each text a 128-bit hash of its shingle set, its 64-bit SimHash over the set, the number of shingles in
   each of ``BUCKETS`` hash ranges, and its first shingles.
2. Deletion-variant signatures (``simhash.links``) find the fingerprints of at most two differing bits.  These texts are
   verified on their whole sets; most near copies are connected here.
3. At a similarity of 0.8 some fifteen percent of the bits differ, which no selective signature finds surely.  So the
   join goes on among the texts that are not connected yet.  Shingles are put in one order, rare ones
   first.  Two sets of the similarity share a shingle among the first few of each (prefix filter), and the rank of the
   first one they share bounds what they can have in common (positional filter), so an equality join on first shingles
   finds every pair.  What two sets have in common is at most the sum of the smaller counts by hash range; pairs below
   the similarity by that bound go before any set is moved.  The others are verified on their whole sets.

The order only decides the cost: shingles common in a sample of documents come last, so that a passage which many
documents share is not among their first shingles.  Any order gives the same edges.

Only components are needed, so connected pairs are not compared again.  The members of a large key are compared
with a few of them first; those that are not connected by then meet in blocks of bounded size, which give only the pairs
that can have the similarity by their counts.

Defined results: A-Z are lower-cased; texts of fewer words than a shingle are one shingle; texts without words are alike.
Shingles are compared as 64-bit hashes and equal sets as 128-bit hashes.  Rows with a null doc_id stay; repeated rows share
a verdict.  Columns named like the operator's own are neither read nor changed.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, is_empty, kept, rows_without, sent, small_batches, whole_text, written
from .components import components
from .simhash import fingerprint_of, links
from .substring_dedup import MIX1, WordHashes, rolled, words_of

WORDS, SIMILARITY = 5, 0.8
#: One of so many documents is counted for the order; shingles of LEAST_SAMPLED of them are common, of which MOST_COMMON are told apart.
SAMPLE, LEAST_SAMPLED, MOST_COMMON = 16, 6, 100_000
#: Keys of more than PAIRED members are large: all others are compared with STARS members first, then in blocks of about BLOCK members.
PAIRED, BLOCK, STARS = 64, 512, 3
#: Rounds in which only the likeliest pair of every two components is verified; then all that are left.
LIKELY = 1
#: Hash ranges whose counts bound what two sets have in common.
BUCKETS = 256
LOWERED = str.maketrans(UPPER, LOWER)
MOST_WORDS = 200_000

def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    w = kept("near words", lambda: WordHashes(MOST_WORDS)).of(words_of(text.translate(LOWERED)))
    return np.unique(rolled(w, min(words, len(w)), MIX1)) if len(w) else np.empty(0, np.uint64)


def _rows(docs: DataFrame, text: str) -> DataFrame:
    return docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("node"), whole_text(text).alias("text"))


def common_shingles(rows: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, levels): the most common shingles of a sample; the level grows with their number."""

    def compute(batches):
        import pyarrow as pa

        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, words).view("<i8"))], names=["h"])

    sample = rows.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(compute, "h long")
    counts = sample.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_SAMPLED)
    found = counts.orderBy(F.desc("n"), "h").limit(MOST_COMMON).toArrow()  # bounded
    h = found.column("h").to_numpy().view(np.uint64)
    n = found.column("n").to_numpy()
    at = np.argsort(h)
    return h[at], np.log2(np.maximum(n[at], 1)).astype(np.uint8) + np.uint8(1)


def _counts(s: np.ndarray) -> bytes:
    n = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=BUCKETS)
    return n.astype("u1" if n.max() < 256 else "<u4").tobytes()


def _first(s: np.ndarray, common: tuple[np.ndarray, np.ndarray], num: int, den: int) -> np.ndarray:
    """The first shingles of a set: as many as a set of the similarity cannot miss altogether."""
    n, (hot, levels) = len(s), common
    if not n:
        return s
    level = np.zeros(n, np.uint8)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        level = np.where(hot[at] == s, levels[at], 0)
    return s[np.argsort(level, kind="stable")][: n - -(-num * n // den) + 1]


def prints_of(rows: DataFrame, words: int, similarity: Fraction, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(node, h1, h2, fp, size, counts, firsts): what is kept of each text."""
    table = rows.sparkSession.sparkContext.broadcast(common)  # at most MOST_COMMON entries
    num, den = similarity.numerator, similarity.denominator

    def compute(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            digests, fps, sizes, counts, firsts = [], [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingle_set(t, words)
                digests.append(xxh3_128_digest(s.tobytes()))
                fps.append(fingerprint_of(s))
                sizes.append(len(s))
                counts.append(_counts(s))
                firsts.append(_first(s, table.value, num, den).view("<i8"))
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            ends = np.cumsum([0, *map(len, firsts)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(firsts) if firsts else np.empty(0, np.int64)))
            columns = [batch.column(0), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(fps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(counts, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "h1", "h2", "fp", "size", "counts", "firsts"])

    return rows.mapInArrow(compute, "node long, h1 long, h2 long, fp long, size int, counts binary, firsts array<long>")


def first_shingles(prints: DataFrame, similarity: Fraction) -> DataFrame:
    """(key, node, size, most): ``most`` is the largest size of a set that can reach the similarity if the key is the
    first shingle that both share."""
    num, den = similarity.numerator, similarity.denominator
    most = F.floor((F.col("size") - F.col("pos")) * (num + den) / num).cast("int") - F.col("size")
    return prints.select("node", "size", F.posexplode("firsts").alias("pos", "key")).select("key", "node", "size", most.alias("most"))


def shared_keys(firsts: DataFrame) -> DataFrame:
    """(key, node, size, most, n): members of keys that can have a partner in them; n members a key."""
    sizes = written(firsts.groupBy("key").agg(F.min("size").alias("least"), F.max("most").alias("top"), F.count("*").alias("n")).filter("n > 1 and least <= top"), "near-keys")
    able = firsts.join(sizes.select("key", "least", "top").hint("shuffle_hash"), "key").filter("most >= least and size <= top").select("key", "node", "size", "most")
    able = written(able, "near-able")
    counted = able.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(able.join(counted.hint("shuffle_hash"), "key"), "near-members")
    discard(sizes, able)
    return members


def _common_at_most(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """The sums of the smaller counts by hash range."""
    out = np.empty(len(x), np.int64)
    short = np.array([len(a) == len(b) == BUCKETS for a, b in zip(x, y, strict=True)], bool)
    at = np.flatnonzero(short)
    if len(at):
        one = np.frombuffer(b"".join([x[k] for k in at]), np.uint8).reshape(-1, BUCKETS)
        two = np.frombuffer(b"".join([y[k] for k in at]), np.uint8).reshape(-1, BUCKETS)
        out[at] = np.minimum(one, two).sum(1, dtype=np.int64)
    wide = lambda b: np.frombuffer(b, "u1" if len(b) == BUCKETS else "<u4").astype(np.int64)
    for k in np.flatnonzero(~short).tolist():
        out[k] = np.minimum(wide(x[k]), wide(y[k])).sum()
    return out


def possible(pairs: DataFrame, prints: DataFrame, similarity: Fraction) -> DataFrame:
    """The distinct pairs (a, b) that can have the similarity by the counts of their sets."""
    num, den = similarity.numerator, similarity.denominator

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            m, n = (np.asarray(batch.column(k)).astype(np.int64) for k in (2, 3))
            top = _common_at_most(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array(top * (num + den) >= num * (m + n), pa.bool_()))

    left = pairs.distinct().join(prints.select(F.col("node").alias("a"), F.col("size").alias("m"), F.col("counts").alias("x")), "a")
    both = left.join(prints.select(F.col("node").alias("b"), F.col("size").alias("n"), F.col("counts").alias("y")), "b")
    return written(both.select("a", "b", "m", "n", "x", "y").mapInArrow(judge, "a long, b long").distinct(), "near-pairs")


def verified(pairs: DataFrame, rows: DataFrame, words: int, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""
    num, den = similarity.numerator, similarity.denominator

    def sets_of(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, words).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["node", "s"])

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                ok.append(int((both[1:] == both[:-1]).sum()) * (num + den) >= num * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # The few ids go to the texts, which stay where they are.
    nodes = written(pairs.select(F.col("a").alias("__n")).union(pairs.select("b")).distinct(), "near-nodes")
    sets = written(rows.join(sent(nodes), F.col("node") == F.col("__n"), "left_semi").mapInArrow(sets_of, "node long, s binary"), "near-sets")
    left = sent(pairs).join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y")
    edges = written(both.mapInArrow(judge, "a long, b long").distinct(), "near-edges")
    discard(sets, nodes)
    return edges


def signature_pairs(prints: DataFrame) -> DataFrame:
    """(a, b): each node with the least of its fingerprint, and the least of fingerprints that link."""
    classes = written(prints.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n")), "near-classes")
    alike = prints.join(classes.filter("n > 1").select("fp", "least"), "fp").filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    linked = links(classes.select("fp")).distinct()
    ids = lambda fp, name: classes.select(F.col("fp").alias(fp), F.col("least").alias(name))
    linked = linked.withColumnsRenamed({"a": "f", "b": "g"}).join(ids("f", "a"), "f").join(ids("g", "b"), "g")
    return alike.union(linked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _labelled(members: DataFrame, of: DataFrame) -> DataFrame:
    """``members`` with their component, by ``of``, as label; of the keys that are not yet all in one component."""
    told = members.join(of, "node", "left").select("key", "node", "size", "most", "n", F.coalesce("component", "node").alias("label"))
    told = written(told, "near-labelled")
    mixed = told.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    return told.join(mixed.hint("shuffle_hash"), "key")


def _star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each member with ``STARS`` members of its key, where they are not connected."""
    stars = [F.min_by(F.struct("node", "size", "most", "label"), F.xxhash64("node", F.lit(k))) for k in range(STARS)]
    stars = written(members.groupBy("key").agg(F.array_distinct(F.array(*stars)).alias("stars")), "near-stars")
    found = members.join(stars.hint("shuffle_hash"), "key").withColumn("p", F.explode("stars")).filter("label <> p.label and size <= p.most and p.size <= most")
    return found.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b"))


def _alike(x: Column, y: Column) -> Column:
    """Whether two members have different labels and pass the positional filter."""
    return (x["label"] != y["label"]) & (x["size"] <= y["most"]) & (y["size"] <= x["most"])


def _small_pairs(members: DataFrame) -> DataFrame:
    """(a, b): every two members of a small key that have different labels and pass the positional filter."""
    groups = members.groupBy("key").agg(F.collect_list(F.struct("node", "size", "most", "label")).alias("all"))
    pair = lambda x, y: F.struct(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b"))
    pairs = F.flatten(F.transform("all", lambda x, k: F.transform(F.filter(F.slice(F.col("all"), k + 2, F.size("all")), lambda y: _alike(x, y)), lambda y: pair(x, y))))
    return groups.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def _block_pairs(members: DataFrame, prints: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b, top): the pairs of members of large keys, as for small keys, that can have the similarity by their
    counts; top is how many shingles they can share."""
    num, den = similarity.numerator, similarity.denominator
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = members.join(prints.select("node", "counts").hint("shuffle_hash"), "node").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    # A block meets every block of its key, itself too.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "size", "most", "label", "counts")

    def compare(table):
        import pyarrow as pa

        j, own, node, size, most, label = (table.column(c).to_numpy().astype(np.int64) for c in ("j", "own", "node", "size", "most", "label"))
        packed = table.column("counts").to_pylist()
        wide = max(map(len, packed)) > BUCKETS
        counts = np.stack([np.frombuffer(b, "u1" if len(b) == BUCKETS else "<u4").astype("<u4" if wide else "u1") for b in packed])
        last = np.flatnonzero(own == j)
        left, right, shared = [], [], []
        for k in range(len(node)):
            if own[k] == j[k]:  # within the block: each pair once
                to = last[last > k] if table.column("i")[k].as_py() == j[k] else last[:0]
            else:
                to = last
            to = to[(label[to] != label[k]) & (size[to] <= most[k]) & (most[to] >= size[k])]
            if len(to):
                top = np.minimum(counts[to], counts[k]).sum(1, dtype=np.int64)
                can = top * (num + den) >= num * (size[to] + size[k])
                to = to[can]
                shared.append(top[can])
                left.append(np.minimum(node[to], node[k]))
                right.append(np.maximum(node[to], node[k]))
        columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right, shared)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=["a", "b", "top"])

    return placed.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long, top long").distinct()


def _apart(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """The pairs whose nodes are not connected yet, with their components by ``of``."""
    told = pairs.join(of.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(of.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    ends = [F.coalesce("ca", "a"), F.coalesce("cb", "b")]
    told = told.select("a", "b", "top", F.least(*ends).alias("ca"), F.greatest(*ends).alias("cb")).filter("ca < cb")
    return written(told, "near-apart")


def edges_of(rows: DataFrame, prints: DataFrame, words: int, similarity: Fraction) -> DataFrame:
    """(a, b): similar pairs that connect what all similar pairs connect."""
    alike = possible(signature_pairs(prints), prints, similarity)
    edges = verified(alike, rows, words, similarity)
    members = shared_keys(first_shingles(prints, similarity))
    labelled = _labelled(members, components(edges))
    large = labelled.filter(f"n > {PAIRED}")
    pairs = possible(_small_pairs(labelled.filter(f"n <= {PAIRED}")).union(_star_pairs(large)), prints, similarity)
    edges = written(edges.union(verified(pairs, rows, words, similarity)), "near-edges")
    if not is_empty(large):
        of = components(edges)
        rest = written(_block_pairs(_labelled(members.filter(f"n > {PAIRED}"), of), prints, similarity).join(sent(pairs), ["a", "b"], "left_anti"), "near-pairs")
        for _ in range(LIKELY):  # the likeliest pair of every two components
            apart = _apart(rest, of)
            likely = written(apart.groupBy("ca", "cb").agg(F.max_by(F.struct("a", "b"), F.struct("top", "a", "b")).alias("p")).select("p.a", "p.b"), "near-pairs")
            edges = written(edges.union(verified(likely, rows, words, similarity)), "near-edges")
            of = components(edges)
            before, rest = rest, written(apart.select("a", "b", "top").join(sent(likely), ["a", "b"], "left_anti"), "near-pairs")
            discard(before, apart, likely)
        edges = edges.union(verified(_apart(rest, of).select("a", "b"), rows, words, similarity))
    discard(members, alike, pairs)
    return edges


def similar_dedup(docs: DataFrame, text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) for rows with a doc_id: the smallest doc_id reachable over similar pairs."""
    small_batches(docs.sparkSession)
    rows, share = _rows(docs, text), Fraction(str(similarity))
    prints = written(prints_of(rows, words, share, common_shingles(rows, words)), "near-prints")
    least = prints.groupBy("h1", "h2").agg(F.min("node").alias("a"))
    equal = written(prints.select("node", "h1", "h2").join(least, ["h1", "h2"]).filter("node <> a").select("a", F.col("node").alias("b")).distinct(), "near-equal")
    # An id of several rows with different texts may be a copy in one and not in another: it stays a node.
    several = prints.groupBy("node").agg(F.count_distinct("h1", "h2").alias("n")).filter("n > 1").select("node")
    copies = equal.select(F.col("b").alias("node")).join(several, "node", "left_anti").distinct()
    alone = written(prints.join(copies, "node", "left_anti").drop("h1", "h2"), "near-alone")
    nodes = written(prints.select("node"), "near-nodes")
    discard(prints)
    joined = components(equal.union(edges_of(rows, alone, words, share)))
    found = written(nodes.join(joined, "node", "left").select(F.col("node").alias("doc_id"), F.coalesce("component", "node").alias("component_id")), "near-groups")
    discard(alone, equal, nodes)
    return found


def keep_one(docs: DataFrame, text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all their columns."""
    dropped = similar_dedup(docs, text, words, similarity).filter("doc_id <> component_id").select("doc_id").distinct()
    return rows_without(docs, dropped, F.col("doc_id").cast("long"))
