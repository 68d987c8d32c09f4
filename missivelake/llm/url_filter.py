"""URL filters: stated rules by longest suffix and path, then mined association rules.

FP-growth mines the token combinations of labelled addresses together with the label.  Before, tokens that stand in exactly
the same labelled rows become one item, and tokens of every row go: they cannot tell rows apart, and each would
double the number of combinations.  The support that a rule needs follows from the number of labelled rows, and the lower
bound of its confidence must exceed the share of bad rows.  The bound is taken at an error divided by the number of combinations
that were tried (Bonferroni), so that a table whose labels have nothing to do with its addresses gives no rule in most cases.  A
rule goes when a shorter one inside it is as confident.  Rules match by an inverted index: each is filed under its rarest token, so an address only meets rules filed
under its own tokens.

The index is sent to the executors while it has at most ``MAX_RULES`` rules; beyond, distinct addresses and
rules meet in an equi-join on the filed token.

The number of combinations still grows with two to the power of the items of one address that stand in different
rows, as with any search for frequent sets.

Defined results: a null address, or one without ``://``, has empty host and path and is allowed.  Rows with
null or repeated page ids are judged like any other.  Unlabelled or empty label tables, and labels of one kind only, give
no mined rules.  Repeated labelled rows count each.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, small_batches, written

#: (action, host with path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BAD = "label=bad"
#: A rule needs this share of the labelled rows and so many rows; the chance that any combination of a table without rules passes
#: is about ``ERROR`` (one-sided lower bound of Wilson's interval).
MIN_SUPPORT, MIN_ROWS, ERROR = 0.002, 5, 0.05
RULE_SCHEMA = "antecedent array<string>, confidence double, support double"
MAX_RULES = 50_000


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: labels of the host, the host, parts of the path with digits masked, names of parameters."""
    host, path = host_of(url), path_of(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    full = lambda x: F.length(x) > 0
    parts = F.concat(
        F.transform(F.filter(F.split(host, r"\."), full), lambda x: F.concat(F.lit("h="), x)),
        F.array(F.concat(F.lit("host="), host)),
        F.transform(F.filter(F.split(path, "/"), full), lambda x: F.concat(F.lit("p="), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(F.filter(F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]), full), lambda x: F.concat(F.lit("q="), x)),
    )
    return F.array_distinct(parts)


def stated(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, or nulls."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def deviations_for(tried: int, error: float = ERROR) -> float:
    """Standard errors of a one-sided bound that holds for ``tried`` combinations together."""
    return NormalDist().inv_cdf(1 - error / max(1, tried))


def lower_bound(hits: Column, rows: Column, deviations: float) -> Column:
    """The lower bound of Wilson's interval for a share of ``hits`` in ``rows``."""
    z = deviations * deviations
    share = hits / rows
    return (share + z / (2 * rows) - deviations * F.sqrt(share * (1 - share) / rows + z / (4 * rows * rows))) / (1 + z / rows)


def items_of(baskets: DataFrame, n: int, least: int) -> DataFrame:
    """(token, item): frequent tokens; those of exactly the same rows are one item, named after its least token.

    baskets: (row, tokens).  Row sets are compared by their size and two 64-bit digests.
    """
    row = F.xxhash64("row")
    tokens = baskets.select("row", F.explode("tokens").alias("token"))
    sets = tokens.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.bit_xor(F.xxhash64(F.lit("second"), "row")).alias("y"))
    sets = sets.filter((F.col("n") >= least) & (F.col("n") < n))
    names = sets.groupBy("n", "x", "y").agg(F.min("token").alias("item"))
    return sets.join(names, ["n", "x", "y"]).select("token", "item")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS, error: float = ERROR) -> DataFrame:
    """(antecedent array, confidence, support) of rules towards the bad label.

    labelled: (url, bad boolean).
    """
    spark = labelled.sparkSession
    baskets = written(labelled.select(F.monotonically_increasing_id().alias("row"), tokens_of(F.coalesce("url", F.lit(""))).alias("tokens"), F.coalesce("bad", F.lit(False)).alias("bad")), "url-baskets")
    n, bad = baskets.agg(F.count("*"), F.count_if("bad")).first()
    if not 0 < bad < n:
        return spark.createDataFrame([], RULE_SCHEMA)
    least = max(min_rows, int(min_support * n))
    items = written(items_of(baskets, n, least), "url-items")
    of_row = baskets.select("row", F.explode("tokens").alias("token")).join(items, "token").groupBy("row").agg(F.collect_set("item").alias("items"))
    labels = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    rows = baskets.join(of_row, "row", "left").select(F.concat(F.coalesce("items", F.array().cast("array<string>")), labels).alias("items"))
    # The miner needs ceil(minSupport * n) rows: half a row less than ``least``, so that rounding cannot ask for one more.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=bad / n).fit(rows)
    tried = model.freqItemsets.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).count()
    deviations = deviations_for(tried, error)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
    hits = F.round(F.col("support") * n)
    sure = rules.filter(lower_bound(hits, F.round(hits / F.col("confidence")), deviations) > bad / n).select("antecedent", "confidence", "support")
    whole = sure.select(F.explode("antecedent").alias("item"), "*").join(items, "item").groupBy("antecedent", "confidence", "support").agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    found = written(whole.select(F.col("tokens").alias("antecedent"), F.col("confidence").cast("double").alias("confidence"), F.col("support").cast("double").alias("support")), "url-rules")
    discard(baskets, items)
    return found


def prune(rules: list[tuple[tuple[str, ...], float]]) -> list[tuple[tuple[str, ...], float]]:
    """Drops rules that contain a shorter rule of at least their confidence."""
    kept: list[tuple[tuple[str, ...], float]] = []
    filed: dict[str, list[int]] = defaultdict(list)
    for items, confidence in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own = set(items)
        if any(kept[k][1] >= confidence and own.issuperset(kept[k][0]) for t in items for k in filed[t]):
            continue
        filed[items[0]].append(len(kept))
        kept.append((items, confidence))
    return kept


def index_of(rules: list[tuple[tuple[str, ...], float]]) -> dict[str, list[tuple[frozenset[str], float]]]:
    """The inverted index: rules by the token that the fewest rules hold."""
    held: dict[str, int] = defaultdict(int)
    for items, _ in rules:
        for t in items:
            held[t] += 1
    index: dict[str, list[tuple[frozenset[str], float]]] = defaultdict(list)
    for items, confidence in rules:
        index[min(items, key=lambda t: (held[t], t))].append((frozenset(items), confidence))
    return dict(index)


def match(index: dict[str, list[tuple[frozenset[str], float]]], tokens: list[str]) -> float:
    """The highest confidence of the rules that the tokens fulfil, or 0."""
    own = set(tokens)
    return max((c for t in own for items, c in index.get(t, ()) if own.issuperset(items)), default=0.0)


def _filed(rules: DataFrame) -> DataFrame:
    """(token, antecedent, confidence): each rule under the token that the fewest rules hold."""
    each = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    held = each.groupBy("token").agg(F.count("*").alias("held"))
    return each.join(held, "token").groupBy("antecedent").agg(F.min_by("token", F.struct("held", "token")).alias("token"), F.max("confidence").alias("confidence"))


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Matches without sending rules: the equi-join on each rule's filed token over distinct addresses."""
    addresses = rows.select("url").distinct().select("url", tokens_of(F.coalesce("url", F.lit(""))).alias("tokens"))
    hits = addresses.select("url", "tokens", F.explode("tokens").alias("token")).join(_filed(rules), "token").filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = hits.groupBy("url").agg(F.max("confidence").alias("confidence")).withColumnRenamed("url", "__url")
    return rows.join(best, F.col("url").eqNullSafe(F.col("__url")), "left").drop("__url")


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, max_rules: int = MAX_RULES, **options) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) for every row of ``pages`` (page_id, url)."""
    small_batches(pages.sparkSession)
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    rule, action = stated(host, path, rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.cast("string").alias("url"))
    mined = mine(labelled, **options)
    few = mined.limit(max_rules + 1).collect()  # the bound is checked before anything is sent
    if not few:
        scored = rows.withColumn("confidence", F.lit(None).cast("double"))
    elif len(few) > max_rules:
        scored = _by_join(rows, mined)
    else:
        index = index_of(prune([(tuple(r["antecedent"]), r["confidence"]) for r in few]))

        def look_up(batches):
            import pyarrow as pa

            for batch in batches:
                found = [match(index, t) or None for t in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["page_id", "url", "confidence"])

        scored = rows.withColumn("tokens", tokens_of(F.coalesce("url", F.lit("")))).mapInArrow(look_up, "page_id long, url string, confidence double")
    method = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", host.alias("host"), path.alias("path"), rule.alias("rule"), F.coalesce(action, method).alias("verdict"), "confidence")
