"""Path normalisation with reference rewriting: plans and new texts; ``plans.workflows`` carries them out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.sources.stores import staged

ROOT_NAMES = ("attachments", "Attachments", "StickerCache")


def attachment_roots(paths: DataFrame) -> DataFrame:
    """(root): directories at any depth that hold attachments, from (rel_path) of files."""
    parts = F.split("rel_path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size("parts") - 1, F.lit(1))), lambda i: F.slice(F.col("parts"), 1, i))
    rows = paths.withColumn("parts", parts).filter(F.size("parts") > 1).select(F.explode(prefixes).alias("dir"))
    return rows.filter(F.element_at("dir", -1).isin(*ROOT_NAMES)).select(F.array_join("dir", "/").alias("root")).distinct()


def below_roots(paths: DataFrame) -> DataFrame:
    """The (rel_path) of files in a folder of attachments at any depth."""
    folders = F.slice(F.split("rel_path", "/"), F.lit(1), F.greatest(F.size(F.split("rel_path", "/")) - 1, F.lit(0)))
    return paths.filter(F.exists(folders, lambda p: p.isin(*ROOT_NAMES)))


def full_plan(paths: DataFrame) -> DataFrame:
    """(rel_dir, old_name, new_name, depth): every bad file or directory name below a root, deepest first.

    paths: (root, rel_path).
    """
    parts = F.split("rel_path", "/")
    steps = F.transform(parts, lambda name, i: F.struct(F.array_join(F.slice(parts, F.lit(1), i), "/").alias("rel_dir"), name.alias("old_name"), i.alias("depth")))
    rows = paths.select("root", F.explode(steps).alias("s")).filter(T.is_bad_component(F.col("s.old_name")))
    return rows.select("root", "s.rel_dir", "s.old_name", T.sanitize_component(F.col("s.old_name")).alias("new_name"), "s.depth").distinct().orderBy(F.desc("depth"), "root", "rel_dir", "old_name")


def renames(paths: DataFrame) -> DataFrame:
    """(root, old_path, new_path) of files whose path changes."""
    new = T.sanitize_path(F.col("rel_path"))
    return paths.select("root", F.col("rel_path").alias("old_path"), new.alias("new_path")).filter("old_path <> new_path")


def referenced(pages: DataFrame) -> DataFrame:
    """(path): the distinct attachment paths that pages refer to."""
    return pages.select(F.explode(T.references(F.col("html"))).alias("path")).distinct()


def scoped_plan(pages: DataFrame, files: DataFrame) -> DataFrame:
    """(old_path, new_path, skipped) for referenced files with a bad name; skipped where an ancestor is bad,
    since other pages may refer through it.  A file that no page in scope refers to is never touched, and a
    reference to a file that does not exist still counts."""
    bad = referenced(pages).filter(T.is_bad_component(T.basename(F.col("path"))) | T.has_bad_ancestor(F.col("path")))
    there = files.select(F.col("path").alias("__path"), F.lit(True).alias("exists")).distinct()
    renamed = F.concat(F.regexp_extract("path", "^(.*/)?", 0), T.sanitize_component(T.basename(F.col("path"))))
    out = bad.join(there, F.col("path") == F.col("__path"), "left")
    return out.select(F.col("path").alias("old_path"), renamed.alias("new_path"), T.has_bad_ancestor(F.col("path")).alias("skipped"), F.coalesce("exists", F.lit(False)).alias("exists"))


def settle(pairs: DataFrame, tree: DataFrame, digests: Callable[[DataFrame, str], DataFrame], base: str) -> DataFrame:
    """(old_path, new_path, action, collision): where each badly named file goes, so that no bytes are lost and no order counts.

    pairs: (old_path, new_path) as planned; tree: (rel_path) of all files below ``base``; ``digests`` reads files by whole path.
    A new name that one file wants and none has is simply taken (``move``).  For others the bytes decide: they belong to
    the file that has the name already, else to the least old path.  Files of the same bytes go (``remove``); others take the name with
    the start of their hash before the suffix, or the whole hash where other bytes have that name too.  A file that is not there has
    no action: pages that refer to it are still rewritten.
    """
    folder = base.rstrip("/") + "/"

    def hashes(rows: DataFrame, column: str, name: str) -> DataFrame:
        """(<name>, <name>_hash) of the files that a column names."""
        read = digests(rows.select(F.concat(F.lit(folder), F.col(column)).alias(name)), name)
        return staged(read.select(F.substring(name, len(folder) + 1, 1 << 20).alias(name), F.col("sha256").alias(f"{name}_hash")), "hashes")

    def marked(digest: Column) -> Column:
        """The new name with a hash before its suffix."""
        return F.concat(F.regexp_replace("new_path", r"(?<=[^./])\.[^./]+$", ""), F.lit("_"), digest, F.regexp_extract("new_path", r"(?<=[^./])(\.[^./]+)$", 1))

    # Who wants which name, and who has it already.
    there = tree.select("rel_path").distinct()
    pairs = pairs.groupBy("old_path").agg(F.min("new_path").alias("new_path"))
    sources = staged(pairs.join(there, F.col("old_path") == F.col("rel_path"), "left").withColumn("there", F.col("rel_path").isNotNull()).drop("rel_path"), "sources")
    remaining = there.join(sources.filter("there").select(F.col("old_path").alias("rel_path")), "rel_path", "left_anti")
    wanted = sources.filter("there").groupBy("new_path").agg(F.count("*").alias("n"), F.min("old_path").alias("least"))
    wanted = staged(wanted.join(remaining.withColumnRenamed("rel_path", "holder"), F.col("new_path") == F.col("holder"), "left"), "wanted")
    free = wanted.filter("n = 1 and holder is null").select("new_path", F.lit("move").alias("plain"))
    alone = sources.join(free, "new_path", "left").filter("plain is not null or not there").select("old_path", "new_path", F.when(F.col("there"), F.col("plain")).alias("action"), F.lit(False).alias("collision"))
    # The others are compared with the file that gets the name.
    first = F.coalesce("holder", "least").alias("first")
    contested = staged(sources.filter("there").join(wanted.filter("n > 1 or holder is not null"), "new_path").select("old_path", "new_path", first), "contested")
    rows = contested.join(hashes(contested, "old_path", "of"), F.col("old_path") == F.col("of")).join(hashes(contested.select("first").distinct(), "first", "held"), F.col("first") == F.col("held"))
    rows = staged(rows.select("old_path", "new_path", "first", "of_hash", (F.col("of_hash") == F.col("held_hash")).alias("same"), marked(F.substring("of_hash", 1, 8)).alias("short"), marked(F.col("of_hash")).alias("long")), "compared")
    copies = rows.filter("same").select("old_path", "new_path", F.when(F.col("old_path") == F.col("first"), F.lit("move")).otherwise(F.lit("remove")).alias("action"), F.lit(False).alias("collision"))
    # Other bytes: the short name, unless other bytes have it, want it or share it.
    other = rows.filter("not same")
    shared = other.groupBy("short").agg(F.count_distinct("of_hash").alias("kinds"))
    shared = shared.join(hashes(other.join(remaining, F.col("short") == F.col("rel_path")).select("short").distinct(), "short", "taken"), F.col("short") == F.col("taken"), "left")
    shared = shared.join(wanted.select(F.col("new_path").alias("claimed")), F.col("short") == F.col("claimed"), "left")
    fits = (F.col("taken").isNull() | (F.col("taken_hash") == F.col("of_hash"))) & (F.col("kinds") == 1) & F.col("claimed").isNull()
    named = other.join(shared, "short").select("old_path", "of_hash", F.when(fits, F.col("short")).otherwise(F.col("long")).alias("target"), (fits & F.col("taken").isNotNull()).alias("has"))
    ahead = named.groupBy("target").agg(F.min("old_path").alias("ahead"))
    renamed = named.join(ahead, "target").select("old_path", F.col("target").alias("new_path"), F.when(~F.col("has") & (F.col("old_path") == F.col("ahead")), F.lit("move")).otherwise(F.lit("remove")).alias("action"), F.lit(True).alias("collision"))
    return alone.union(copies).union(renamed)


def rewrite(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pages with (file, html, n_updated): attribute values equal to an old path get the new one.

    Each page meets only the pairs it refers to.  Its text is cut once at all references, and the pieces between them are joined again
    with each reference as it is or as it becomes: one pass, whatever the number of pairs, and no new path is read as an old one.
    """
    refs = pages.select("file", F.explode(T.references(F.col("html"))).alias("old_path"))
    hits = refs.join(pairs.select("old_path", "new_path").distinct(), "old_path")
    per_page = hits.groupBy("file").agg(F.map_from_entries(F.collect_set(F.struct("old_path", "new_path"))).alias("pairs"), F.count("*").alias("n_updated"))
    joined = pages.join(per_page, "file", "left")
    new = T.replace_references(F.col("html"), F.col("pairs"))
    return joined.withColumn("html", F.when(F.col("pairs").isNull(), F.col("html")).otherwise(new)).withColumn("n_updated", F.coalesce("n_updated", F.lit(0))).drop("pairs")


def new_excludes(plan: DataFrame, excludes: DataFrame) -> DataFrame:
    """(pattern): the old patterns and those of the names that a plan changes, sorted."""
    paths = F.when(F.col("rel_dir") == "", F.col("old_name")).otherwise(F.concat_ws("/", "rel_dir", "old_name"))
    return excludes.select("pattern").union(plan.select(T.exclude_pattern(paths))).distinct().orderBy("pattern")


def heal_candidates(log: DataFrame, files: DataFrame) -> DataFrame:
    """Logged renames whose old and new files both exist: copies that a later sync brought back."""
    f = files.select("path").distinct()
    return log.join(f, log["old"] == f["path"], "left_semi").join(f.withColumnRenamed("path", "p2"), F.col("new") == F.col("p2"), "left_semi")
