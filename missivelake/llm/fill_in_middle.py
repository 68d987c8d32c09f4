"""Fill-in-middle: DuckDB SQL over each Arrow batch cuts a text into lines and moves its middle to the end.

A text is cut into ``n`` lines, each with its line feed.  The hexadecimal SHA-256 of ``seed:doc_id`` gives four unsigned
numbers h1 to h4: the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) lines, the middle after the larger, and
the suffix is the rest.  h3 % 100 below ``rate`` says that a text is cut at all, h4 % 100 below ``spm`` that its suffix comes
first.  The draws depend on nothing but the id, so that a lost task makes the same rows again.  One DuckDB connection a
task takes the batches in slices of bounded bytes and gives Arrow back; there is no shuffle and no Python code for a row.

Defined results: a null or empty text, and one that holds a sentinel, is ``plain``: it stays whole, and its lengths are null.
A null doc_id is hashed as no digits.  Rows of one doc_id are cut at the same draws, each by its own lines.  A text
without a line feed is one line; texts of any length are cut whole.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import small_batches, whole_text

SEED, RATE, SPM = 7, 100, 50
#: Prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes of text handed to DuckDB at once; one longer text goes alone.
SLICE_BYTES = 1 << 24
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

TRANSFORM = r"""
WITH lines AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units, sha256($seed || ':' || coalesce(doc_id::VARCHAR, '')) AS h FROM batch),
draws AS (
  SELECT doc_id, text, units, len(units) AS n, [('0x' || substr(h, 8 * k + 1, 8))::UBIGINT FOR k IN range(4)] AS d FROM lines),
cuts AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, $p) OR contains(text, $s) OR contains(text, $m) OR d[3] % 100 >= $rate THEN 'plain'
         WHEN d[4] % 100 < $spm THEN 'spm' ELSE 'psm' END AS form FROM draws),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(units, 1, a), '') AS prefix,
    array_to_string(list_slice(units, a + 1, b), '') AS middle, array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM cuts)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat($p, prefix, $s, suffix, $m, middle)
    ELSE concat($s, suffix, $p, prefix, $m, middle) END AS output
FROM parts
"""

RESTORE = """
WITH places AS (SELECT *, strpos(output, $p) AS p, strpos(output, $s) AS s, strpos(output, $m) AS m FROM batch)
SELECT * EXCLUDE (p, s, m), CASE form WHEN 'plain' THEN output
  WHEN 'psm' THEN concat(substr(output, p + length($p), s - p - length($p)), substr(output, m + length($m)), substr(output, s + length($s), m - s - length($s)))
  ELSE concat(substr(output, p + length($p), m - p - length($p)), substr(output, m + length($m)), substr(output, s + length($s), p - s - length($s))) END AS restored
FROM places
"""


def checked(sentinels: tuple[str, str, str]) -> dict[str, str]:
    """The sentinels by name, if a text that holds none of them can always be rebuilt from between them.

    No first character of one may stand elsewhere in any, so that none begins inside another.
    """
    firsts = {s[:1] for s in sentinels}
    if len(set(sentinels)) < 3 or any(not s or firsts & set(s[1:]) for s in sentinels):
        raise ValueError(f"sentinels that cannot be told apart: {sentinels}")
    return dict(zip("psm", sentinels, strict=True))


def by_bytes(batch, column: str, most: int = SLICE_BYTES) -> Iterator:
    """Slices of an Arrow batch whose texts have at most ``most`` bytes together, or that are one row."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def through_duckdb(df: DataFrame, sql: str, values: dict, column: str, schema) -> DataFrame:
    """Runs ``sql`` over the rows of each Arrow batch, registered as ``batch``."""
    small_batches(df.sparkSession)

    def run(batches):
        import duckdb
        import pyarrow as pa

        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as con:
            for batch in batches:
                for rows in by_bytes(batch, column):
                    con.register("batch", pa.Table.from_batches([rows]))
                    yield from con.sql(sql, params=values).to_arrow_table().to_batches()

    return df.mapInArrow(run, schema)


def transform(docs: DataFrame, text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Each document with its middle moved to the end: see ``SCHEMA`` and the module's text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    values = checked(sentinels) | {"seed": str(seed), "rate": rate, "spm": spm}
    return through_duckdb(rows, TRANSFORM, values, "text", SCHEMA)


def restore(transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Adds ``restored``, the text rebuilt from ``output`` and ``form`` alone."""
    schema = StructType([*transformed.schema.fields, StructField("restored", StringType())])
    return through_duckdb(transformed, RESTORE, checked(sentinels), "output", schema)
