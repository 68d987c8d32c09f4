import math
from pathlib import Path

import duckdb
import pytest

from missivelake.plans import archive_queries, catalogue, job_queries  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not DATA.exists(), reason="needs the synthetic tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_oracle(spark, name):
    found = catalogue.QUERIES[name](spark, str(DATA))
    columns = sorted(found.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in found.collect())
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        wanted = db.sql(catalogue.ORACLES[name])
        assert sorted(wanted.columns) == columns
        order = [wanted.columns.index(c) for c in columns]
        assert got == sorted(tuple(cell(r[k]) for k in order) for r in wanted.fetchall())


def test_entry_module():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
