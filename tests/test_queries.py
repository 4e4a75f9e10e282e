"""Every registered query against its DuckDB oracle on the smallest driver tables, plus the
entry smoke check and registry integrity."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_key
from wattline.plans import registry

E.queries()  # loads the registry; the optional subpackage has its own tests
QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
              "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "month", "mwh", "revenue", "ppa_revenue", "spot_revenue", "n_rows", "blended_price"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    ocols = rel.columns
    assert sorted(cols) == sorted(ocols)
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    otypes = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(ocols, rel.types)}
    assert stypes == otypes
    orows = [tuple(r[ocols.index(c)] for c in cols) for r in rel.fetchall()]
    assert len(rows) == len(orows)
    assert rows_key(rows, cols, True) == rows_key(orows, cols, True)
