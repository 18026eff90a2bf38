"""Every catalog query against its independent SQL formulation (DuckDB)."""

import pytest

from conftest import SF_SMALL, normalize
from tabqual.plans import catalog

NAMES = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = catalog.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(catalog.oracle_sql()[name]).df()
    g_cols, g_rows = normalize(got)
    w_cols, w_rows = normalize(want)
    assert g_cols == w_cols
    assert len(g_rows) == len(w_rows)
    assert g_rows == w_rows


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["quality_band", "min_ratio", "records"]
    assert sum(r["records"] for r in rows) > 0


SPARK_TO_SQL = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, con, name):
    schema = catalog.queries()[name](spark, SF_SMALL).schema
    got = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in schema.fields}
    want = {c[0]: c[1] for c in con.execute(f"DESCRIBE {catalog.oracle_sql()[name]}").fetchall()}
    assert got == want
