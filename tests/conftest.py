import math
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tabqual.plans.fixtures import TABLES  # noqa: E402
from tabqual.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[*]", app_name="tabqual-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")

    def connect(sf_dir):
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return connect


def normalize(pdf, digits=9):
    """Order-insensitive, column-order-insensitive row set with rounded floats."""
    cols = sorted(pdf.columns)
    pdf = pdf[cols]

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, digits))
        return str(v)
    return cols, sorted("|".join(cell(v) for v in row) for row in pdf.itertuples(index=False, name=None))
