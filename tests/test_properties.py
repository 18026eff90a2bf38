"""Property-based checks against plain-Python reference implementations."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabqual.operators import evaluate as ev
from tabqual.operators import quality as qu
from tabqual.operators.ranking import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

cell = st.one_of(st.none(), st.sampled_from(["", " ", "  ", "\t", "a", " b ", "x\ty"]))


def _missing(v):
    return v is None or v.strip(" ") == ""


@SETTINGS
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=40))
def test_completeness_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [(r["non_empty_fields"], r["completeness_ratio"], r["quality_band"])
           for r in qu.assign_band(qu.add_row_profile(df, ["a", "b", "c"])).collect()]
    want = []
    for row in rows:
        k = sum(0 if _missing(v) else 1 for v in row)
        ratio = k / 3.0
        band = "HIGH" if ratio >= 0.85 else "MEDIUM" if ratio >= 0.60 else "LOW"
        want.append((k, ratio, band))
    assert sorted(got) == sorted(want)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=300),
       st.sampled_from([0.01, 0.15, 0.5, 0.85, 1.0]), st.sampled_from([20, 10_000]))
def test_exact_quantile_matches_sorting(spark, values, q, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got, _ = exact_quantiles(df, ["x"], q, accuracy=accuracy)
    present = sorted(v for v in values if v is not None)
    want = present[max(1, math.ceil(q * len(present))) - 1] if present else None
    assert got["x"] == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=80))
def test_auc_matches_pairwise(spark, rows):
    df = spark.createDataFrame([(y, s / 6.0) for y, s in rows], "label int, score double")
    got = ev.auc_metrics(df).first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        assert got is None
        return
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12
