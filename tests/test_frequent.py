"""Exact top values: the summary's proof, columns that it does not settle, ties beyond the first bytes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabqual.operators import frequent as fr


def brute(rows, names, k):
    out = []
    for i, c in enumerate(names):
        counts = Counter(r[i] for r in rows if r[i] is not None and r[i].strip(" "))
        out += [(c, v, n) for v, n in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]]
    return sorted(out)


def frame(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))


@pytest.mark.parametrize("k", [1, 3, 10])
def test_top_values_agree_with_a_count(spark, k):
    rnd = random.Random(k)
    long = "a common beginning of many bytes, the same in all "
    rows = [(rnd.choice("aab"), f"{long}{rnd.randint(0, 900)}", rnd.choice([None, "", "  ", "\t", "é", "z" * rnd.randint(1, 40)]),
             str(int(rnd.paretovariate(0.6)) % 5000), str(i), None) for i in range(6000)]
    names = ["few", "long ties", "odd.name", "zipf", "distinct", "none"]
    got = fr.top_values(frame(spark, rows, names), names, k)
    assert got.columns == ["column", "value", "count"] and sorted(map(tuple, got.collect())) == brute(rows, names, k)


def test_heavy_values_settle_a_column_without_counting_its_tail(spark, monkeypatch):
    df = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, (F.col("id") % 14).cast("string")).otherwise(F.col("id").cast("string")).alias("v"))
    totals, found = fr.candidates(df, ["v"])
    assert totals == {"v": 60_000} and 7 <= len(found["v"]) < fr.CANDIDATES
    seen = []
    whole = fr._by_digest
    monkeypatch.setattr(fr, "_by_digest", lambda rows: seen.append(rows) or whole(rows))
    top = fr.top_values(df, ["v"], 5).collect()
    assert len(seen) == 1  # the recount alone
    assert sorted(r["count"] for r in top) == sorted(Counter(r["v"] for r in df.collect()).values())[-5:]


def test_the_proof_of_completeness():
    bound = 2 * fr.ERROR / fr.MAP_SIZE
    total = 1_000_000
    assert fr._settled([total], total, 5) and fr._settled([3, 2], 5, 4)
    assert not fr._settled([10], total, 5) and not fr._settled([int(bound * total)] * 6, total, 5)
    assert fr._settled([int(bound * total) + 1] * 6, total, 5) and not fr._settled([int(bound * total) + 1] * fr.CANDIDATES, total, 5)


def test_no_rows_and_no_columns(spark):
    empty = spark.createDataFrame([], "a string")
    assert fr.top_values(empty, ["a"]).count() == 0 and fr.top_values(empty, []).count() == 0
    clash = spark.createDataFrame([("x", "y", 1)], "col string, value string, digest int")
    assert sorted(map(tuple, fr.top_values(clash, ["col", "value"]).collect())) == [("col", "x", 1), ("value", "y", 1)]
