"""Shards by global prefix sums: against a plain loop over the rows, odd rows, and the files written."""

import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, normalize
from tabqual.llm import queries, sharding


def brute(rows, shards):
    """The expected rows, from one walk along the ordered rows."""
    keyed = sorted(((i is None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows))
    total, before, slots, out = sum(k[3] for k in keyed), 0, {}, []
    for none, i, crc, size in keyed:
        shard = min((2 * before + size) * shards // (2 * total), shards - 1)
        slot = slots[shard] = slots.get(shard, -1) + 1
        out.append((None if none else i, size, crc, shard, slot))
        before += size
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("id", "size", "crc", "shard", "slot").collect())


def test_shards_agree_with_a_walk(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    for shards in (1, 7, 24):
        assert got(sharding.assign_shards(docs, shards)) == brute(rows, shards)


def test_bytes_are_near_equal_and_slots_gapless(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int")).alias("text"))
    per = sharding.assign_shards(docs).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("top"),
                                                             F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("shard").collect()
    target = sum(r["b"] for r in per) / 24
    assert [r["shard"] for r in per] == list(range(24)) and all(abs(r["b"] - target) <= 106 for r in per)
    assert all(r["top"] == r["n"] - 1 for r in per) and all(a["hi"] < b["lo"] for a, b in zip(per, per[1:]))


def test_a_hot_id_and_null_ids_are_spread_over_shards(spark):
    rows = [(7, "copy")] * 900 + [(None, "none")] * 900 + [(i, None if i % 2 else "") for i in range(300)]
    out = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 5)
    assert got(out) == brute(rows, 5)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "x" * 100_000), (2, "y")]])
def test_small_tables(spark, rows):
    assert got(sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"))) == (brute(rows, 24) if rows else [])


def test_clashing_columns_and_written_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", *[
        F.lit(i).alias(c) for i, c in enumerate(["id", "size", "crc", "shard", "slot", "range", "row_no", "before", "rank", "total", "first", "row"])])
    plain = sharding.assign_shards(docs.select("doc_id", "text"), 6)
    assert got(sharding.assign_shards(docs, 6)) == got(plain)
    sharding.write_shards(docs, str(tmp_path / "out"), 6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "shard_", "slot_"}
    assert sorted(map(tuple, back.select("doc_id", "shard_", "slot_").collect())) == sorted(map(tuple, plain.select("id", "shard", "slot").collect()))
    assert back.select(docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()
    for one in (tmp_path / "out").glob("shard_=*/*.parquet"):
        slots = [r[0] for r in spark.read.parquet(str(one)).select("slot_").collect()]
        assert slots == list(range(slots[0], slots[0] + len(slots)))


def test_query_matches_its_sql(spark, duck):
    con = duck(SF_SMALL)
    mine, sql = queries.QUERIES["op11_sharding"](spark, SF_SMALL), queries.ORACLE_SQL["op11_sharding"]
    (cols, rows), (want_cols, want_rows) = (
        normalize(x.drop(columns="grown_shard")) for x in (mine.toPandas(), con.execute(sql).df()))
    assert cols == want_cols and rows == want_rows
    assert {c[0]: c[1] for c in con.execute(f"DESCRIBE {sql}").fetchall()} == {
        "doc_id": "BIGINT", "size": "BIGINT", "text_crc32": "BIGINT", "law": "VARCHAR", "shard": "INTEGER", "slot": "BIGINT",
        "grown_shard": "INTEGER"}
    assert dict(mine.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                                 "slot": "bigint", "grown_shard": "int"}
