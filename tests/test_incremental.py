"""Tables rewritten by partition: files kept, whole results, lost and repeated runs."""

from pyspark.sql import functions as F

from tabqual.operators import incremental as inc


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, `a b` int, m map<string,int>")


def content(df):
    return sorted((str(r["k"]), str(r["a b"]), str(r["m"])) for r in df.collect())


def files(spark, path, run=None):
    rows = inc.read_snapshot(spark, path, run, file_col="f").select("k", "f").distinct().collect()
    return {r["k"]: r["f"] for r in rows}


ROWS = [("x", 1, {"p": 1, "q": 2}), ("x", 1, {"p": 1, "q": 2}), ("y", None, None), ("", 3, {}), (None, 4, None), ("1", 5, None)]


def test_only_changed_partitions_are_written(spark, tmp_path):
    path = str(tmp_path)
    first = inc.write_changed(frame(spark, ROWS), path, ["k"])
    assert (first.run, first.partitions, first.written, first.gone) == (1, 5, 5, 0)
    assert content(inc.read_snapshot(spark, path)) == content(frame(spark, ROWS))  # '' is not NULL, and '1' a string
    old = files(spark, path)
    same = inc.write_changed(frame(spark, ROWS[::-1]).repartition(3), path, ["k"])
    assert (same.written, same.gone) == (0, 0) and files(spark, path) == old
    later = ROWS[1:] + [("z", 9, None)]  # one of two equal rows gone, one partition new
    later = [r for r in later if r[0] != "y"]
    third = inc.write_changed(frame(spark, later), path, ["k"])
    assert (third.partitions, third.written, third.gone) == (5, 2, 2)
    assert content(inc.read_snapshot(spark, path)) == content(frame(spark, later))
    now = files(spark, path)
    assert {k for k in now if old.get(k) == now[k]} == {"", None, "1"}
    assert content(inc.read_snapshot(spark, path, run=1)) == content(frame(spark, ROWS))


def test_moved_nulls_and_a_new_version_change_a_partition(spark, tmp_path):
    path, schema = str(tmp_path), "k int, a string, b string"
    inc.write_changed(spark.createDataFrame([(1, "v", None)], schema), path, ["k"])
    moved = spark.createDataFrame([(1, None, "v")], schema)
    assert inc.write_changed(moved, path, ["k"]).written == 1
    assert inc.write_changed(moved, path, ["k"]).written == 0
    out = inc.write_changed(moved, path, ["k"], lambda df: df.withColumn("c", F.lit(7)), version="2")
    assert out.written == 1 and inc.read_snapshot(spark, path).collect()[0]["c"] == 7


def test_a_lost_run_is_not_seen_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path)
    inc.write_changed(frame(spark, ROWS[:2]), path, ["k"])
    part = spark.createDataFrame([(2, "f" * 32, 1, None, None)], "run int, input_fingerprint string, rows bigint, listed bigint, schema string")
    part.write.mode("append").partitionBy("run").parquet(path + "/manifests")  # the row that tells the number is not there
    assert inc.last_run(spark, path) == 1 and content(inc.read_snapshot(spark, path)) == content(frame(spark, ROWS[:2]))
    assert inc.write_changed(frame(spark, ROWS), path, ["k"]).run == 2
    assert content(inc.read_snapshot(spark, path)) == content(frame(spark, ROWS))


def test_an_empty_source_empties_the_table(spark, tmp_path):
    path = str(tmp_path)
    assert inc.write_changed(frame(spark, []), path, ["k"]).partitions == 0
    assert inc.read_snapshot(spark, path, file_col="f").count() == 0
    inc.write_changed(frame(spark, ROWS), path, ["k"])
    assert inc.write_changed(frame(spark, []), path, ["k"]).gone == 5 and inc.read_snapshot(spark, path).count() == 0
