"""Listing, format sniffing within bounds, and the structural scan of large JSON documents."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabqual.plans import derived_sources as ds
from tabqual.sources import files as fl
from tabqual.sources import readers as rd
from tabqual.sources import sniff as sn
from tabqual.sources import structural as st


def test_listing_is_the_same_for_any_number_of_slices(spark, tmp_path):
    for i in range(30):
        f = tmp_path / f"d{i % 4}" / f"f {i}.txt"
        f.parent.mkdir(exist_ok=True)
        f.write_text("x" * i)
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "d1" / ".hidden").write_text("no")
    want = sorted((str(p), p.stat().st_size) for p in tmp_path.rglob("f *"))
    for slices in (1, 5):
        assert sorted(map(tuple, fl.list_files(spark, str(tmp_path), slices).collect())) == want
    assert fl.list_files(spark, "file:" + str(tmp_path), 2).count() == 30
    assert fl.list_files(spark, str(tmp_path / "d0" / "f 0.txt"), 2).count() == 1
    with pytest.raises(Exception, match="missing"):
        fl.list_files(spark, str(tmp_path / "missing"), 1).collect()


CONTENTS = {
    "a.csv": '{"not looked at": 1}', "b.geojson": "x", "c": "", "d": "x,y\n1,2\n" * 50, "e": "word " * 300, "f": '{"a": 1}  \n{"a": 2}\n',
    "g": '{"a": "' + "z" * 400 + '"}   \r{"a": 2}', "h": '[{"a": 1},\n {"a": 2}]', "i": "\n  \t" * 90 + '{"a":\n1}', "j.json": "plain",
    "k": '{"a": 1, ' + " " * 333 + '"kind": "FeatureCollection"' + " " * 77 + '"type"}', "l": '{"type": "FeatureCollection"}', "m": "   \n ",
    "n": "w" * 200 + "\n1,2", "o": "w" * 200 + ",\n1", "p": '{"a": {' + "\n" + "}}" * 100, "q.JSON": '{"FeatureCollection": "no marker of kind"}',
    "r": '{"a": 1}' + " " * 500 + "\n5", "s": '{"a":' + "1" * 95 + "}" + " " * 300 + "\n{}"}


@pytest.mark.parametrize("head, rng", [(1, 1), (7, 13), (64, 100), (1 << 16, 1 << 20)])
def test_sniffing_decides_as_the_expression(spark, tmp_path, head, rng):
    for name, text in CONTENTS.items():
        (tmp_path / name).write_text(text)
    got = {r["path"].rsplit("/", 1)[1]: r for r in sn.sniff(spark, str(tmp_path), head, rng, 3).collect()}
    rows = spark.createDataFrame(list(CONTENTS.items()), "n string, c string")
    want = {r[0]: r[1] for r in rows.select("n", rd.format_expr(rows["n"], rows["c"], text=True)).collect()}
    assert {n: r["format"] for n, r in got.items()} == want
    for n, r in got.items():
        first = CONTENTS[n].lstrip().replace("\r", "\n").split("\n")[0].rstrip(" ")
        lines = first.startswith("{") and first.endswith("}")
        assert r["json_layout"] == (None if r["format"] != "json" else "lines" if lines else "document"), n
        assert r["length"] == len(CONTENTS[n])


def test_sniffing_reads_no_more_than_it_needs(spark, tmp_path):
    size = 1 << 20
    texts = {"head": '{"type": "FeatureCollection"' + " " * size, "late": "{" + " " * size + '"type" "FeatureCollection"}', "big.csv": "x" * size}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    out = {r["path"].rsplit("/", 1)[1]: r for r in sn.sniff(spark, str(tmp_path), 1000, 1 << 18).collect()}
    assert out["big.csv"]["bytes_read"] == 0 and out["head"]["bytes_read"] == 1000
    assert len(texts["late"]) <= out["late"]["bytes_read"] <= len(texts["late"]) + 5 * sn.OVERLAP
    assert sn.sniff(spark, str(tmp_path / "none") if (tmp_path / "none").mkdir() is None else "", 10).count() == 0


def test_quotes_and_escapes_of_any_cut():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice('"\\\\{}[]a') for _ in range(rnd.randint(1, 40))).encode()
        want, run = [], 0
        for i, b in enumerate(text):
            if b == 34 and run % 2 == 0:
                want.append(i)
            run = run + 1 if b == 92 else 0
        for cut in range(len(text) + 1):
            before = text[:cut]
            escapes = len(before) - len(before.rstrip(b"\\"))
            own = st.open_quotes(np.frombuffer(text[cut:], np.uint8), escapes) + cut
            assert own.tolist() == [w for w in want if w >= cut]


ODD = ['plain', 'quo"te', 'back\\slash', '\\"', '{[', ']}', 'é€😀', '', '"features": [', 'line\nbreak', '\\\\\\']


def items(n):
    rnd = random.Random(n)
    return [{"id": i, "s": "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 5))), "deep": {"list": [[i], {"k": rnd.choice(ODD)}]}} for i in range(n)]


@pytest.mark.parametrize("rng", [1, 17, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 3])
def test_records_are_those_of_the_parser(spark, tmp_path, rng, indent):
    own = items(12)
    docs = [own[:4], {"meta": {"results": [{"no": 1}]}, "other": [{"no": 2}], "results": own[4:9], "tail": [{"no": 3}]},
            {"results": own[9:], "my\"results": [{"no": 4}]}, {"id": 99, "results": None}, [], {"results": []}]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text("  \n" * (i % 2) + json.dumps(d, indent=indent, ensure_ascii=bool(i % 3)), encoding="utf-8")
    (tmp_path / "blank.json").write_text(" \n ")
    got = st.document_records(spark, str(tmp_path), "results", range_bytes=rng).collect()
    texts = [r["value"] for r in got if not r["whole"]]
    assert sorted(json.dumps(json.loads(t)) for t in texts) == sorted(json.dumps(o) for o in own)
    assert [json.loads(r["value"]) for r in got if r["whole"]] == [docs[3]] and not any("\n" in t for t in texts)


@pytest.mark.parametrize("text", ['[{"a": 1}', '{"a": "open}', "word", '[{"a": 1}]]'])
def test_documents_that_do_not_close_are_errors(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(rd.SourceError):
        st.document_records(spark, str(tmp_path), "results", range_bytes=4)


def test_large_readers_agree_with_the_readers_of_whole_files(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"id": i, "n": o["s"]} if i % 5 else None, "geometry": {"type": "Point", "coordinates": [i, 1.5]} if i % 3 else None}
                for i, o in enumerate(items(40))]
    (tmp_path / "geo").mkdir()
    (tmp_path / "geo" / "all.json").write_text(json.dumps({"type": "FeatureCollection", "crs": {"properties": {"x": [{}]}}, "features": features[:30]}, indent=1))
    for i, f in enumerate(features[30:]):
        (tmp_path / "geo" / f"{i}.json").write_text(json.dumps(f))
    mine, plain = st.read_large_geojson(spark, str(tmp_path / "geo"), range_bytes=100), rd.read_geojson(spark, str(tmp_path / "geo"))
    assert mine.columns == plain.columns and sorted(map(repr, mine.collect())) == sorted(map(repr, plain.collect()))
    (tmp_path / "wrapped").mkdir()
    for i, d in enumerate([items(10), {"results": items(7)}]):
        (tmp_path / "wrapped" / f"{i}").write_text(json.dumps(d))
    mine, plain = st.read_large_json(spark, str(tmp_path / "wrapped"), range_bytes=64), rd.read_wrapped_json(spark, str(tmp_path / "wrapped"))
    assert sorted(map(repr, mine.select(*sorted(mine.columns)).collect())) == sorted(map(repr, plain.select(*sorted(plain.columns)).collect()))
    (tmp_path / "wrapped" / "lone").write_text('{"id": 1}')
    with pytest.raises(rd.SourceError):
        st.read_large_json(spark, str(tmp_path / "wrapped"))


def test_one_document_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(items(3000)))
    records = st.document_records(spark, str(tmp_path), "results", range_bytes=1 << 14)
    from pyspark.sql import functions as F
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1 and records.count() == 3000


def test_one_document_is_written_by_several_tasks(spark):
    rows = [(i // 2 if i % 10 else None, random.Random(i).choice(ODD) * (i % 50)) for i in range(400)] + [(7, "twice")] * 5
    df = spark.createDataFrame(rows, "id long, s string").coalesce(1)
    spark.sparkContext.setJobGroup("test-document", "")
    path = ds.write_one_document(spark, df, "id", F.struct("id", "s"), '{"results": [', "]}", "test-document", part_bytes=2000)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    (file, length), = fl.list_files(spark, path, 1).collect()
    own = [(r.get("id", -1), r["s"]) for r in json.loads(fl.read_bytes(file, 0, length))["results"]]
    want = [(-1 if k is None else k, s) for k, s in rows]
    assert [k for k, _ in own] == sorted(k for k, _ in want) and sorted(own) == sorted(want)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("test-document")]
    assert max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds) >= length // 2000 - 1 > 8


@pytest.mark.parametrize("n", [0, 1])
def test_a_document_of_few_rows_is_whole(spark, n):
    path = ds.write_one_document(spark, spark.range(n), "id", F.struct("id"), "[", "]", "test-small")
    (file, length), = fl.list_files(spark, path, 1).collect()
    assert json.loads(fl.read_bytes(file, 0, length)) == [{"id": i} for i in range(n)]
