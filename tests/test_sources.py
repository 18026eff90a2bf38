"""Readers on files written by the test itself (FX5)."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.sources import readers as rd


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_with_header_infers_types(spark, tmp_path):
    p = _write(tmp_path / "a.csv", "id,name,amount\n1,x,2.5\n2,,3\n")
    df = rd.read_csv(spark, p)
    assert dict(df.dtypes) == {"id": "int", "name": "string", "amount": "double"}
    assert df.count() == 2


def test_json_lines(spark, tmp_path):
    p = _write(tmp_path / "a.json", '{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert sorted(r["a"] for r in rd.read_json_lines(spark, p).collect()) == [1, 2]


def test_top_level_array_and_results_wrapper(spark, tmp_path):
    arr = _write(tmp_path / "arr.json", json.dumps([{"a": 1}, {"a": 2}], indent=2))
    wrapped = _write(tmp_path / "res.json", json.dumps({"results": [{"a": 3}, {"a": 4}]}, indent=2))
    assert sorted(r["a"] for r in rd.read_wrapped_json(spark, arr).collect()) == [1, 2]
    assert sorted(r["a"] for r in rd.read_wrapped_json(spark, wrapped).collect()) == [3, 4]


def test_unsupported_json_object_is_an_error(spark, tmp_path):
    p = _write(tmp_path / "obj.json", json.dumps({"type": "FeatureCollection", "features": []}))
    with pytest.raises(rd.SourceError):
        rd.read_wrapped_json(spark, p)


def test_geojson_flatten_edge_cases(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a", "geometry_type": "stale"}, "geometry": {"type": "Polygon"}},
        {"type": "Feature", "properties": {"name": "b"}, "geometry": None},
        {"type": "Feature", "properties": None, "geometry": {"type": "Point"}},
    ]}
    p = _write(tmp_path / "g.geojson", json.dumps(doc, indent=2))
    rows = {(r["name"], r["geometry_type"]) for r in rd.read_geojson(spark, p).collect()}
    assert rows == {(None, "Point"), ("a", "Polygon"), ("b", None)}


def test_geojson_without_features_has_no_rows(spark, tmp_path):
    p = _write(tmp_path / "g.geojson", json.dumps({"type": "FeatureCollection"}))
    assert rd.read_geojson(spark, p).count() == 0


def test_quarantine_split(spark, tmp_path):
    p = _write(tmp_path / "c.json", '{"a": 1}\n{"a": 2\n{"a": 3}\n')
    good, bad = rd.read_with_quarantine(spark, p, T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r["a"] for r in good.collect()) == [1, 3]
    assert [r[rd.CORRUPT_COLUMN] for r in bad.collect()] == ['{"a": 2']


def test_format_detection_and_mixed_read(spark, tmp_path):
    d = tmp_path / "src"
    d.mkdir()
    _write(d / "one.csv", "id,v\n1,a\n")
    _write(d / "two.data", "id,v\n2,b\n")                       # sniffed as CSV
    _write(d / "three.json", json.dumps([{"id": 3, "w": "c"}]))
    _write(d / "four.bin", json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": 4}, "geometry": {"type": "Point"}}]}))
    _write(d / "five.json", '{"id": 5, "w": "e"}\n{"id": 6, "w": "f"}\n')   # JSON lines
    _write(d / "seven.json", json.dumps({"results": [{"id": 7}]}, indent=2))  # wrapped document
    files = rd.detect_formats(spark, str(d))
    got = {r["path"].rsplit("/", 1)[-1]: (r["format"], r["json_layout"]) for r in files.collect()}
    assert got == {"one.csv": ("csv", None), "two.data": ("csv", None), "three.json": ("json", "document"),
                   "four.bin": ("geojson", None), "five.json": ("json", "lines"), "seven.json": ("json", "document")}
    rows = rd.read_detected(spark, files)
    assert sorted(int(r["id"]) for r in rows.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_empty_file_is_an_error(spark, tmp_path):
    d = tmp_path / "e"
    d.mkdir()
    _write(d / "empty.csv", "")
    files = rd.detect_formats(spark, str(d))
    # zero-length files are dropped by Spark's file listing; nothing is readable
    assert [r["format"] for r in files.collect()] in ([], ["empty"])
    with pytest.raises(rd.SourceError):
        rd.read_detected(spark, files)


def test_geojson_mixes_collections_and_features_by_line(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"name": "x"}, "geometry": {"type": "Point"}}
    p = _write(tmp_path / "m.json", json.dumps({"type": "FeatureCollection", "features": [feature, feature]}) + "\n"
               + json.dumps(feature) + "\n" + json.dumps({"type": "FeatureCollection", "features": []}) + "\n")
    assert [tuple(r) for r in rd.read_geojson(spark, p, multiline=False).collect()] == [("x", "Point")] * 3


def test_broken_json_is_an_error_not_a_row(spark, tmp_path):
    p = _write(tmp_path / "b.json", '{"results": [{"a": 1}]}\n{"results": [\n')
    with pytest.raises(rd.SourceError):
        rd.read_wrapped_json(spark, p, multiline=False)
    with pytest.raises(rd.SourceError):
        rd.read_geojson(spark, p, multiline=False)


def test_null_wrapper_holds_no_rows(spark, tmp_path):
    p = _write(tmp_path / "n.json", '{"results": null}\n{"results": [{"a": 1}]}\n{"results": []}\n')
    assert [r["a"] for r in rd.read_wrapped_json(spark, p, multiline=False).collect()] == [1]


def test_other_json_object_is_an_error(spark, tmp_path):
    p = _write(tmp_path / "o.json", json.dumps({"data": [{"a": 1}], "ok": True}, indent=1))
    with pytest.raises(rd.SourceError):
        rd.read_wrapped_json(spark, p)


def test_blank_lines_are_no_records_and_non_objects_are_corrupt(spark, tmp_path):
    p = _write(tmp_path / "c.json", '{"a": 1}\n\n   \nnot json\n{"a": 3}\n')
    good, bad = rd.read_with_quarantine(spark, p, T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r["a"] for r in good.collect()) == [1, 3]
    assert [r[rd.CORRUPT_COLUMN] for r in bad.collect()] == ["not json"]


def test_late_marker_is_geojson_and_plain_text_is_an_error(spark, tmp_path):
    d = tmp_path / "late"
    d.mkdir()
    _write(d / "a.data", json.dumps({"pad": "x" * 9000, "type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": 4}, "geometry": {"type": "Point"}}]}))
    files = rd.detect_formats(spark, str(d))
    assert [r["format"] for r in files.collect()] == ["geojson"]
    assert [r["id"] for r in rd.read_detected(spark, files).collect()] == [4]
    _write(d / "b.data", "plain words only")
    with pytest.raises(rd.SourceError):
        rd.read_detected(spark, rd.detect_formats(spark, str(d)))


def test_best_resource_prefers_csv_then_first_listed(spark):
    cat = spark.createDataFrame([
        ("d1", "JSON", "http://x/a.json", 0), ("d1", "CSV", "http://x/b", 1), ("d1", "csv", "http://x/c", 2),
        ("d2", "", "http://y/a.geojson", 0), ("d2", "HTML", "http://y/b", 1)],
        "dataset string, format string, url string, ordinal int")
    got = {r["dataset"]: (r["url"], r["rank"]) for r in rd.best_resource(cat).collect()}
    assert got == {"d1": ("http://x/b", 0), "d2": ("http://y/a.geojson", 1)}
