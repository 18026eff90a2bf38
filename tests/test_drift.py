"""JSON lines with changing fields: types that merge, types that do not, and lines that are no objects."""

from tabqual.sources import drift


def read(spark, tmp_path, *files):
    for i, lines in enumerate(files):
        (tmp_path / f"{i}.json").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return drift.read_drifting_json(spark, str(tmp_path))


def test_fields_of_all_files_are_kept(spark, tmp_path):
    got = read(spark, tmp_path, ['{"a": 1, "b c": "x"}', '{"a": 9223372036854775807}'], ['{"a": 2.5, "OBJECT<": [1, 2], "n": null}', '{"e": {"f": true}}'])
    types = {f.name: f.dataType.simpleString() for f in got.rows.schema.fields}
    assert set(types) == {"a", "b c", "OBJECT<", "n", "e"} and types["e"] == "struct<f:boolean>" and types["n"] == "string" and got.drifted == []
    rows = {(None if r["a"] is None else float(r["a"]), r["b c"], tuple(r["OBJECT<"] or ()), r["e"] and r["e"]["f"]) for r in got.rows.collect()}
    assert rows == {(1.0, "x", (), None), (float(2 ** 63 - 1), None, (), None), (2.5, None, (1, 2), None), (None, None, (), True)}


def test_types_that_do_not_merge_become_text(spark, tmp_path):
    got = read(spark, tmp_path, ['{"a": 1, "k": 1}', '{"a": "one", "k": 2}'], ['{"a": {"b": [1]}, "k": 3}', '{"a": null, "k": 4}', '{"k": 5}', '{"a": true, "k": 6}'])
    assert got.drifted == ["a"]
    assert {r["k"]: r["a"] for r in got.rows.collect()} == {1: "1", 2: "one", 3: '{"b":[1]}', 4: None, 5: None, 6: "true"}


def test_other_lines_are_kept_apart(spark, tmp_path):
    got = read(spark, tmp_path, ['{"a": 1}', '{"a": ', "[1]", "", "  ", "7"], ['{"a": 1}'])
    assert sorted(r["value"] for r in got.broken.collect()) == ["7", "[1]", '{"a": ']
    assert [r["a"] for r in got.rows.collect()] == [1, 1]


def test_fields_named_like_types(spark, tmp_path):
    got = read(spark, tmp_path, ['{"VOID": 1, "OBJECT": null, "a`b": 2, "l": [null]}'])
    assert got.rows.first().asDict() == {"VOID": 1, "OBJECT": None, "a`b": 2, "l": [None]}


def test_no_lines(spark, tmp_path):
    got = read(spark, tmp_path, [""])
    assert got.rows.columns == [] and got.broken.count() == 0
