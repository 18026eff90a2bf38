"""NULLs in any column, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from tabqual.llm import decontaminate, imatch, language, mixing, secrets, simhash, suffixes, surrogates, toxicity, urls

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [
    (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 10), (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 10),
    (1, "another text under the same id", "en", None, 3), (2, None, "fr", "b", None), (3, "", None, "b", 0), (4, " \t\n", "de", "c", 3),
    (None, "no id but some words here", "en", "a", 5), (None, "no id but some words here", "en", "a", 5), (None, None, None, None, None),
    (5, LONG, "en", "a", len(LONG)), (6, "!!! 123 ???", "es", "d", 9), (7, "x" * 3000, "de", "d", 3000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["id", "row_key", "text_key", "rank", "spans", "own", "copy", "u", "v", "score", "n", "key", "size", "slots", "next", "label"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def wide(odd):
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(EXTRA)])


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "word1 word2 word3 word4 word5 word6"),
                                  (4, "!!! 123 ???"), (4, "!!! 123 ???")], "item_id long, text string")


@pytest.fixture(scope="module")
def model(odd):
    return language.learn(odd, F.lit(True), sample_per_language=50)


OPERATORS = {
    "leaks": lambda d, items, m: decontaminate.find_leaks(d, items),
    "language": lambda d, items, m: language.identify(d, m),
    "repeats": lambda d, items, m: suffixes.remove_repeats(d),
    "simhash": lambda d, items, m: simhash.near_duplicates(d),
    "mix": lambda d, items, m: mixing.plan(d),
    "imatch": lambda d, items, m: imatch.compare_with_edits(d),
    "surrogates": lambda d, items, m: surrogates.replace_entities(d),
    "secrets": lambda d, items, m: secrets.scan(d),
    "toxicity": lambda d, items, m: toxicity.score(d, toxicity.learn(
        d, d.select("doc_id", F.pmod("n_chars", F.lit(2)).alias("y")), label_col="y", languages=m)),
}
PER_ROW = sorted(set(OPERATORS) - {"leaks"})


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_have_results(odd, items, model, name):
    out = OPERATORS[name](odd, items, model).collect()
    if name in PER_ROW:
        assert len(out) == len(ODD)
    else:
        assert {(r["doc_id"], r["item_id"]) for r in out} == {(1, 1), (5, None), (6, 4)} and len(out) == 5


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables_give_empty_tables(empty, items, model, name):
    assert OPERATORS[name](empty, items, model).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"surrogates", "toxicity"}))
def test_extra_columns_do_not_clash(odd, wide, items, model, name):
    plain = sorted(map(repr, OPERATORS[name](odd, items, model).collect()))
    assert sorted(map(repr, OPERATORS[name](wide, items, model).collect())) == plain


def test_no_items_give_no_leaks(odd, items):
    assert decontaminate.find_leaks(odd, items.limit(0)).count() == 0


def test_urls_of_empty_and_one_sided_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.UrlFilter().fit(none).judge(none).count() == 0
    blocked = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None), (2, "http://b.com/x"), (3, "")],
                                    "page_id long, url string")
    out = urls.UrlFilter().fit(blocked).judge(blocked).collect()
    assert len(out) == 5 and {r["verdict"] for r in out} == {"block"}


def test_nothing_to_learn_from(spark, odd):
    assert language.learn(odd, F.lit(False)) is None
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}
    flat = toxicity.learn(odd, odd.select("doc_id", F.lit(0).alias("y")), label_col="y")
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(odd, flat).collect())


def test_rows_without_a_letter_are_dropped_without_a_model_too(odd):
    kept = language.drop_unknown(odd, None).collect()
    assert kept and all(any(c.isalpha() for c in r["text"] or "") for r in kept)
    assert len(kept) == sum(any(c.isalpha() for c in r["text"] or "") for r in odd.collect())


def test_defined_results_of_odd_rows(odd, model):
    langs = {(r["doc_id"], r["lang_pred"] == "und", r["score"] == 0.0) for r in language.identify(odd, model).collect()}
    assert {(2, True, True), (3, True, True), (4, True, True), (6, True, True)} <= langs and (5, False, False) in langs
    zero = [r for r in simhash.near_duplicates(odd).collect() if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and {r["component_id"] for r in zero} == {2}
    sizes = {r["id"]: (r["size"], r["copies"]) for r in mixing.plan(odd).collect() if r["id"] in (2, 3, 4)}
    assert sizes == {2: (0, 0), 3: (0, 0), 4: (0, 0)}


# ---------------------------------------------------------------- stages

@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_handle_odd_and_empty_documents(spark, odd, empty, wide, stage):
    name, fn = stage
    last = stage is corpus_pipeline.STAGES[-1]
    for docs in (odd, empty, wide):
        out = fn(spark, docs, SF_SMALL)
        extra = ["copy_" if "copy" in docs.columns else "copy"] if last else []
        assert out.columns == docs.columns + extra
        rows = out.collect()
        assert not rows if docs is empty else rows


def test_keep_one_of_each_group(odd):
    kept = sorted((r["doc_id"] if r["doc_id"] is not None else -1, (r["text"] or "")[:9]) for r in simhash.keep_one(odd).collect())
    assert kept == [(-1, "no id but"), (1, "another t"), (1, "the quick"), (2, ""), (5, "word0 wor"), (6, "!!! 123 ?"), (7, "xxxxxxxxx")]


def test_pipeline_agrees_with_its_stages_by_brute_force(spark):
    """Each stage's decisions, from the rows that the one before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    kept = {r["doc_id"]: r for r in docs.collect()}
    assert all(any(c.isalpha() for c in r["text"]) for r in kept.values())
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    kept = {i: r for i, r in kept.items() if groups[i] == i}
    test = [s for s in (decontaminate.shingle_set(r["text"]) for r in items) if s]
    clean = {}
    for i, r in kept.items():
        own = decontaminate.shingle_set(r["text"])
        if not any(len(s & own) >= 0.8 * len(s) for s in test):
            clean[i] = r
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in out} <= set(clean)
    sources = {}
    for r in clean.values():
        sources.setdefault(r["source"], []).append(len(r["text"].split()))
    for s, sizes in sources.items():
        taken = sum(len(r["text"].split()) for r in out if r["source"] == s)
        assert 0 < taken <= 2 * sum(sizes)
    for r in out:
        text = clean[r["doc_id"]]["text"]
        spans = surrogates.entities(text)
        assert (r["text"] != text) == bool(spans) and r["n_chars"] == len(r["text"])


def test_library_works_without_the_subpackage(tmp_path):
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/tabqual", tmp_path / "tabqual", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = list(e.queries()); assert 'top_values' in n and not any(x.startswith('op1') for x in n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})


def test_number_characters_are_no_letters(spark, odd, model):
    rows = spark.createDataFrame([(1, "½ ²"), (2, "Ⅷ ① 12 _ …"), (3, "½ é"), (4, "山"), (5, "ʰ")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(rows, model).collect()}
    assert {i for i, v in got.items() if v == "und"} == {1, 2}
    assert {r["doc_id"] for r in language.drop_unknown(rows, model).collect()} == {3, 4, 5}


def test_surrogates_keep_a_column_named_like_their_count(spark):
    rows = spark.createDataFrame([(1, "Mail ann.lee@site.example.com", "own", 7, 8)],
                                 "doc_id long, text string, n_entities string, text_key int, Redraws int")
    out = surrogates.replace_entities(rows).collect()[0]
    assert out["n_entities"] == "own" and out["n_entities_"] == 1 and (out["text_key"], out["Redraws"]) == (7, 8)
    assert "ann.lee" not in out["text"]


def test_toxicity_ignores_columns_of_its_own_names(spark, odd, wide):
    flat = toxicity.learn(odd, odd.select("doc_id", F.lit(0).alias("y")), label_col="y")
    plain = sorted(map(repr, toxicity.score(odd, flat).collect()))
    assert sorted(map(repr, toxicity.score(wide, flat).collect())) == plain
