"""Ranked search: against brute force over all documents, with blocks skipped, odd rows, and the query against its SQL."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tabqual.llm import queries, search

TERM = re.compile(search.TERM)


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, top):
    """``[(item, rank, doc, score)]`` for lists of ``(id, text)``."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        own = set(terms(text))
        scored = []
        for i, c, n in held:
            m = 50 + (50 * n * n_docs) // n_terms
            s = sum(w[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def got(df):
    return sorted(map(repr, map(tuple, df.select("id", "rank", "doc_id", "score").collect())))


def zipf_docs(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    vocab = [f"w{i}" if i % 7 else f"Ö{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    docs = []
    for i in range(n):
        words = rnd.choices(vocab, weights, k=int(rnd.paretovariate(1.2) * 8) % 3000 + 1)
        if i % 50 == 0:
            words += ["w1"] * 700  # a term frequency of two bytes
        docs.append((i * 3 % n, rnd.choice([" ", ", ", "-"]).join(words)))
    items = [(q, " ".join(rnd.choices(vocab, k=rnd.randint(1, 30))).upper().replace("Ö", "Ö")) for q in range(25)]
    return docs, items


@pytest.mark.parametrize("shard_docs, block, top", [(1 << 16, 64, 50), (150, 4, 5), (37, 2, 1), (400, 8, 2000)])
def test_ranks_agree_with_brute_force(spark, monkeypatch, shard_docs, block, top):
    docs, items = zipf_docs(shard_docs, 1200)
    monkeypatch.setattr(search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(search, "BLOCK", block)
    got_rows, skipped = local(docs, items, top)
    assert got_rows == sorted(map(repr, brute(docs, items, top)))
    assert skipped > 0 or top > 5


def local(docs, items, top):
    """The operator's own steps, run here on one task's batches, and the share of blocks that stayed compressed."""
    import numpy as np
    import pandas as pd
    held = [(i, t) for i, t in docs]
    counts = [len(terms(t)) for _, t in held]
    n_docs, n_terms = sum(c > 0 for c in counts), sum(counts)
    batches = [pd.DataFrame(held[a:a + 100], columns=["id", "text"]) for a in range(0, len(held), 100)]
    shards = pd.concat(list(search._build(iter(batches), n_docs, n_terms)))
    asked = pd.concat(list(search._query_terms(iter([pd.DataFrame(items, columns=["number", "text"])]))))
    block = [(n, np.asarray(t, np.int64).view(np.uint64)) for n, t in zip(asked["number"], asked["terms"])]
    wanted = np.unique(np.concatenate([t for _, t in block]))
    df = next(search._frequencies(iter([shards]), wanted))
    weights = np.zeros(len(wanted), np.int64)
    weights[np.searchsorted(wanted, df["term"].to_numpy().view(np.uint64))] = [
        math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df["df"]]
    qs = [(n, np.searchsorted(wanted, t)) for n, t in block]
    made = []

    class Watched(search.Shard):
        def __init__(self, *args):
            super().__init__(*args)
            self.queries = 0
            made.append(self)

        def best(self, lists, weights, floor, top):
            self.queries += int(sum(self.begin[lists + 1] - self.begin[lists]))
            return super().best(lists, weights, floor, top)

    whole, search.Shard = search.Shard, Watched
    try:
        out = pd.concat(list(search._search(iter([shards]), wanted, weights, [(n, p[weights[p] > 0]) for n, p in qs], n_docs, n_terms, top)))
    finally:
        search.Shard = whole
    rows = []
    for number, own in out.groupby("number"):
        rows += [(number, r, int(d), int(s)) for r, (d, s) in enumerate(zip(own["doc_id"], own["score"]), 1)]
    return sorted(map(repr, rows)), sum(s.queries - s.decompressed for s in made)


def test_many_tasks_and_blocks_of_queries(spark, monkeypatch):
    docs, items = zipf_docs(5, 900)
    monkeypatch.setattr(search, "BLOCK_TERMS", 60)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    index = search.build_index(df)
    out = search.search(index, spark.createDataFrame(items, "item_id long, text string"), top=7)
    assert got(out) == sorted(map(repr, brute(docs, items, 7)))


def test_odd_rows_and_clashing_columns(spark):
    docs = [(1, "same words here"), (1, "same words here"), (None, "same words here"), (2, None), (3, ""), (4, "..."), (5, "rare " * 70_000),
            (6, "words ½ x²"), (7, "a\x00b other")]
    items = [(1, "same rare"), (1, "SAME rare"), (2, None), (3, "?"), (None, "b ½ x²"), (4, "unknown"), (5, "words words")]
    clash = {c: F.lit(7) for c in ("id", "number", "terms", "rank", "score", "block", "ids", "n")}
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash))
    out = search.search(index, spark.createDataFrame(items, "item_id long, text string").withColumns(clash))
    assert got(out) == sorted(map(repr, brute(docs, items, 50)))


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, "a"), (2, "")], [(1, "a")]), ([], [])])
def test_small_tables(spark, docs, items):
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    out = search.search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == ["id", "rank", "doc_id", "score"] and got(out) == sorted(map(repr, brute(docs, items, 50)))


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_CHECK])
def test_query_matches_its_sql(spark, duck, sf_dir):
    con = duck(sf_dir)
    mine, sql = queries.QUERIES["op13_search"](spark, sf_dir), queries.ORACLE_SQL["op13_search"]
    want = con.execute(sql).fetchall()
    assert mine.columns == [c[0] for c in con.description]
    assert sorted(map(tuple, mine.collect())) == sorted(want) and len(want) > 500
