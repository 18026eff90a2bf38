"""Ranked lexical search by Block-Max MaxScore over an inverted index of shards.

The index has one row for each shard of a few megabytes of documents: a sorted term table and, for each term, its postings in
compressed blocks of 16, with the first and last document and the largest impact of every block outside the compressed part.
An impact is what a term adds to a document's score, short of the term's weight; it is an integer, so bounds are exact.

A task takes the queries of a block to one shard after another and carries each query's heap and its threshold along. Lists are
ordered by their list-wide bounds. Those whose bounds add up to less than the threshold are non-essential: no document in them
alone can reach it. Documents of the essential lists are candidates; list-wide bounds, then the maxima of the very blocks that
would hold a candidate, reject most of them before any block of a non-essential list is decompressed.
The heaps of all tasks are merged by rank. Queries go in blocks of bounded size against all shards.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabqual.llm import tokens
from tabqual.llm.shared import map_pandas, save
from tabqual.session import ensure_checkpoint_dir

#: A term: a run of ASCII letters, ASCII digits and characters beyond ASCII. Terms are cut by the byte table of ``tokens``, which
#: has the same classes.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
BLOCK = 16
#: A shard ends at this many bytes of text or documents (a document's number in its shard has two bytes).
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 16
#: Shards of an index file: what a reader holds at once.
SHARDS_PER_FILE = 16
#: Query terms in a block of queries; a longer query is a block of its own.
BLOCK_TERMS = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Columns of a shard and what their bytes hold.
LAYOUT = {"ids": np.int64, "no_id": np.bool_, "length": np.int64, "terms": np.uint64, "counts": np.int32, "peaks": np.int32, "wide": np.uint8,
          "first": np.uint16, "last": np.uint16, "block_peaks": np.int32, "gaps": np.uint8, "wide_gaps": np.uint16, "tfs": np.uint8,
          "wide_tfs": np.uint32}
SCHEMA = ", ".join(f"{c} binary" for c in LAYOUT)


@dataclass(frozen=True)
class Index:
    """A written index with the statistics that its impacts depend on."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1, ... (counts[i] of them), one span after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _tokenised(texts) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """``(first row, term hashes, first term of each row, bytes)`` of every chunk of texts."""
    for first, buf, starts in tokens.chunks(texts, lower=False):
        yield first, *tokens.words(_LOWER[buf], starts), len(buf)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with a term, and terms with their repeats, of a task's texts."""
    docs = terms = 0
    for pdf in batches:
        for _, _, first, _ in _tokenised(pdf["text"]):
            docs, terms = docs + int((np.diff(first) > 0).sum()), terms + int(first[-1])
    yield pd.DataFrame({"docs": [docs], "terms": [terms]})


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


# ---------------------------------------------------------------- index

def _pack(parts: list, ids: list, lengths: list, n_docs: int, n_terms: int) -> pd.DataFrame:
    """One shard from its postings ``(hash, document, tf)``, in order of documents."""
    term, doc, tf = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    ids, lengths = pd.concat(ids), np.concatenate(lengths)
    m = 50 + (50 * lengths * n_docs) // max(n_terms, 1)
    order = np.argsort(term, kind="stable")
    term, doc, tf = term[order], doc[order], tf[order]
    begin = np.flatnonzero(np.concatenate((np.ones(min(len(term), 1), bool), term[1:] != term[:-1])))
    counts = np.diff(np.append(begin, len(term)))
    blocks = -(-counts // BLOCK)
    at = np.repeat(begin, blocks) + BLOCK * _spans(np.zeros(len(begin), np.int64), blocks)
    size = np.diff(np.append(at, len(term)))
    impact = _impacts(tf, m[doc])
    gaps = np.diff(doc, prepend=0)
    gaps[at] = 0
    over = lambda a: np.maximum.reduceat(a, at) if len(at) else a
    wide_gap, wide_tf = over(gaps) > 255, over(tf) > 255
    per_gap, per_tf = np.repeat(wide_gap, size), np.repeat(wide_tf, size)
    block_peaks = over(impact)
    held = {"ids": ids.fillna(0), "no_id": ids.isna(), "length": lengths, "terms": term[begin], "counts": counts,
            "peaks": np.maximum.reduceat(impact, begin) if len(begin) else impact, "wide": wide_gap + 2 * wide_tf, "first": doc[at],
            "last": doc[at + size - 1], "block_peaks": block_peaks, "gaps": gaps[~per_gap], "wide_gaps": gaps[per_gap], "tfs": tf[~per_tf],
            "wide_tfs": tf[per_tf]}
    return pd.DataFrame({c: [np.asarray(held[c]).astype(kind).tobytes()] for c, kind in LAYOUT.items()})


def _build(batches: Iterator[pd.DataFrame], n_docs: int, n_terms: int) -> Iterator[pd.DataFrame]:
    parts, ids, lengths, docs, size = [], [], [], 0, 0
    for pdf in batches:
        for row, h, first, n_bytes in _tokenised(pdf["text"]):
            n = len(first) - 1
            if docs and (docs + n > SHARD_DOCS or size + n_bytes > SHARD_BYTES):
                yield _pack(parts, ids, lengths, n_docs, n_terms)
                parts, ids, lengths, docs, size = [], [], [], 0, 0
            doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(first))
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.flatnonzero(np.concatenate((np.ones(min(len(h), 1), bool), (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))))
            parts.append((h[new], doc[new] + docs, np.diff(np.append(new, len(h)))))
            ids.append(pdf["id"].iloc[row:row + n].astype("Int64"))
            lengths.append(np.diff(first))
            docs, size = docs + n, size + n_bytes
    if docs:
        yield _pack(parts, ids, lengths, n_docs, n_terms)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Write an index of every row of ``docs`` below the shared folder. Ids are whole numbers or NULL; a NULL text has no terms.

    Terms are told apart by 64-bit hashes. Texts go in whole; a text larger than a shard is a shard of its own. Repeated
    rows are documents of their own. An empty table gives an empty index. Other columns have no effect.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sizes = map_pandas(rows.select("text"), _count, "docs bigint, terms bigint")  # a row for each task
    n_docs, n_terms = sizes.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    shards = map_pandas(rows, lambda batches: _build(batches, n_docs, n_terms), SCHEMA)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabqual-llm/index-{uuid.uuid4().hex}"
    shards.write.option("maxRecordsPerFile", SHARDS_PER_FILE).option("compression", "zstd").parquet(path)
    return Index(spark.read.schema(SCHEMA).parquet(path), n_docs, n_terms)


# ---------------------------------------------------------------- one shard

class Shard:
    """A shard's arrays; postings stay compressed until their blocks are asked for."""

    def __init__(self, row, n_docs: int, n_terms: int):
        for c, kind in LAYOUT.items():
            setattr(self, c, np.frombuffer(getattr(row, c), kind))
        self.m = 50 + (50 * self.length * n_docs) // max(n_terms, 1)
        blocks = -(-self.counts // BLOCK)
        self.begin = _starts(blocks)  # the first block of each list, one entry more
        size = np.full(self.begin[-1], BLOCK, np.int64)
        size[self.begin[1:] - 1] = self.counts - BLOCK * (blocks - 1)
        self.size = size
        self.wide_gap, self.wide_tf = (self.wide & 1).astype(bool), (self.wide & 2).astype(bool)
        self.gap_at = np.where(self.wide_gap, _starts(size * self.wide_gap)[:-1], _starts(size * ~self.wide_gap)[:-1])
        self.tf_at = np.where(self.wide_tf, _starts(size * self.wide_tf)[:-1], _starts(size * ~self.wide_tf)[:-1])
        self.decompressed = 0

    def decompress(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the postings in ``blocks`` of one list, ascending."""
        size = self.size[blocks]
        self.decompressed += len(blocks)

        def stream(at: np.ndarray, wide: np.ndarray, narrow_data: np.ndarray, wide_data: np.ndarray) -> np.ndarray:
            w = wide[blocks]
            if not w.any():
                return narrow_data[_spans(at[blocks], size)].astype(np.int64)
            out, per = np.empty(size.sum(), np.int64), np.repeat(w, size)
            out[per] = wide_data[_spans(at[blocks[w]], size[w])]
            out[~per] = narrow_data[_spans(at[blocks[~w]], size[~w])]
            return out

        gaps, tf = stream(self.gap_at, self.wide_gap, self.gaps, self.wide_gaps), stream(self.tf_at, self.wide_tf, self.tfs, self.wide_tfs)
        run, head = np.cumsum(gaps), np.cumsum(size) - size  # a block's first gap is 0
        docs = run - np.repeat(run[head] - self.first[blocks], size)
        return docs, _impacts(tf, self.m[docs])

    def blocks_of(self, one: int, docs: np.ndarray) -> np.ndarray:
        """For every document the block of list ``one`` that would hold it, -1 for none."""
        lo, hi = self.begin[one], self.begin[one + 1]
        at = lo + np.searchsorted(self.last[lo:hi], docs)
        inside = at < hi
        inside[inside] = self.first[at[inside]] <= docs[inside]
        return np.where(inside, at, -1)

    def complete(self, docs: np.ndarray, score: np.ndarray, lists: np.ndarray, weights: np.ndarray, floor: int) -> tuple:
        """Candidates that reach ``floor`` with what ``lists`` (largest bounds first) add, and their scores."""
        keep = score + (weights * self.peaks[lists]).sum() >= floor
        docs, score = docs[keep], score[keep]
        # what every list may add at most, from the blocks that would hold the candidates
        blocks, more = [], []
        most = score.copy()
        for one, w in zip(lists, weights):
            at = self.blocks_of(one, docs)
            blocks.append(at)
            more.append(np.where(at >= 0, w * self.block_peaks[at].astype(np.int64), 0))
            most += more[-1]
        live = np.flatnonzero(most >= floor)  # places of the remaining candidates
        for at, gain_most, w in zip(blocks, more, weights):
            at = at[live]
            held = live[at >= 0]
            if len(held):
                own, impact = self.decompress(np.unique(at[at >= 0]))
                place = np.minimum(np.searchsorted(own, docs[held]), len(own) - 1)
                gain = np.where(own[place] == docs[held], w * impact[place], 0)
                score[held] += gain
                most[held] += gain - gain_most[held]
                live = live[most[live] >= floor]
        return docs[live], score[live]

    def best(self, lists: np.ndarray, weights: np.ndarray, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with a score of ``floor`` or more that may be among the ``top`` best of the shard, and their scores."""
        bounds = weights * self.peaks[lists]
        order = np.argsort(-bounds, kind="stable")
        lists, weights = lists[order], weights[order]
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # what a list and those after it add at most
        seeking, essential = floor <= 1, 0
        score = np.zeros(len(self.m), np.int64)
        while essential < len(lists) and rest[essential] >= floor:
            docs, impact = self.decompress(np.arange(self.begin[lists[essential]], self.begin[lists[essential] + 1]))
            score[docs] += weights[essential] * impact
            essential += 1
            if seeking and np.count_nonzero(score) >= top:  # scores so far are a threshold for the whole ones
                floor = max(floor, int(np.partition(score, len(score) - top)[len(score) - top]))
        docs = np.flatnonzero(score)
        return self.complete(docs, score[docs], lists[essential:], weights[essential:], floor)


# ---------------------------------------------------------------- search

def _frequencies(batches: Iterator[pd.DataFrame], wanted: np.ndarray) -> Iterator[pd.DataFrame]:
    """``(term, df)`` of the wanted terms (hashes, sorted), summed over the shards of a task."""
    df = np.zeros(len(wanted), np.int64)
    for pdf in batches:
        for row in pdf.itertuples():
            terms, counts = np.frombuffer(row.terms, np.uint64), np.frombuffer(row.counts, np.int32)
            at, found = _find(terms, wanted)
            df[found] += counts[at[found]]
    yield pd.DataFrame({"term": wanted.astype(np.int64)[df > 0], "df": df[df > 0]})


def _find(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of every wanted term in the sorted ``terms``, and whether it is there."""
    at = np.minimum(np.searchsorted(terms, wanted), max(len(terms) - 1, 0))
    return at, terms[at] == wanted if len(terms) else np.zeros(len(wanted), bool)


def _search(batches: Iterator[pd.DataFrame], wanted: np.ndarray, weights: np.ndarray, queries: list, n_docs: int, n_terms: int,
            top: int) -> Iterator[pd.DataFrame]:
    """The heap of every query over the shards of a task. ``queries``: ``(number, places of its terms in wanted)``."""
    heaps = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries]
    for pdf in batches:
        for row in pdf.itertuples():
            shard = Shard(row, n_docs, n_terms)
            at, found = _find(shard.terms, wanted)
            for q, (_, places) in enumerate(queries):
                mine, (score, ids, no_id) = places[found[places]], heaps[q]
                docs, new = shard.best(at[mine], weights[mine], int(score[-1]) if len(score) == top else 1, top)
                if len(docs):
                    score, ids, no_id = (np.concatenate(x) for x in ((score, new), (ids, shard.ids[docs]), (no_id, shard.no_id[docs])))
                    best = np.lexsort((ids, no_id, -score))[:top]
                    heaps[q] = score[best], ids[best], no_id[best]
    for (number, _), (score, ids, no_id) in zip(queries, heaps):
        if len(score):
            yield pd.DataFrame({"number": number, "doc_id": pd.Series(ids).astype("Int64").mask(no_id), "score": score})


def _query_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for row, h, first, _ in _tokenised(pdf["text"]):
            own = [np.unique(h[a:b]).astype(np.int64) for a, b in zip(first[:-1], first[1:])]
            yield pd.DataFrame({"number": pdf["number"].iloc[row:row + len(own)].to_numpy(), "terms": own})


def search(index: Index, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """``(id, rank, doc_id, score)``: the ``top`` best documents with a score above 0 of every row of ``queries``.

    Equal scores rank by ascending document id, NULL ids last; documents equal in both are interchangeable. A query's terms
    count once each. A query without terms, or with none that the index holds, has no rows. Repeated queries, also under
    one id, have their rows each. An empty index or table gives an empty table; other columns have no effect.
    """
    spark = queries.sparkSession
    rows = save(queries.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                "queries")
    terms = save(map_pandas(rows.select("number", "text"), _query_terms, "number bigint, terms array<bigint>"), "query-terms")
    n_blocks = max(1, -(-int(terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]) // BLOCK_TERMS))
    terms = terms.filter(F.size("terms") > 0).withColumn("block", F.pmod(F.xxhash64("number"), F.lit(n_blocks)))
    n_docs, n_terms, parts = index.n_docs, index.n_terms, []
    for b in range(n_blocks):
        block = [(r["number"], np.array(r["terms"], np.int64).view(np.uint64)) for r in terms.filter(F.col("block") == b).collect()]
        if not block:
            continue
        wanted = np.unique(np.concatenate([t for _, t in block]))
        counted = map_pandas(index.shards.select("terms", "counts"), lambda x, wanted=wanted: _frequencies(x, wanted), "term bigint, df bigint")
        found = counted.groupBy("term").agg(F.sum("df").alias("df")).collect()  # at most the block's terms
        weights = np.zeros(len(wanted), np.int64)
        for r in found:
            at = np.searchsorted(wanted, np.array(r["term"]).astype(np.int64).view(np.uint64))
            weights[at] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        asked = [(number, at[weights[at] > 0]) for number, t in block for at in [np.searchsorted(wanted, t)]]
        parts.append(map_pandas(index.shards, lambda x, w=wanted, ws=weights, qs=asked: _search(x, w, ws, qs, n_docs, n_terms, top),
                                "number bigint, doc_id bigint, score bigint"))
    if not parts:
        return rows.limit(0).select("id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    heaps = parts[0]
    for p in parts[1:]:
        heaps = heaps.unionByName(p)
    order = W.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(rows.select("number", "id"), "number").select("id", "rank", "doc_id", "score")


#: DuckDB SQL of the query over ``{documents}`` and ``{benchmark}``.
SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {documents}),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, corpus GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {benchmark}),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms)))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), corpus GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""
