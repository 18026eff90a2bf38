"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of distinct shingles into classes of sizes
(u/2, u]. The MinHash sketch of an item is its m smallest shingle hashes, where
m = u - ceil(t * u) + 1 belongs to the class: a document that holds at least the share t of an
item's shingles lacks fewer than m of them, so it holds one of the sketch at least.
Hence the search misses nothing, at any document length; a document is looked up only in the classes
whose smallest items are not too large for its own size. Candidates are then verified by exact
containment of the shingles themselves, as word sequences and not as hashes.

The items are the stated query set: their sketches go to the tasks in blocks of at most ``block_items``
items, and every block is searched in all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.llm import tokens
from tabqual.llm.shared import fresh_name, map_pandas, save

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BLOCK_ITEMS = 20_000
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def word_list(text: str | None) -> list[str]:
    """Lower-cased runs of ASCII letters and digits and non-ASCII characters."""
    return _WORD.findall(text.lower()) if isinstance(text, str) else []


def shingle_set(text: str | None, k: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    """Distinct runs of ``k`` words; the whole sequence if there are fewer words, none if there is no word."""
    w = word_list(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def size_class(size: int) -> int:
    """Upper bound of the class (u/2, u] of a size of 1 or more."""
    return 1 << (size - 1).bit_length()


def sketch_size(upper: int, threshold: float) -> int:
    """Sketch length with which no item of the class escapes; for smaller sizes of the class fewer would do."""
    return upper - math.ceil(threshold * upper - 1e-9) + 1


def item_sketches(items: DataFrame, id_col: str, text_col: str, k: int, threshold: float) -> DataFrame:
    """``(id, text, size, class, sketch)``; items without a word have no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for first, buf, starts in tokens.chunks(b["text"]):
                h, at = tokens.shingles(*tokens.words(buf, starts), k)
                for i in range(len(starts) - 1):
                    own = np.unique(h[at[i]:at[i + 1]])
                    if len(own):
                        upper = size_class(len(own))
                        out.append((b["id"].iloc[first + i], b["text"].iloc[first + i], len(own), upper,
                                    own[:sketch_size(upper, threshold)].view(np.int64)))
            yield pd.DataFrame(out, columns=["id", "text", "size", "class", "sketch"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    return map_pandas(rows, run, f"id {kind}, text string, size bigint, class bigint, sketch array<bigint>")


class _Block:
    """Sketches of a block of items, sorted by hash, one table per size class."""

    def __init__(self, items: list, k: int, threshold: float):
        self.items = [(r["id"], r["text"]) for r in items]
        self.k, self.threshold, self.sets = k, threshold, {}
        self.classes = []
        for upper in sorted({r["class"] for r in items}):
            rows = [(h, i) for i, r in enumerate(items) if r["class"] == upper for h in r["sketch"]]
            h = np.array([x for x, _ in rows], np.int64).view(np.uint64)
            order = np.argsort(h, kind="stable")
            least = min(r["size"] for r in items if r["class"] == upper)
            self.classes.append((math.ceil(threshold * least - 1e-9), h[order], np.array([i for _, i in rows])[order]))

    def shingles(self, i: int) -> set:
        if i not in self.sets:
            self.sets[i] = shingle_set(self.items[i][1], self.k)
        return self.sets[i]

    def candidates(self, hashes: np.ndarray, at: np.ndarray) -> dict[int, set[int]]:
        """Items by document of a chunk: a sketch hash is among the document's shingles."""
        found: dict[int, set[int]] = {}
        sizes = np.diff(at)
        doc_of = np.repeat(np.arange(len(sizes)), sizes)
        for least, table, item in self.classes:
            lo = np.searchsorted(table, hashes)
            hit = np.flatnonzero((table[np.minimum(lo, len(table) - 1)] == hashes) & (sizes[doc_of] >= least))
            for x in hit:
                j = lo[x]
                own = found.setdefault(int(doc_of[x]), set())
                while j < len(table) and table[j] == hashes[x]:
                    own.add(int(item[j]))
                    j += 1
        return found

    def matches(self, texts: pd.Series) -> Iterator[tuple[int, int, int, int]]:
        """``(row, item, item's shingles, those the row holds)`` with containment at the threshold or more."""
        for first, buf, starts in tokens.chunks(texts):
            hashes, at = tokens.shingles(*tokens.words(buf, starts), self.k)
            for d, items in sorted(self.candidates(hashes, at).items()):
                own = shingle_set(texts.iloc[first + d], self.k)
                for i in sorted(items):
                    item = self.shingles(i)
                    common = len(item & own)
                    if common >= self.threshold * len(item) - 1e-9:
                        yield first + d, i, len(item), common


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
               item_id: str = "item_id", item_text: str = "text", shingle_words: int = SHINGLE_WORDS,
               threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_common, containment)`` for every document row and item that it contains.

    Containment is the share of the item's distinct shingles that the document holds, ``threshold`` at least.
    A text shorter than a shingle counts as one shingle of its whole word sequence, so such an item is found
    only in documents of just these words. NULL texts and texts without words match nothing. Repeated rows and
    NULL ids keep their rows; empty tables give an empty table; other columns are ignored.
    """
    sketches = save(item_sketches(items, item_id, item_text, shingle_words, threshold), "items")
    total = sketches.count()
    n_blocks = max(1, -(-total // block_items))
    d_kind, i_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, doc_id), (items, item_id)))
    schema = f"doc_id {d_kind}, item_id {i_kind}, n_shingles bigint, n_common bigint, containment double"
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text")).filter("text is not null")
    out = None
    for block in range(n_blocks):
        own = sketches.filter(F.pmod(F.xxhash64("text", F.col("id").cast("string")), F.lit(n_blocks)) == block)
        shared = docs.sparkSession.sparkContext.broadcast(_Block(own.collect(), shingle_words, threshold))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            b = shared.value
            for pdf in batches:
                ids = pdf["doc_id"]
                rows = [(ids.iloc[r], b.items[i][0], n, c, c / n) for r, i, n, c in b.matches(pdf["text"])]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_shingles", "n_common", "containment"])

        found = map_pandas(texts, run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that contain a test item; all columns as they are."""
    key = fresh_name(docs, "text_key")
    keyed = docs.withColumn(key, F.md5(text_col))
    tag = F.struct(F.col(id_col).alias("id"), F.col(key).alias("key"))
    leaks = save(find_leaks(keyed.select(tag.alias("doc_id"), F.col(text_col).alias("text")), items,
                            item_id=item_id, item_text=item_text).select("doc_id.*").distinct(), "leaks")
    hit = keyed[id_col].eqNullSafe(leaks["id"]) & (keyed[key] == leaks["key"])
    return keyed.join(leaks, hit, "left_anti").select(*docs.columns)
