"""SimHash near-duplicates by covering locality-sensitive hashing.

Each text gets a 64-bit majority fingerprint of its word shingles. Structured bit masks
("covering" families) give tables in which every pair within the radius must collide:
the bit positions are dealt to the non-zero vectors of GF(2)^(r+1), and the mask of a
vector a keeps the positions whose vector has an odd product with a. Any r positions
span at most r dimensions, so some a is orthogonal to all of them and its mask keeps
none of the bits that differ.

Within a table no pairs are listed. A bucket of two distinct fingerprints is compared
directly. The members of larger buckets, near copies mostly, are linked through
midpoints: two fingerprints at distance 2 or less share a value at distance 1 or less
from both, and all members of such a value's ball (at most 65, fingerprints being distinct)
lie within distance 2 of one another. Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.llm.components import connected_components
from tabqual.llm.shared import fresh_name, map_pandas, save

SEED = 42
_BLOCK = 1 << 14


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Majority fingerprint of the text's shingles, repeats included; 0 where there is no word."""
    if not isinstance(text, str):
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(shingle_words, len(words))
    begin, end = (ends - lengths)[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(begin), _BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[at:at + _BLOCK], end[at:at + _BLOCK])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(begin), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``(id, text_key, fingerprint)``: the 64 bits as a signed long, and the text's MD5 (NULL for NULL)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle_words) for t in b["text"]], np.uint64)
            yield pd.DataFrame({"id": b["id"], "text_key": b["text_key"], "fingerprint": fp.view(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.md5(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return map_pandas(rows, run, f"id {kind}, text_key string, fingerprint bigint")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits, as signed longs."""
    n = (1 << (radius + 1)) - 1
    out = []
    for a in range(1, n + 1):
        m = sum(1 << i for i in range(64) if bin((i % n + 1) & a).count("1") % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def linked(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(u, v)`` whose components equal those of all pairs within ``radius`` bits.

    ``distinct`` holds distinct values in a column ``fingerprint``. The midpoint step needs radius 2.
    """
    if radius != 2:
        raise ValueError("the midpoint step is exact for a radius of 2 bits")
    tables = F.array(*(F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(covering_masks(radius))))
    rows = distinct.select("fingerprint", F.inline(tables))
    buckets = save(rows.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fingerprint").alias("u"),
                                                F.max("fingerprint").alias("v")).filter("n > 1"), "buckets")
    pairs = buckets.filter("n = 2").filter(F.bit_count(F.expr("u ^ v")) <= radius).select("u", "v")
    members = rows.join(buckets.filter("n > 2").select("t", "key"), ["t", "key"], "left_semi")
    members = members.select("fingerprint").distinct()
    near = F.array(F.col("fingerprint"), *(F.expr(f"fingerprint ^ shiftleft(1L, {i})") for i in range(64)))
    balls = members.select("fingerprint", F.explode(near).alias("middle")).groupBy("middle").agg(
        F.collect_set("fingerprint").alias("ball")).filter(F.size("ball") > 1)
    stars = balls.select(F.explode("ball").alias("u"), F.array_min("ball").alias("v")).filter("u <> v")
    return pairs.unionByName(stars)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
            radius: int = 2) -> DataFrame:
    """``(id, text_key, fingerprint, component, component_id)`` for every row of ``docs``."""
    rows = save(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    distinct = save(rows.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct")
    parts = connected_components(linked(distinct, radius)).withColumnRenamed("node", "fingerprint")
    named = distinct.join(parts, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "component").drop("least"), "fingerprint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    radius: int = 2) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id that links reach, the row's own included.
    NULL, empty and blank texts have fingerprint zero and link like any other. Equal texts share a fingerprint.
    NULL ids keep their row and are never the smallest (NULL if a component has no other). Repeated rows stay
    repeated; an empty table gives an empty table; other columns are ignored.
    """
    return grouped(docs, id_col, text_col, shingle_words, radius).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
             radius: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id (NULL ids last).

    Rows that repeat that id are told apart by their text's MD5, and of rows equal in both any one stays.
    All columns are returned as they are; an empty table stays empty.
    """
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("text_key").isNull().alias("no_text"), "text_key")
    best = grouped(docs, id_col, text_col, shingle_words, radius).groupBy("component").agg(F.min(rank).alias("best"))
    best = best.select(F.col("best.id").alias("best_id"), F.coalesce("best.text_key", F.lit("")).alias("best_key"))
    key = fresh_name(docs, "text_key")
    keyed = docs.withColumn(key, F.coalesce(F.md5(text_col), F.lit("")))
    kept = keyed.join(best, keyed[id_col].eqNullSafe(best["best_id"]) & (keyed[key] == best["best_key"]), "left_semi")
    return kept.dropDuplicates([id_col, key]).select(*docs.columns)
