"""Document fingerprints by I-Match with randomised lexicons, in DataFrame functions only.

Document frequencies of all terms (told apart by 64-bit hashes) are counted over the whole corpus, and the lexicon is the set of
terms within a band of inverse document frequency: of N texts, a term of the lexicon is in about N^0.5 to N^0.85. As no term of it is
in fewer than N^0.5 texts, the lexicon has at most (distinct terms of a text, in the mean) * N^0.5 terms, whatever the vocabulary.
A text keeps the distinct terms of the lexicon, sorted; it is hashed under several random subsets of the
lexicon: eight disjoint parts of it, each at rates of 1, 1/4, 1/16, ..., besides the whole lexicon. A hash under a
subset with few of the text's terms survives edits elsewhere, and the rates give such a subset to short and long texts.

A fingerprint lists the subsets' slots: the number of terms (one hex digit, f for 15 or more) and 8 hex digits of the
hash of the sorted terms, or ``-`` without terms. The likeness of two fingerprints is the share of equal slots, those
with n terms weighing 1/n^2.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabqual.llm.shared import save
from tabqual.session import shuffle_partitions

#: The lexicon's band, as shares of the largest possible inverse document frequency ln N.
BAND = (0.15, 0.5)
PARTS = 8
RATES = 5
EMPTY_SLOT = "-"


def term_hashes(text: Column) -> Column:
    """Distinct hashed terms: lower-cased runs of other characters than white space and ASCII punctuation."""
    terms = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))


def frequency_band(n: int, band=BAND) -> tuple[int, int]:
    """Smallest and largest document frequency of the lexicon among ``n`` texts: the band's ends, rounded outwards."""
    return math.floor(n ** (1 - band[1])), math.ceil(n ** (1 - band[0]))


def lexicon(docs: DataFrame, text_col: str = "text", band=BAND) -> list[int]:
    """Sorted hashes of the terms whose idf lies in the band, over all rows of ``docs``."""
    low, high = frequency_band(docs.count(), band)
    counts = docs.select(F.explode(term_hashes(F.col(text_col))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    return sorted(r["h"] for r in counts.filter(F.col("df").between(low, high)).select("h").collect())


def _in_lexicon(terms: list[int]) -> Callable[[Column], Column]:
    """Whether a hash is one of ``terms``: these are a constant of the plan, dealt out to as many cells by their low bits."""
    bits = max(0, len(terms) - 1).bit_length()
    cells: list[list[int]] = [[] for _ in range(1 << bits)]
    for t in terms:
        cells[t & ((1 << bits) - 1)].append(t)
    table = F.from_json(F.lit(json.dumps(cells)), "array<array<bigint>>")
    return lambda h: F.array_contains(F.element_at(table, (h.bitwiseAND(F.lit((1 << bits) - 1)) + 1).cast("int")), h)


def _slot(codes: Column) -> Column:
    hashed = F.substring(F.lpad(F.hex(F.xxhash64(codes)), 16, "0"), 1, 8)
    count = F.hex(F.least(F.size(codes), F.lit(15)).cast("bigint"))
    return F.when(F.size(codes) == 0, EMPTY_SLOT).otherwise(F.lower(F.concat(count, hashed)))


def _rates(part: Column) -> Column:
    """The part's codes at every rate; each rate filters what the rate before has kept."""
    def thinner(kept: Column, r: Column) -> Column:
        last = F.element_at(kept, -1)
        return F.concat(kept, F.array(F.filter(last, lambda c: F.call_function("shiftright", c, r).bitwiseAND(F.lit(3)) == 0)))
    shifts = F.array(*(F.lit(3 + 2 * r) for r in range(RATES - 1)))
    return F.aggregate(shifts, F.array(part), thinner)


def _all_slots(codes: Column) -> Column:
    parts = F.transform(F.array(*(F.lit(i) for i in range(PARTS))),
                        lambda i: F.filter(codes, lambda c: c.bitwiseAND(F.lit(PARTS - 1)) == i))
    return F.concat(F.array(_slot(codes)), F.flatten(F.transform(parts, lambda p: F.transform(_rates(p), _slot))))


def slots(text: Column, terms: list[int]) -> Column:
    """The text's slots, an array of strings. The sorted codes are bound once, as the variable of a lambda."""
    codes = F.array_sort(F.filter(term_hashes(text), _in_lexicon(terms)))
    return F.element_at(F.transform(F.array(codes), _all_slots), 1)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two slot arrays; 1 for equal ones, also if both are without terms."""
    def terms(slot: Column) -> Column:
        return F.when(slot == EMPTY_SLOT, 0).otherwise(F.conv(F.substring(slot, 1, 1), 16, 10).cast("int"))

    def pair(x: Column, y: Column) -> Column:
        n = F.greatest(terms(x), terms(y))
        weight = F.when(n > 0, F.lit(1.0) / (n * n)).otherwise(0.0)
        return F.struct(weight.alias("all"), F.when(x == y, weight).otherwise(0.0).alias("same"))

    total = F.aggregate(F.zip_with(a, b, pair), F.struct(F.lit(0.0).alias("all"), F.lit(0.0).alias("same")),
                        lambda t, p: F.struct((t["all"] + p["all"]).alias("all"), (t["same"] + p["same"]).alias("same")),
                        lambda t: F.when(t["all"] > 0, t["same"] / t["all"]).otherwise(1.0))
    return F.when(a == b, 1.0).otherwise(total)


def with_next(docs: DataFrame, order: str, tie: str, derived: dict[str, Column], carried: list[str], out: str) -> DataFrame:
    """``docs`` with the ``derived`` columns, and a struct of the ``carried`` columns of the next row in ``out``.

    Rows are ordered by ``order`` (numeric, NULLs last), then ``tie`` (hex digits); after the last row comes the first. They are
    dealt to ranges of ``order`` cut at its percentiles, one for each shuffle partition, and those without ``order`` to as many
    ranges of ``tie``; within a range a window finds the next row, and the first row of each range serves the last one of the range
    before. ``derived`` columns are computed once for each row, before it is moved.
    """
    n = shuffle_partitions(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx(F.col(order).cast("double"), [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    splits = [-math.inf, *sorted(set(cuts or [0.0])), math.inf]
    rows = Bucketizer(splits=splits, inputCol="_at", outputCol="_range", handleInvalid="keep").transform(
        docs.withColumn("_at", F.col(order).cast("double"))).drop("_at")
    of_tie = F.floor(F.conv(F.substring(tie, 1, 2), 16, 10).cast("int") * n / 256)
    rows = rows.withColumn("_range", F.when(F.col(order).isNull(), len(splits) + of_tie).otherwise(F.col("_range")).cast("int"))
    place = F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("order"), F.col(tie).alias("tie"))
    firsts = rows.select("_range", place.alias("place")).groupBy("_range").agg(F.min("place").alias("place"))
    # one row for each range
    following = F.coalesce(F.lead("place").over(W.orderBy("_range")), F.first("place").over(
        W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    firsts = save(firsts.withColumn("following", following), "firsts")
    heads = rows.withColumn("place", place).join(F.broadcast(firsts.select("place")), "place", "left_semi")
    heads = heads.dropDuplicates(["place"]).withColumns(derived).select("place", F.struct(*carried).alias("head"))
    heads = firsts.select(F.col("_range").alias("_own"), F.col("following").alias("place")).join(heads, "place").drop("place")
    up = W.partitionBy("_range").orderBy(F.col(order).asc_nulls_last(), tie)
    rows = rows.withColumns(derived).withColumn("_next", F.lead(F.struct(*carried)).over(up))
    rows = rows.join(heads, (F.col("_range") == F.col("_own")) & F.col("_next").isNull(), "left")
    return rows.withColumn(out, F.coalesce("_next", "head")).drop("_next", "head", "_range", "_own")


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by the first as many (or all) of the following text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def fingerprints(docs: DataFrame, terms: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` for every row; NULL counts as empty, and texts without terms of the lexicon are all alike."""
    return docs.select(id_col, F.array_join(slots(F.col(text_col), terms), ".").alias("fingerprint"))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and compare with these and with the next document.

    Returns ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for every row.
    The next document is the next row by id, then by text; NULL ids come last, and after the last row comes the first, so
    a lone row is its own next. NULL texts count as empty. Repeated rows keep their rows; an empty table gives an empty
    table; other columns are ignored. The id is numeric. Texts without terms of the lexicon are alike; so may be the texts of
    a corpus of few rows, whose lexicon is empty if no two of them share terms.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    terms = lexicon(rows)
    rows = rows.withColumn("tie", F.md5("text"))
    rows = with_next(rows, "id", "tie", {"slots": slots(F.col("text"), terms)}, ["text", "slots"], "next")
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next")["text"]))
    rows = rows.select("id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "slots", slots(F.col("edited"), terms).alias("edited_slots"), F.col("next")["slots"].alias("next_slots"))
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", F.array_join("slots", ".").alias("fingerprint"),
                       F.array_join("edited_slots", ".").alias("edited_fingerprint"),
                       likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
                       likeness(F.col("slots"), F.col("next_slots")).alias("near_next"))
