"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: a share of all words by weight, no more than ``cap`` times what it
has, the excess reshared by weight among the others. Within a source every document is expected e = min(cap, c * size)
times, with c such that the expected words meet the target. The whole part of e is allocated as certain
copies. The fraction p competes for one more copy: documents are ranked by (u / (1 - u)) / (p / (1 - p)), u being a
hash of the id, and taken in that order as long as half of the document still fits in what the target leaves.

Ranks within a source come from running sums over buckets of the rank key, so a source with most of the rows
is still sorted by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabqual.llm.shared import fresh_name, save

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: Buckets of the rank key for each doubling of it: this many, and one more for each so many rows of the source.
BUCKETS, ROWS_PER_BUCKET = 16, 20_000

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``(source, n, source_size, target)`` from rows ``(source, size)``; one row for each source, NULL being one.

    The windows run over this table of sources only.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    values = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("w", F.element_at(values, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
                                           .cast("int")))
    whole = W.partitionBy()
    full = cap * F.col("source_size").cast("double")
    per = per.select("*", full.alias("full"), (full / F.col("w")).alias("ratio"),
                     (share * F.sum("source_size").over(whole)).alias("budget"), F.sum("w").over(whole).alias("all_w"))
    # sources in the order in which they reach their cap: the level rises up to the first one that does not, then falls
    before = W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("level", (F.col("budget") - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
                         / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    per = per.withColumn("level", F.max("level").over(whole))
    return per.select("source", "n", "source_size", F.least("full", F.col("level") * F.col("w")).alias("target"))


def expected_rates(sizes: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``(source, rate)``: the c with which min(cap, c * size) adds up to the target.

    Works on the distinct sizes of each source: their number is bounded by the longest document.
    """
    hist = sizes.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("docs"))
    hist = hist.join(targets.select(F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s")))
    down = W.partitionBy("source").orderBy(F.col("size").desc())
    words, squares = F.expr("docs * size"), F.expr("cast(docs * size as decimal(38,0)) * size")
    larger = F.coalesce(F.sum(words).over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("double")
    rest = F.sum(squares).over(down.rowsBetween(0, W.unboundedFollowing)).cast("double")
    # if all larger sizes reach the cap; this rises up to the first size that does not, then falls
    hist = hist.withColumn("rate", (F.col("target") - cap * larger) / rest)
    return hist.groupBy("source").agg(F.max("rate").alias("rate"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
         share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``(id, text_key, size, source_size, target, copies)`` for every row of ``docs``.

    Sizes are words, 0 for NULL and blank texts, which get no copy. NULL is a source, ordered last. Ties in the rank key
    are broken by id, size and text; rows equal in all of these are interchangeable. NULL ids share one hash.
    An empty table gives an empty table; other columns are ignored.
    """
    sizes = save(docs.select(F.col(id_col).alias("id"), F.md5(text_col).alias("text_key"),
                             F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")),
                 "sizes")
    targets = save(source_targets(sizes, weights, share, cap), "targets")
    rates = expected_rates(sizes, targets, cap).select(F.col("source").alias("r"), "rate")
    per = targets.join(rates, F.col("source").eqNullSafe(F.col("r")), "left").select(
        F.col("source").alias("s"), "n", "source_size", "target", F.coalesce("rate", F.lit(0.0)).alias("rate"))
    per = save(per, "per-source")  # a table of known size: broadcast if small, else a join whose hot sources are split
    rows = sizes.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    u = (F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double")
         + 0.5) / F.lit(float(1 << 52))
    rows = rows.withColumn("e", F.least(F.lit(float(cap)), F.col("rate") * F.col("size")))
    rows = rows.withColumn("certain", F.floor("e").cast("bigint")).withColumn("p", F.col("e") - F.col("certain"))
    rows = save(rows.withColumn("u", u).withColumn("key", F.when(
        F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))), "ranked")
    sure = rows.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("sure")).withColumnRenamed("source", "cs")
    bucket = F.floor(F.log2("key") * (BUCKETS + F.floor(F.col("n") / ROWS_PER_BUCKET)))
    drawn = rows.filter("p > 0").withColumn("bucket", bucket)
    sums = drawn.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    up = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("bs"), F.col("bucket").alias("bb"),
                       F.coalesce(F.sum("words").over(up), F.lit(0)).alias("before"))
    sums = sums.join(sure, F.col("bs").eqNullSafe(F.col("cs")))
    drawn = drawn.join(sums, F.col("source").eqNullSafe(F.col("bs")) & (F.col("bucket") == F.col("bb")))
    order = W.partitionBy("source", "bucket").orderBy("key", "id", "size", "text_key").rowsBetween(W.unboundedPreceding, 0)
    reach = F.col("before") + F.sum("size").over(order)
    taken = (reach - F.col("size") / 2.0) <= (F.col("target") - F.col("sure"))
    columns = ["id", "text_key", "size", "source_size", "target"]
    drawn = drawn.select(*columns, (F.col("certain") + taken.cast("bigint")).alias("copies"))
    return drawn.unionByName(rows.filter("p <= 0").select(*columns, F.col("certain").alias("copies")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its number in a column ``copy`` (from 1).

    The column is named ``copy_`` if ``docs`` has a ``copy``. All other columns stay as they are.
    """
    name, key = fresh_name(docs, "copy"), fresh_name(docs, "text_key")
    chosen = plan(docs, id_col, text_col, source_col, weights, share, cap).filter("copies > 0")
    # rows equal in id and text are interchangeable: they are taken in the order of their number among equals
    own, n = fresh_name(docs, "among_equals"), "among"
    equals = W.partitionBy("id", "text_key").orderBy(F.col("copies").desc())
    chosen = chosen.select(F.col("id").alias("mix_id"), F.col("text_key").alias("mix_key"), F.col("copies").alias("mix_copies"),
                           F.row_number().over(equals).alias(n))
    keyed = docs.withColumn(key, F.md5(text_col))
    keyed = keyed.withColumn(own, F.row_number().over(W.partitionBy(id_col, key).orderBy(F.lit(1))))
    hit = (keyed[id_col].eqNullSafe(chosen["mix_id"]) & keyed[key].eqNullSafe(chosen["mix_key"])
           & (keyed[own] == chosen[n]))
    return keyed.join(chosen, hit).select(*[keyed[c] for c in docs.columns],
                                          F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias(name))


#: DuckDB SQL of :func:`plan` with its defaults, over the table named in ``{documents}``.
PLAN_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, md5(text) AS text_key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM {documents}),
named AS (
  SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM sizes GROUP BY source),
lined AS (
  SELECT *, 2.0::DOUBLE * source_size AS full_size, (2.0::DOUBLE * source_size) / w AS ratio,
         1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w FROM named),
levels AS (
  SELECT *, (budget - coalesce(sum(full_size) OVER o, 0)) / (all_w - coalesce(sum(w) OVER o, 0)) AS level FROM lined
  WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(full_size, (SELECT max(level) FROM levels) * w) AS target
  FROM levels),
hist AS (
  SELECT s.source, s.size, count(*) AS docs, any_value(t.target) AS target
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE s.size > 0 GROUP BY s.source, s.size),
cuts AS (
  SELECT source, size,
         target - 2.0::DOUBLE * coalesce(sum(docs * size) OVER (PARTITION BY source ORDER BY size DESC
                                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS room,
         (sum(docs::HUGEINT * size * size) OVER (PARTITION BY source ORDER BY size DESC
                                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rest
  FROM hist),
rates AS (SELECT source, max(room / rest) AS rate FROM cuts GROUP BY source),
draws AS (
  SELECT s.doc_id, s.text_key, s.source, s.size, t.source_size, t.target,
         least(2.0::DOUBLE, coalesce(r.rate, 0.0::DOUBLE) * s.size) AS e,
         (('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  LEFT JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
parts AS (SELECT *, floor(e)::BIGINT AS certain, e - floor(e) AS p FROM draws),
ranked AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) END AS key,
         sum(certain * size) OVER (PARTITION BY source) AS sure FROM parts),
mixed AS (
  SELECT doc_id, text_key, size, source_size, target,
         certain + CASE WHEN p > 0 AND
           sum(size) OVER (PARTITION BY source, p > 0 ORDER BY key, doc_id NULLS FIRST, size, text_key NULLS FIRST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE - size / 2.0::DOUBLE <= target - sure::DOUBLE
           THEN 1 ELSE 0 END AS copies
  FROM ranked)
"""
