"""Most frequent values of text columns, exact, without texts as shuffle keys.

1. One scan keeps a mergeable frequent-item summary of every column, over 64-bit hashes of its values: a value that the summary
   does not report has at most ``2 * 3.5 / map size`` of the column's rows (the summary's error, once for the counts that it lacks
   and once for those that it withholds).
2. A second scan counts the reported candidates exactly, by 128-bit digests. The column is settled if its k-th count
   is above that bound, or if the candidates' counts add up to all rows: then no other value can be among the top k.
3. Columns without such heavy values are counted by digest over all values, in a third scan.
4. Digests that can be in the top k fetch their values; ties are settled by the values themselves.

What is shuffled is a digest, a count and the first bytes of a value as numbers (which order most ties) for each distinct value
of unsettled columns; whole values are moved for the digests of step 4 only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabqual.functions.columns import quote, sql_str
from tabqual.functions.literals import literal_table
from tabqual.functions.missing import missing_sql
from tabqual.session import materialize

# Items that a summary tracks (three quarters of its map's size), the candidates taken from it, the
# summary's error as a share of the rows times the map's size, and the bytes of a value that travel with its digest as numbers.
TRACKED, CANDIDATES = 12_288, 256
MAP_SIZE = 1 << (TRACKED * 4 // 3).bit_length() - 1
ERROR = 3.5
PREFIX_PARTS, PART_BYTES = 4, 7
_PARTS = [f"p{j}" for j in range(PREFIX_PARTS)]
#: Columns of one scan: their summaries are held at once.
COLUMNS_PER_SCAN = 16


def _long(df: DataFrame, numbered: dict[int, str]) -> DataFrame:
    """``col, value`` of every present value; ``col`` is the column's number."""
    structs = [f"named_struct('col', {i}, 'value', CASE WHEN NOT {missing_sql(c)} THEN CAST({quote(c)} AS STRING) END)"
               for i, c in numbered.items()]
    return df.selectExpr(f"inline(array({', '.join(structs)}))").where("value IS NOT NULL")


def _by_digest(rows: DataFrame) -> DataFrame:
    """``col, digest, count`` of every distinct value of ``rows (col, value)``, and its first bytes in numbers that ascend with it."""
    head = rows.selectExpr("col", "unhex(md5(value)) AS digest",
                           f"rpad(hex(substring(CAST(value AS BINARY), 1, {PREFIX_PARTS * PART_BYTES})), {2 * PREFIX_PARTS * PART_BYTES}, '0') AS h")
    parts = [f"CAST(conv(substring(h, {1 + 2 * PART_BYTES * j}, {2 * PART_BYTES}), 16, 10) AS BIGINT) AS p{j}" for j in range(PREFIX_PARTS)]
    keyed = head.selectExpr("col", "digest", *parts)
    return keyed.groupBy("col", "digest").agg(F.count(F.lit(1)).cast("bigint").alias("count"), *(F.min(p).alias(p) for p in _PARTS))


def candidates(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, int], dict[str, list[int]]]:
    """Rows with a value, and the hashes of the values that the summary reports, of every column; at most ``CANDIDATES`` each."""
    totals, found = {}, {}
    for first in range(0, len(columns), COLUMNS_PER_SCAN):
        part = list(columns[first:first + COLUMNS_PER_SCAN])
        aggs = []
        for i, c in enumerate(part):
            there, h = f"FILTER (WHERE NOT {missing_sql(c)})", f"xxhash64(CAST({quote(c)} AS STRING))"
            aggs += [F.expr(f"count(1) {there} AS n{i}"),
                     F.expr(f"approx_top_k_estimate(approx_top_k_accumulate({h}, {TRACKED}) {there}, {CANDIDATES}) AS top{i}")]
        row = df.agg(*aggs).first()
        for i, c in enumerate(part):
            totals[c], found[c] = row[f"n{i}"], [t["item"] for t in row[f"top{i}"] or [] if t["item"] is not None]
    return totals, found


def _settled(counts: list[int], total: int, k: int) -> bool:
    """Whether the exact counts of a column's candidates show that no other value is among the top ``k``."""
    if sum(counts) == total:
        return True
    if len(counts) < k or len(counts) >= CANDIDATES:  # a full list may have more behind it
        return False
    return sorted(counts, reverse=True)[k - 1] > 2 * ERROR / MAP_SIZE * total


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """``column, value, count``: the ``k`` most frequent present values of every column as text; ties: smaller values first.

    A column without a value has no rows. An empty table gives an empty table. Digests of 128 bits stand for values.
    """
    spark, schema = df.sparkSession, "column string, value string, count bigint"
    cols = list(columns)
    if not cols or k < 1:
        return literal_table(spark, [], schema)
    totals, found = candidates(df, cols)
    numbers = {c: i for i, c in enumerate(cols) if totals[c]}
    listed = [(numbers[c], h) for c in numbers for h in found[c]]
    counted, settled = None, set()
    if listed:
        wanted = literal_table(spark, listed, "c int, h bigint")  # at most CANDIDATES rows for each column
        rows = _long(df, {numbers[c]: c for c in numbers if found[c]})
        hit = (F.col("col") == F.col("c")) & (F.xxhash64("value") == F.col("h"))
        counted = materialize(_by_digest(rows.join(F.broadcast(wanted), hit, "left_semi")))
        exact: dict[int, list[int]] = {}
        for r in counted.select("col", "count").collect():
            exact.setdefault(r["col"], []).append(r["count"])
        settled = {c for c, i in numbers.items() if _settled(exact.get(i, []), totals[c], k)}
        counted = counted.where(F.col("col").isin([numbers[c] for c in settled])) if settled else None
    rest = {numbers[c]: c for c in numbers if c not in settled}
    if rest:
        own = materialize(_by_digest(_long(df, rest)))
        counted = own if counted is None else counted.unionByName(own)
    if counted is None:
        return literal_table(spark, [], schema)
    order = Window.partitionBy("col").orderBy(F.desc("count"), *_PARTS)
    place = F.struct((-F.col("count")).alias("less"), *_PARTS)
    # the place of the k-th digest: nothing behind it can be among the top k, whatever follows its first bytes
    last = counted.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    last = last.groupBy("col").agg(F.max(place).alias("last"))
    within = place <= F.col("last")
    winners = materialize(counted.join(F.broadcast(last), "col").where(within).select("col", "digest", "count"))
    chosen = {r["col"] for r in winners.select("col").distinct().collect()}
    rows = _long(df, {i: c for c, i in numbers.items() if i in chosen}).selectExpr("col", "unhex(md5(value)) AS digest", "value")
    values = rows.join(winners, ["col", "digest"]).groupBy("col", "digest").agg(F.any_value("value").alias("value"), F.any_value("count").alias("count"))
    final = Window.partitionBy("col").orderBy(F.desc("count"), F.asc("value"))
    names = F.element_at(F.array(*(F.lit(c) for c in cols)), F.col("col") + 1)
    best = values.withColumn("rn", F.row_number().over(final)).where(F.col("rn") <= k)
    return best.select(names.alias("column"), "value", "count")
