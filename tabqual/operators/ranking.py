"""Order statistics that never put a whole column into one task.

* :func:`exact_quantiles` - the value at rank ``ceil(q * n)`` of each column
  (ANSI ``percentile_disc``). One scan takes a bracket around the rank from a mergeable
  KLL sketch; a second counts, for all columns at once, the values below the bracket and those in it,
  which proves or disproves the bracket and gives the exact rank.
* :func:`ordered_cumulative` - running sums over an ordering within groups
  (prefix sums). Rows are range-partitioned by (group, order) and written; each
  written partition is summed locally with a window and shifted by offsets from a table
  with one row per partition and group. A hot group is split across partitions;
  equal keys stay together, so ties are exact. The number of ranges is the caller's, by default that of shuffle partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.columns import qcol, quote
from tabqual.session import materialize, shuffle_partitions

DEFAULT_ACCURACY = 10_000


def target_rank(q: float, n: int) -> int:
    return max(1, int(math.ceil(q * n)))


def _value_type(dtype: T.DataType) -> str:
    """The type a column's values are compared and returned in; no value is rounded by it."""
    if isinstance(dtype, T.IntegralType):
        return "bigint"
    return "double" if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType) else dtype.simpleString()


def _below(value):
    """A little less: sketches round integers and decimals through doubles."""
    return value - (abs(value) >> 50) - 1 if isinstance(value, int) else \
        value - abs(value) * Decimal(2) ** -50 if isinstance(value, Decimal) else value


def _above(value):
    return -_below(-value)


# K of a quantile sketch for each unit of accuracy (8 to 65535 is allowed), the constants of its rank error with 99 %
# confidence, columns whose places below the bracket share a bit mask, and counted rows that one range of the second scan's table holds.
K_PER_ACCURACY, K_RANGE = 0.4, (8, 65_535)
ERROR_SCALE, ERROR_POWER = 2.446, 0.9433
MASK_COLUMNS = 8
ROWS_PER_RANGE = 1_000_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5, extra_aggs: Sequence[Column] = (),
                    accuracy: int = DEFAULT_ACCURACY, bounds: dict | None = None) -> tuple[dict[str, object], dict]:
    """Exact ``q``-quantile (lower, discrete: rank ``ceil(q * n)``) of each numeric column.

    The first scan (with the caller's ``extra_aggs``) counts values and brackets the rank by a KLL sketch's quantiles below and above
    it, twice the sketch's error away. ``bounds`` gives brackets ``{column: (low, high)}`` from stored sketches instead
    (:func:`tabqual.operators.sketches.merged_quantiles`). The second scan counts, for all columns and value types at once, the values of the
    brackets and those below. If a bracket was off, the counts show it, and that column is read once more in full. NaN sorts last.

    Returns ``({column: value}, extra)``; ``None`` for a column with no values.
    """
    cols, given = list(columns), bounds or {}
    k = int(min(max(K_PER_ACCURACY * accuracy, K_RANGE[0]), K_RANGE[1]))
    margin = 2 * ERROR_SCALE / k ** ERROR_POWER
    low, high = max(0.0, q - margin), min(1.0, q + margin)
    types = {f.name: _value_type(f.dataType) for f in df.schema.fields}
    aggs = list(extra_aggs)
    for i, c in enumerate(cols):
        v = quote(c)
        aggs += [F.expr(f"count({v}) AS _qn{i}"), F.expr(f"min({v}) AS _qlo{i}"), F.expr(f"max({v}) AS _qhi{i}")]
        if c not in given:
            kind = "bigint" if types[c] == "bigint" else "double"
            sketch = f"kll_sketch_agg_{kind}(CAST({v} AS {kind}), {k})"
            aggs.append(F.expr(f"CASE WHEN kll_sketch_get_n_{kind}({sketch}) > 0 THEN "
                               f"kll_sketch_get_quantile_{kind}({sketch}, array({low!r}D, {high!r}D)) END AS _qb{i}"))
    if not aggs:
        return {}, {}
    row = df.agg(*aggs).first().asDict()
    extra = {k: v for k, v in row.items() if not k.startswith("_q")}
    ranks = {c: target_rank(q, row[f"_qn{i}"]) for i, c in enumerate(cols) if row[f"_qn{i}"]}
    whole = {c: (row[f"_qlo{i}"], row[f"_qhi{i}"]) for i, c in enumerate(cols)}
    bracket = {}
    for i, c in enumerate(cols):
        if c in ranks:
            found = given.get(c) or row.get(f"_qb{i}")
            lo, hi = (_exactly(x, whole[c][0]) for x in found) if found else whole[c]
            own = c in given
            bracket[c] = (whole[c][0] if not found or (low == 0.0 and not own) else _below(lo),
                          whole[c][1] if not found or (high == 1.0 and not own) else _above(hi))
    result: dict[str, object] = {c: None for c in cols if c not in ranks}
    while len(result) < len(cols):
        left = [c for c in cols if c not in result]
        result.update(_at_ranks(df, left, types, bracket, ranks))
        bracket = {c: whole[c] for c in left}
    return {c: result[c] for c in cols}, extra


def _exactly(value, like):
    """A sketch's value as the column's Python type, so that limits compare without rounding twice."""
    if isinstance(like, Decimal):
        return Decimal(value) if math.isfinite(value) else like
    return int(value) if isinstance(like, int) else float(value)


def _at_ranks(df: DataFrame, cols: Sequence[str], types: dict, bracket: dict, ranks: dict) -> dict:
    """Values at the ranks, for the columns whose bracket holds theirs; one scan for all of them.

    A row gives one entry for each value inside a bracket, and one bit mask for every ``MASK_COLUMNS`` columns that tells which of its values
    are below theirs. So the shuffle carries the distinct values of the brackets and a few masks.
    """
    kinds = list(dict.fromkeys(types[c] for c in cols))
    slots = [f"v{j}" for j in range(len(kinds))]

    def entry(k: int, mask: Column | None = None, value: Column | None = None, kind: str | None = None) -> Column:
        own = [(value if kind == t else F.lit(None)).cast(t).alias(s) for s, t in zip(slots, kinds)]
        return F.struct(F.lit(k).alias("k"), (F.lit(None) if mask is None else mask).cast("int").alias("mask"), *own)

    entries = []
    for at in range(0, len(cols), MASK_COLUMNS):
        bits = F.lit(0)
        for bit, c in enumerate(cols[at:at + MASK_COLUMNS]):
            kind, (lo, hi) = types[c], bracket[c]
            v, lo, hi = qcol(c).cast(kind), F.lit(lo).cast(kind), F.lit(hi).cast(kind)
            bits = bits + F.when(v < lo, 1 << bit).otherwise(0)
            entries.append(F.when((v >= lo) & (v <= hi), entry(at + bit, value=v, kind=kind)))
        entries.append(entry(-1 - at, mask=bits))
    rows = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counted = materialize(rows.groupBy("k", "mask", *slots).agg(F.count(F.lit(1)).alias("n")))
    # one row for each column, and at most 2^MASK_COLUMNS for each group of them
    sums = counted.groupBy("k", "mask").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")).collect()
    below, inside, size = [0] * len(cols), [0] * len(cols), 0
    for r in sums:
        if r["k"] >= 0:
            inside[r["k"]], size = r["n"], size + r["values"]
            continue
        at = -1 - r["k"]
        for bit in range(min(MASK_COLUMNS, len(cols) - at)):
            below[at + bit] += r["n"] * (r["mask"] >> bit & 1)
    want = {i: ranks[c] - below[i] for i, c in enumerate(cols) if 0 < ranks[c] - below[i] <= inside[i]}
    if not want:
        return {}
    held = counted.where(F.col("k").isin(list(want)))
    reach = ordered_cumulative(held, ["k"], slots, ["n"], buckets=-(-size // ROWS_PER_RANGE))
    at = F.element_at(F.array(*(F.lit(want.get(i, 0)).cast("bigint") for i in range(len(cols)))), F.col("k") + 1)
    found = reach.where((F.col("n_cum") >= at) & (F.col("n_cum") - F.col("n") < at)).select("k", *slots).collect()
    return {cols[r["k"]]: r[slots[kinds.index(types[cols[r["k"]]])]] for r in found}


def with_ranges(df: DataFrame, key_cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df``, written, with the number of its key range in ``_bucket``: ascending in the key, equal keys together."""
    ranged = df.repartitionByRange(buckets or shuffle_partitions(df.sparkSession), *[qcol(c) for c in key_cols])
    return materialize(ranged.withColumn("_bucket", F.spark_partition_id()))


def ordered_cumulative(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                       sum_cols: Sequence[str], buckets: int | None = None,
                       rank_col: str | None = None, count_col: str | None = None,
                       with_totals: bool = False) -> DataFrame:
    """Add ``<c>_cum`` = sum of ``c`` over rows of the same group ordered at or before this one.

    Ties on the order columns are included (RANGE frame). ``rank_col`` adds
    the SQL ``rank()`` within the group, ``count_col`` the group size and
    ``with_totals`` the group sum ``<c>_tot`` of every summed column.
    The rows are written with the number of their range (``buckets`` of them, by default as many as shuffle
    partitions), so totals and running sums agree however often a stage is recomputed.
    """
    groups, order, sums = list(group_cols), list(order_cols), list(sum_cols)
    if buckets == 1:  # one range: nothing to shift, so the windows are over the groups themselves
        up, whole = Window.partitionBy(*groups).orderBy(*order), Window.partitionBy(*groups)
        own = {f"{c}_cum": F.sum(c).over(up) for c in sums}
        if rank_col:
            own[rank_col] = F.rank().over(up).cast("bigint")
        if count_col:
            own[count_col] = F.count(F.lit(1)).over(whole).cast("bigint")
        if with_totals:
            own |= {f"{c}_tot": F.sum(c).over(whole) for c in sums}
        return df.withColumns(own)
    bucketed = with_ranges(df, groups + order, buckets)
    local_w = Window.partitionBy("_bucket", *groups).orderBy(*order)
    local = bucketed.withColumns({f"{c}_lcum": F.sum(c).over(local_w) for c in sums})
    if rank_col:
        local = local.withColumn("_lrank", F.rank().over(local_w))
    totals = bucketed.groupBy("_bucket", *groups).agg(
        *[F.sum(c).alias(f"{c}_btot") for c in sums], F.count(F.lit(1)).alias("_bcnt"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = totals.select(
        "_bucket", *groups,
        *[F.coalesce(F.sum(f"{c}_btot").over(before), F.lit(0)).alias(f"{c}_off") for c in sums],
        F.coalesce(F.sum("_bcnt").over(before), F.lit(0)).alias("_cnt_off"),
        F.sum("_bcnt").over(whole).alias("_gcnt"),
        *[F.sum(f"{c}_btot").over(whole).alias(f"{c}_tot") for c in sums],
    )
    # null-safe keys: a NULL group value is a group of its own, as in a window
    keys = ["_bucket", *groups]
    l, o = local.alias("_l"), offsets.alias("_o")
    cond = [F.col(f"_l.{quote(k)}").eqNullSafe(F.col(f"_o.{quote(k)}")) for k in keys]
    carried = [c for c in offsets.columns if c not in keys]
    out = l.join(o, cond, "inner").select("_l.*", *[F.col(f"_o.{quote(c)}") for c in carried])
    cols = {f"{c}_cum": F.col(f"{c}_lcum") + F.col(f"{c}_off") for c in sums}
    if rank_col:
        cols[rank_col] = (F.col("_lrank") + F.col("_cnt_off")).cast("bigint")
    if count_col:
        cols[count_col] = F.col("_gcnt").cast("bigint")
    out = out.withColumns(cols)
    drop = ["_bucket", "_lrank", "_cnt_off", "_gcnt"] + [f"{c}_lcum" for c in sums] + [f"{c}_off" for c in sums]
    if not with_totals:
        drop += [f"{c}_tot" for c in sums]
    return out.drop(*[d for d in drop if d in out.columns])


def scalable_percent_rank(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                          out_col: str = "pct_in_group", buckets: int | None = None) -> DataFrame:
    """SQL ``percent_rank()`` over (partition by group order by order) without one task per group."""
    tmp = df.withColumn("_one", F.lit(1))
    ranked = ordered_cumulative(tmp, group_cols, order_cols, ["_one"], buckets=buckets,
                                rank_col="_rank", count_col="_n")
    pct = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(
        (F.col("_rank") - 1).cast("double") / (F.col("_n") - 1).cast("double"))
    return ranked.withColumn(out_col, pct).drop("_one", "_one_cum", "_rank", "_n")
