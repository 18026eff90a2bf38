"""Joins of stored tables that shuffle nothing when they run.

Both sides are written once as bucketed, sorted tables in the shared folder, by the join keys and a salt. Each further join reads matching buckets
side by side: the merge join has no exchange. Keys that hold more rows than a bucket should are salted: their rows are dealt out over
several buckets, and the other side's rows of these keys, and of these alone, are stored once for every salt.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabqual.functions.columns import qcol, quote
from tabqual.operators.incremental import row_hash_sql
from tabqual.session import materialize, shared_path

SALT = "_join_salt"


@dataclass
class JoinLayout:
    """Keys, number of buckets, and the hot keys with their number of salts (fewer rows than there are buckets)."""

    keys: list[str]
    buckets: int
    hot: DataFrame


def plan_layout(rows: DataFrame, keys: Sequence[str], buckets: int) -> JoinLayout:
    """Layout for joins of ``rows``, the side that may hold hot keys, on ``keys``.

    A key is hot with more than one bucket's equal share of the rows, so there are fewer hot keys than buckets, whatever the data.
    """
    counts = materialize(rows.groupBy(*[qcol(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")))
    share = max(1, int(counts.agg(F.sum("_n")).first()[0] or 0) // buckets)
    hot = counts.where(F.col("_n") > share).select(*[qcol(k) for k in keys], F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    return JoinLayout(list(keys), buckets, materialize(hot))


def _salts(rows: DataFrame, layout: JoinLayout) -> tuple[DataFrame, Column]:
    """``rows`` with the salts of their key beside them, and that number (1 for keys that are not hot)."""
    hot = layout.hot.select(*[qcol(k).alias(f"_hot_{i}") for i, k in enumerate(layout.keys)], "_salts")
    cond = F.lit(True)
    for i, k in enumerate(layout.keys):
        cond = cond & rows[quote(k)].eqNullSafe(hot[f"_hot_{i}"])
    return rows.join(F.broadcast(hot), cond, "left"), F.coalesce("_salts", F.lit(1))


def _store(rows: DataFrame, layout: JoinLayout, columns: Sequence[str]) -> DataFrame:
    name = f"stored_{uuid.uuid4().hex}"
    keys = [*layout.keys, SALT]
    (rows.select(*[qcol(c) for c in columns], SALT).repartition(layout.buckets, *[qcol(k) for k in keys])
         .write.bucketBy(layout.buckets, *keys).sortBy(*keys).option("path", shared_path(rows.sparkSession, name)).saveAsTable(name))
    return rows.sparkSession.table(name)


def store_spread(rows: DataFrame, layout: JoinLayout) -> DataFrame:
    """The side with hot keys as a bucketed table: every row once, those of a hot key dealt out by a hash of the whole row and its copies' number."""
    both, salts = _salts(rows, layout)
    # equal rows of a hot key are told apart by where they are read, so copies of one row are dealt out too
    own = F.expr(row_hash_sql(rows, 3))
    return _store(both.withColumn(SALT, F.pmod(own + F.spark_partition_id(), salts.cast("bigint")).cast("int")), layout, rows.columns)


def store_replicated(rows: DataFrame, layout: JoinLayout) -> DataFrame:
    """The other side: every row once, those of a hot key once for each of its salts."""
    both, salts = _salts(rows, layout)
    return _store(both.withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1))), layout, rows.columns)


def join_stored(spread: DataFrame, replicated: DataFrame, layout: JoinLayout, how: str = "inner") -> DataFrame:
    """Join of two stored tables on the layout's keys; ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    Other kinds would return rows of the replicated side more than once. A NULL key matches nothing, as in SQL. Empty sides are fine.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unknown join {how!r}")
    return spread.join(replicated.hint("merge"), [*layout.keys, SALT], how).drop(SALT)
