"""Contiguous shards of near equal bytes, from global prefix sums; DataFrame functions only.

Documents are ordered by id. Their keys and sizes, without the texts, are written in ranges of that order. A table with one row
for each range holds the bytes and rows of all ranges before it; a running sum within each range, shifted by that row, is the
global prefix sum. The line of all bytes is cut at equal targets, and a document goes to the shard that holds its middle byte,
so a shard's bytes differ from the target by half a document at either end, and no rule has to move whole groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabqual.llm.shared import fresh_name, save
from tabqual.session import shuffle_partitions

SHARDS = 24
#: Bytes of a document beside its text: the length field of a record.
RECORD_BYTES = 8


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) and of its length field."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("bigint")


def in_ranges(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows``, written, with the number of their range of ``order`` in ``range``.

    The written rows are numbered first, and the number ends the order: rows that are equal in it, however many, are spread
    over ranges too, and each row's range is settled once, whatever task is run again.
    """
    numbered = save(rows.withColumn("row_no", F.monotonically_increasing_id()), f"{name}-rows")
    ranged = numbered.repartitionByRange(shuffle_partitions(rows.sparkSession), *order, "row_no")
    return save(ranged.withColumn("range", F.spark_partition_id()), f"{name}-ranges")


def prefix_sums(ranged: DataFrame, order: list[str], size: str) -> DataFrame:
    """Adds ``before`` and ``rank``: the ``size`` and the number of all rows that precede a row, over the whole table."""
    totals = ranged.groupBy("range").agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # a row for each range, at most one for each partition
    offsets = totals.select("range", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")))
    inside = W.partitionBy("range").orderBy(*order, "row_no")
    local = ranged.withColumn("reach", F.sum(size).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    local = local.withColumn("place", F.row_number().over(inside))
    both = local.join(offsets, "range")
    before = F.col("bytes_before") + F.col("reach") - F.col(size)
    return both.withColumns({"before": before, "rank": F.col("rows_before") + F.col("place") - 1}).drop(
        "reach", "place", "bytes_before", "rows_before")


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``(id, size, crc, shard, slot)`` for every row of ``docs``; with ``carry``, ``(row, shard, slot)``, the whole row in a struct.

    Shards ascend with the id and slots count from 0 within a shard. NULL ids come last. Rows of equal ids are ordered by
    checksum and size of the text; rows equal in these too are interchangeable. NULL texts have no bytes, and the checksum of
    none. Repeated rows keep their rows. A document larger than the target may leave shards beside it empty. An empty table
    gives an empty table. Other columns have no effect.
    """
    text = F.col(text_col)
    keys = [F.col(id_col).alias("id"), record_bytes(text).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc")]
    rows = docs.select(F.col(id_col).isNull().alias("no_id"), *keys, *([F.struct(*docs.columns).alias("row")] if carry else []))
    order = ["no_id", "id", "crc", "size"]
    placed = save(prefix_sums(in_ranges(rows, order, "shards"), order, "size"), "shards-placed")
    total = placed.agg(F.sum("size")).first()[0] or 1
    cut = F.expr(f"cast(2 * before + size as decimal(20,0)) * {shards} div {2 * total}").cast("int")
    placed = placed.withColumn("shard", F.least(cut, F.lit(shards - 1)))
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # a row for each shard
    out = placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank") - F.col("first"))
    return out.select(*(["row"] if carry else ["id", "size", "crc"]), "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs`` as Parquet in a folder for each shard, in the order of their slots.

    The folders are named by a column ``shard`` and the rows keep a column ``slot`` (with ``_`` added where ``docs`` has such columns).
    A shard larger than one task's share is written as several files, each of consecutive slots.
    """
    shard, slot = fresh_name(docs, "shard"), fresh_name(docs, "slot")
    rows = assign_shards(docs, shards, id_col, text_col, carry=True)
    rows = rows.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    ranged = rows.repartitionByRange(max(shards, shuffle_partitions(docs.sparkSession)), shard, slot)
    ranged.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


#: DuckDB SQL of :func:`assign_shards` with its defaults, over the table named in ``{documents}``; crc32 from its definition.
SHARDS_SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS step FROM bits WHERE k = 8),
keys AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 8 AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
                         lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS crc
  FROM {documents}, steps),
line AS (
  SELECT *, sum(size) OVER o - size AS before, row_number() OVER o AS place, sum(size) OVER () AS total FROM keys
  WINDOW o AS (ORDER BY doc_id NULLS LAST, crc, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
placed AS (SELECT *, least(((2 * before + size)::HUGEINT * 24) // (2 * total)::HUGEINT, 23)::INTEGER AS shard FROM line)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
