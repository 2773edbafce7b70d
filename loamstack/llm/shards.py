"""Contiguous shards of near-equal size, by DataFrame operations only.

Rows are dealt into ranges of the key.  The totals of each range, summed over
the ranges before it, give every row its global prefix of bytes and rows, and the
shard is where the middle of the row falls among equal cuts of all bytes.  No key's
rows need to be in one task: ties of the key are dealt by the text's checksum.

Defined results: null keys come first; a null text has no bytes and checksum 0;
repeated rows follow each other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

SHARDS = 40
#: Bytes of a row besides its text.
ROW_BYTES = 16


def balanced_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): shard 0..shards-1 in key order, slot gapless from 0."""
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(F.col(key).alias("k"), (F.octet_length(whole) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("crc"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = store.materialize(sized, "sizes")
    dealt = store.materialize(sized.repartitionByRange(ranges, "k", "crc", "size").withColumn("range", F.spark_partition_id()), "ranges")
    # One row for each range: bounded by the number of partitions.
    totals = dealt.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("range").orderBy("k", "crc", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumns({"upto": F.sum("size").over(inside), "row": F.count("*").over(inside)}).join(F.broadcast(starts), "range")
    placed = placed.select(
        "k", "size", "crc",
        F.least(F.expr(f"int(({shards} * (2 * (bytes_before + upto) - size)) div (2 * all_bytes))"), F.lit(shards - 1)).alias("shard"),
        (F.col("rows_before") + F.col("row") - 1).alias("row"),
    )
    placed = store.materialize(placed, "placed")
    store.drop(sized)
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # as many rows as shards
    return placed.join(F.broadcast(first), "shard").select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("first")).alias("slot"))


def op8_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(store.table(spark, sf_dir, "documents"))
    return placed.select(F.col("doc_id").cast("long"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The checksum's table and fold are written out, as DuckDB has no crc32.
OP8_SQL = f"""
WITH bits AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]::BIGINT[]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256))::BIGINT AS i))),
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + {ROW_BYTES} AS size FROM documents),
c AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(0, strlen(text)), lambda k: ('0x' || substr(hx, (2 * k + 1)::BIGINT, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) AS crc
  FROM (SELECT doc_id, text, size, hex(encode(text)) AS hx, t FROM d, bits)),
p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, crc, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total,
    row_number() OVER (ORDER BY doc_id, crc, size) - 1 AS row FROM c),
s AS (SELECT *, least(({SHARDS} * (2 * upto - size)) // (2 * total), {SHARDS - 1})::INT AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard, (row - min(row) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard FROM s
"""
