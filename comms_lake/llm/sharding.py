"""Sharding by proportional stratified interleaving (operator 3), native.

Rows of each source are shuffled by a seeded hash and ranked. Rank r of n
becomes the fraction (r + 1/2) / n. All rows are sorted by that fraction, so
any stretch of the order has every source in proportion, and the order is cut
into ``shards`` stretches whose row counts differ by one at most (the law
``rows``).

Neither order needs one task to hold a source or the table. A rank is the
rows in the buckets before (``BUCKETS`` equal ranges of the hash, or of the
fraction) plus the rank inside the bucket: two small running sums over at most
``BUCKETS`` counts per source, and windows over one bucket of one source, or
one bucket of the fraction. A source with a third of all rows is spread over
all its buckets.

Defined cases: null text has no bytes; null sources are a source of their
own; rows with null identifiers are sharded like others; equal identifiers
are told apart by the text's checksum and size, and rows equal in all of
those are interchangeable; fewer rows than shards leave some shards empty; an
empty table gives an empty result. Shards depend on the rows alone, not on
their files or order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import run_dir
from .common import stored

SHARDS, SEED = 40, 20_240
BUCKETS = 4096
FRAME = 16  # bytes that a stored row takes besides its text


def _before(counts: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """Rows in earlier buckets of the same ``by``: at most ``BUCKETS`` counts are summed in a window."""
    order = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source", buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: id, source, size, text_crc32, shard, slot (from 0 in each shard)."""
    root = run_dir(spark, "sharding")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = stored(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        (F.octet_length(text) + FRAME).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32")).withColumn(
            "h", F.xxhash64(F.lit(seed), "id", "text_crc32", "size")), f"{root}/rows")
    stratum = ["known", "unnamed"]
    rows = rows.select("*", F.coalesce("source", F.lit("")).alias("known"), F.col("source").isNull().alias("unnamed"),
                       F.pmod("h", F.lit(buckets)).cast("int").alias("bucket"))

    # rank within the source
    counts = rows.groupBy(*stratum, "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(*stratum).agg(F.sum("n").alias("total"))
    offsets = _before(counts, stratum, "bucket").join(sizes, stratum).select(*stratum, "bucket", "before", "total")
    inside = Window.partitionBy(*stratum, "bucket").orderBy("h", "id", "text_crc32", "size")
    ranked = (rows.withColumn("place", F.row_number().over(inside)).join(offsets, [*stratum, "bucket"])
              .withColumn("rank", F.col("before") + F.col("place") - 1))
    # 2 rank + 1 of 2 total: the fraction, as a bucket and exactly
    ranked = stored(ranked.select(
        "id", "source", "size", "text_crc32", "h", ((2 * F.col("rank") + 1) / (2 * F.col("total"))).alias("fraction"),
        F.floor((2 * F.col("rank") + 1) * F.lit(buckets) / (2 * F.col("total"))).cast("int").alias("bucket"),
        F.xxhash64(F.lit(seed), *stratum).alias("turn")), f"{root}/ranked")

    # place in the whole order, and the cut
    counts = ranked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    n = max(1, rows.count())
    inside = Window.partitionBy("bucket").orderBy("fraction", "turn", "source", "h", "id", "text_crc32", "size")
    placed = (ranked.withColumn("place", F.row_number().over(inside)).join(_before(counts, [], "bucket"), "bucket")
              .withColumn("at", (F.col("before") + F.col("place") - 1).cast("long")))
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", F.expr(f"cast((at * {shards}) div {n} as int)"))
            .select("id", "source", "size", "text_crc32", "shard", (F.col("at") - first).cast("long").alias("slot")))
