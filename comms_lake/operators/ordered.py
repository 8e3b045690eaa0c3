"""Ordered (sequential) semantics without whole-partition windows.

The reference walks each mailbox in time order with counters (cap, error
run, high-water mark). A window ``PARTITION BY profile ORDER BY time`` would
put a whole mailbox into one task, and a mailbox may hold a third of all
rows. ``prefix_sums`` splits the order into (profile, bucket) segments:

1. sum each value per (keys, bucket) -> a small table (keys x buckets);
2. exclusive running sum over buckets on that small table -> segment offset;
3. running sum inside each (keys, bucket) segment, plus its offset.

Only step 3 touches the rows, partitioned by (keys, bucket), so a hot
mailbox spreads over as many tasks as it has buckets (days by default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], bucket: Column,
                values: dict[str, Column]) -> DataFrame:
    """Add an inclusive running sum per ``keys`` in ``order`` for each value.

    ``bucket`` must be monotone in ``order`` (e.g. the day of the first
    order column). Output columns are named after the ``values`` keys.
    """
    tmp = {name: f"__v_{name}" for name in values}
    staged = df.withColumns({"__bucket": bucket, **{tmp[n]: e.cast("bigint") for n, e in values.items()}})
    per_bucket = staged.groupBy(*keys, "__bucket").agg(
        *[F.sum(tmp[n]).alias(f"__b_{n}") for n in values])
    over_buckets = (Window.partitionBy(*keys).orderBy("__bucket")
                    .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.select(
        *keys, "__bucket",
        *[F.coalesce(F.sum(f"__b_{n}").over(over_buckets), F.lit(0)).alias(f"__o_{n}") for n in values])
    in_bucket = (Window.partitionBy(*keys, "__bucket").orderBy(*order)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = staged.join(offsets, [*keys, "__bucket"], "inner")
    out = out.withColumns({n: F.col(f"__o_{n}") + F.sum(tmp[n]).over(in_bucket) for n in values})
    return out.drop("__bucket", *tmp.values(), *[f"__o_{n}" for n in values])
