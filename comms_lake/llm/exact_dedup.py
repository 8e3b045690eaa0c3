"""Exact deduplication as a stateful stream (operator 1).

The documents' digests land as a narrow table: digest of the normalised text,
stable identifier, content locator (file and row), length. A Structured
Streaming query drains it with a disk-backed (RocksDB) state keyed by digest
that never expires: per digest it retains the identifier and the locator of
the row that stays, and the number of rows. Rows are aggregated before the
shuffle, so a digest that a third of all rows share is one row per task.

A digest hit is only a candidate: the full normalised bytes of every later
row are compared with those behind the retained locator. Rows that differ
(a digest collision) are regrouped by their bytes.

Defined cases: null text counts as empty; all empty texts are one group; a
null identifier sorts after any other; among repeated rows (same identifier
and length) the first by file and row stays, so one row of each group has
``kept``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded, run_dir
from .common import drop_rows, located, stored

# The white space that equality ignores (fixed by the contract).
WHITE = " \t\n\x0b\x0c\r"
# The stream's own settings: state on disk, and no disk space set aside ahead
# (some MB in each state partition, however small).
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Rows of one group that one task compares with the group's retained row.
PART_ROWS = 256


def normalised(text: Column) -> Column:
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _state(spark: SparkSession, arrivals: str, schema, root: str, bytes_per_trigger: int) -> DataFrame:
    """Drain the landed digests; returns (digest, size, keep) per digest."""
    stream = (spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(arrivals))
    state = stream.groupBy("digest").agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.struct((-F.col("length")).alias("order"), F.col("id").isNull().alias("no_id"),
                       "id", "file", "row")).alias("keep"))
    out, batches = f"{root}/state", []

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        batches.append(number)

    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").foreachBatch(land).trigger(availableNow=True)
                 .option("checkpointLocation", f"{root}/checkpoint").start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    if not batches:
        return spark.createDataFrame([], state.schema)
    landed = spark.read.schema(state.schema).parquet(*[f"{out}/batch={b}" for b in batches])
    if len(batches) == 1:
        return landed
    return stored(landed.groupBy("digest").agg(F.max("size").alias("size"), F.min("keep").alias("keep")),
                  f"{root}/groups")


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256,
                bytes_per_trigger: int = 8 << 30) -> DataFrame:
    """One row per row of ``docs``: file, row, id, digest, size, keep_id, kept.

    ``digest`` maps the normalised text to a binary key; a weaker one only
    costs more byte checks, never a wrong group.
    """
    docs, file, row = located(docs)
    text = F.col(f"`{text_col}`")
    rows = docs.select(file.alias("file"), row.alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.length(F.coalesce(text.cast("string"), F.lit(""))).cast("long").alias("length"),
                       normalised(text).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    root = run_dir(spark, "exact-dedup")
    arrivals = stored(rows.drop("norm"), f"{root}/arrivals")
    groups = _state(spark, f"{root}/arrivals", arrivals.schema, root, bytes_per_trigger)
    result = (arrivals.join(groups, "digest")
              .select("file", "row", "id", "digest", "size", F.col("keep.id").alias("keep_id"),
                      ((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))).alias("kept")))

    collided = _collisions(rows, groups, root)
    if collided is None:
        return result
    again = rows.join(bounded(collided), "digest", "left_semi")
    exact = again.groupBy("digest", "norm").agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.struct((-F.col("length")).alias("order"), F.col("id").isNull().alias("no_id"),
                       "id", "file", "row")).alias("keep"))
    again = (again.join(exact, ["digest", "norm"])
             .select("file", "row", "id", "digest", "size", F.col("keep.id").alias("keep_id"),
                     ((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))).alias("kept")))
    return result.join(bounded(collided), "digest", "left_anti").select(*again.columns).unionByName(again)


def _collisions(rows: DataFrame, groups: DataFrame, root: str) -> DataFrame | None:
    """Compare every hit's bytes with those of the retained row; the digests
    with a difference, or None. A large group is dealt to many tasks: its
    members by a part number, its retained text once to each part."""
    hits = groups.where("size > 1").select(
        "digest", F.col("keep.file").alias("keep_file"), F.col("keep.row").alias("keep_row"),
        F.ceil(F.col("size") / PART_ROWS).cast("int").alias("parts"))
    found = rows.join(bounded(hits), "digest")
    at_keep = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    members = found.where(~at_keep).select(
        "digest", F.pmod(F.xxhash64("file", "row"), "parts").cast("int").alias("part"), "norm")
    retained = found.where(at_keep).select(
        "digest", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("norm").alias("kept_norm"))
    differ = (members.hint("merge").join(retained, ["digest", "part"])
              .where(F.col("norm") != F.col("kept_norm")).select("digest"))
    differ = stored(differ, f"{root}/collisions")
    return None if differ.isEmpty() else differ.distinct()


def keep_first(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row that stays of each group of equal texts, all columns."""
    docs, file, row = located(docs)
    out = exact_dedup(spark, docs, id_col, text_col)
    return drop_rows(docs, file, row, out.where(~F.col("kept")).select("file", "row"))
