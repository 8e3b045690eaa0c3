"""Session helpers.

The cluster owns its configuration; these helpers only fill gaps (tests,
bench) and never override a value the session already carries.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; applied only when the session has no value.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "comms_lake") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, small shuffles)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply DEFAULT_CONF keys the session does not set yet."""
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session and never changed. Only a local
    session (one JVM, as in tests) may go without: its context then gets a
    scratch folder. On a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="comms-lake-"))
    return sc.getCheckpointDir()


def run_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared folder for one run. It is deleted when
    the application ends (a lazy result may be read until then)."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    return path


def materialize(df, name: str = "stage"):
    """Cut lineage: write ``df`` once as parquet under the shared checkpoint
    folder and read it back.

    Used where one intermediate feeds several branches (so it is not
    recomputed per branch) and where a lost executor must not replay a long
    lineage. One write job; the re-read carries file statistics for AQE and
    supports column pruning. Never a local checkpoint.
    """
    path = os.path.join(run_dir(df.sparkSession, name), "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A side joined by broadcast has at most this many rows of a few small
# columns (about 100 bytes each in a hash relation, so some 20 MB); beyond it
# the same join shuffles.
BROADCAST_ROWS = 200_000


def bounded(side, limit: int = BROADCAST_ROWS):
    """``side`` with a broadcast hint if it has ``limit`` rows at most
    (counted), else as it is."""
    from pyspark.sql import functions as F
    return F.broadcast(side) if side.limit(limit + 1).count() <= limit else side


def literal_table(spark: SparkSession, rows: list[tuple], schema: str):
    """Small fixed table as a local relation (with size statistics, so the
    planner can broadcast it), unlike ``createDataFrame`` on a list."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)])
               for r in rows]
    if not structs:
        return spark.createDataFrame([], st)
    return spark.range(1).select(F.inline(F.array(*structs)))


def with_params(df, params):
    """Attach a one-row parameter table (e.g. the run time) to every row as
    scalar subqueries: each value is computed once, then used as a
    constant; no join (and so no cartesian product) is planned."""
    return df.withColumns({c: params.select(c).scalar() for c in params.columns})
