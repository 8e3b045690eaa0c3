"""State tables written run by run and compacted (K4, K5): ids, internet ids, marks, outcomes.

A run writes its rows once, under its number and by profile bucket. Every
``EVERY`` runs the runs that have ended are merged into a new base, a few sorted files a
bucket; a pointer, written last, names the base that counts and the run up to which it
holds. A reader takes that base and the few runs after it, so what a run reads
grows with the rows of its buckets and not with the number of runs before it.

A base that was not finished is never named. The runs that the base before the
last one held, and the bases before that, are deleted: a run that is replayed
after a crash is later than both, so it reads and writes the same rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .landed import path_exists

EVERY = 8


class RunTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, every: int = EVERY):
        """``schema`` has the columns ``run`` and ``bucket``."""
        self.spark, self.path, self.schema, self.every = spark, path, schema, every
        self.columns = [c.strip().split()[0] for c in schema.split(",")]

    def _fs(self):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, folder: str, key: str) -> list[int]:
        path = os.path.join(self.path, folder)
        if not path_exists(self.spark, path):
            return []
        names = [f.getPath().getName() for f in self._fs().listStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{key}="))

    def base(self) -> int:
        """The last run that the base holds; -1 without one."""
        return max(self._numbers("pointers", "upto"), default=-1)

    def save(self, rows: DataFrame, run: int, bucket) -> None:
        (rows.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(os.path.join(self.path, "runs", f"run={run}")))

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the runs before ``before`` (all) in some buckets (all): the base's and those after it."""
        base = self.base()
        parts = []
        if base >= 0 and (before is None or base < before):
            parts.append(self.spark.read.schema(self.schema).parquet(os.path.join(self.path, "bases", f"upto={base}")))
        else:
            base = -1
        later = [r for r in self._numbers("runs", "run") if r > base and (before is None or r < before)]
        if later:
            parts.append(self.spark.read.schema(self.schema).option("basePath", os.path.join(self.path, "runs"))
                         .parquet(*[os.path.join(self.path, "runs", f"run={r}") for r in later]))
        out = self.spark.createDataFrame([], self.schema) if not parts else parts[0].select(*self.columns)
        for part in parts[1:]:
            out = out.unionByName(part.select(*self.columns))
        return out if buckets is None else out.filter(F.col("bucket").isin(buckets))

    def compact(self, ended: int) -> bool:
        """A new base of all runs up to ``ended`` once ``every`` of them are not in the last one."""
        base = self.base()
        if ended - base < self.every:
            return False
        here = os.path.join(self.path, "bases", f"upto={ended}")
        (self.read(ended + 1).hint("rebalance", "bucket").sortWithinPartitions("bucket", self.columns[0], self.columns[1])
         .write.mode("overwrite").partitionBy("bucket").parquet(here))
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, "pointers", f"upto={ended}"))
        for old in self._numbers("runs", "run"):
            if old <= base:
                self._delete("runs", f"run={old}")
        for old in self._numbers("bases", "upto"):
            if old < base:
                self._delete("bases", f"upto={old}")
                self._delete("pointers", f"upto={old}")
        return True

    def _delete(self, folder: str, name: str) -> None:
        self._fs().delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, folder, name)), True)
