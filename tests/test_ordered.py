"""The two-level prefix sum equals a whole-partition running sum."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from comms_lake.operators.ordered import prefix_sums


def test_prefix_sums_match_a_direct_window(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        profile = 0 if rnd.random() < 0.6 else rnd.randint(1, 4)          # profile 0 is a hot key
        ts = t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 9))       # nine days
        rows.append((profile, f"id{i:05d}", ts, rnd.randint(0, 1), rnd.randint(0, 3)))
    df = spark.createDataFrame(rows, "profile int, id string, ts timestamp_ntz, a int, b int")
    got = prefix_sums(df, ["profile"], ["ts", "id"], F.date_trunc("day", "ts"),
                      {"sa": F.col("a"), "sb": F.col("b") * 2})
    w = Window.partitionBy("profile").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("a").over(w).alias("sa"), (F.sum("b").over(w) * 2).alias("sb"))
    g = {r["id"]: (r["sa"], r["sb"]) for r in got.select("id", "sa", "sb").collect()}
    e = {r["id"]: (r["sa"], r["sb"]) for r in want.collect()}
    assert g == e
