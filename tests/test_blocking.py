"""Operators built on the blocked scan give the same answer for any block width
on real data (carries crossing many block boundaries)."""

from pyspark.sql import functions as F

from tidewater.operators import keyed, lateness, scan, windows
from tidewater.plans import change_queries, jobs


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_session_windows_any_block(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")]
    cols = ["user_id", "session_start", "session_end", "n"]
    big = windows.session(ev, "ts", 36000, "user_id", aggs, seq="event_id")
    tiny = windows.session(ev, "ts", 36000, "user_id", aggs, seq="event_id", block_size=60_000_000)
    assert _rows(big, cols) == _rows(tiny, cols)


def test_merged_sessions_equal_scanned_ones_any_block(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("value", keyed.exact("value"))
    parts = {"n": ("count", None), "s": ("sum", "value"), "top": ("max", "value")}
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.max("value").alias("top")]
    cols = ["user_id", "session_start", "session_end", "n", "s", "top"]
    want = _rows(windows.session(ev, "ts", 36000, "user_id", aggs, seq="event_id"), cols)
    for block in (24 * scan.HOUR_MICROS, 60_000_000, 7 * scan.HOUR_MICROS, 10**15):
        assert _rows(windows.session_merged(ev, "ts", 36000, "user_id", parts, block_size=block), cols) == want


def test_merged_sessions_of_nulls_ties_and_no_keys(spark):
    df = spark.createDataFrame([(None, 0, 1), (None, 10, 2), ("a", 21, 4), ("a", 21, 8), ("a", None, 16), ("a", 40, None)],
                               "k string, s long, v long").withColumn("ts", F.timestamp_seconds("s"))
    parts = {"t": ("sum", "v"), "n": ("count", None)}

    def got(keys, block):
        out = windows.session_merged(df, "ts", 10, keys, parts, block_size=block)
        return sorted(((*(r[k] or "" for k in keys), r["t"], r["n"]) for r in out.collect()), key=str)
    for block in (1_000_000, 15_000_000, 10**12):
        assert got(["k"], block) == [("", 3, 2), ("a", 12, 2), ("a", None, 1)]
        assert sorted(r["n"] for r in windows.session_merged(df, "ts", 11, [], parts, block_size=block).collect()) == [1, 4]
    assert windows.session_merged(df.limit(0), "ts", 10, "k", parts).count() == 0


def test_running_and_count_windows_any_block(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    a = keyed.running_sum(ev, "event_type", "event_id", "value", exact_scale=2)
    b = keyed.running_sum(ev, "event_type", "event_id", "value", exact_scale=2, block_size=7)
    assert _rows(a, ["event_id", "running"]) == _rows(b, ["event_id", "running"])
    c = windows.count_sliding(ev, "user_id", "event_id", 5, 3, F.col("value"), "s")
    d = windows.count_sliding(ev, "user_id", "event_id", 5, 3, F.col("value"), "s", block_size=5)
    assert _rows(c, ["user_id", "fire_at", "s"]) == _rows(d, ["user_id", "fire_at", "s"])


def test_lateness_any_block(spark, sf):
    j = change_queries.jittered_events(spark, sf).withColumn("value", keyed.exact("value"))
    a = lateness.refire(lateness.classify(j, "event_id", "event_time", 3600, 1800, 1800),
                        ["user_id"], "event_id", "value")
    b = lateness.refire(lateness.classify(j, "event_id", "event_time", 3600, 1800, 1800, block_size=3),
                        ["user_id"], "event_id", "value", block_size=2)
    cols = ["user_id", "window_start", "fire_no", "trigger_id", "value_sum"]
    assert _rows(a, cols) == _rows(b, cols)


def test_order_timeout_any_block(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").withColumn("reviewed", F.pmod("o_orderkey", F.lit(2)) == 0)
    a = jobs.timeout_review(o, "o_custkey", "o_orderkey", "o_orderdate", "reviewed", 30 * 86400)
    old = scan.HOUR_MICROS
    try:
        scan.HOUR_MICROS = 60_000_000  # 24 "hours" = 24 minutes per block
        b = jobs.timeout_review(o, "o_custkey", "o_orderkey", "o_orderdate", "reviewed", 30 * 86400)
        rows_b = _rows(b, ["order_id", "action", "action_time"])
    finally:
        scan.HOUR_MICROS = old
    assert _rows(a, ["order_id", "action", "action_time"]) == rows_b
