"""Stream-stream joins and streaming dedup agree with the batch operators; M5 CLI."""

import uuid

from pyspark.sql import functions as F

from conftest import run_available_now
from tidewater.functions.timecols import as_event_time
from tidewater.operators import joins, keyed, routing
from tidewater.plans import wordcount_job
from tidewater.streaming import jobs


def _events(spark, sf, path):
    ev = as_event_time(spark.read.parquet(f"{sf}/events.parquet"), "ts") \
        .select("event_id", "ts", "user_id", "event_type", keyed.exact("value").alias("value"))
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    n, step = 4, (hi - lo) // 4 + 1
    for i in range(n):  # contiguous id ranges = time order, as a stream would deliver them
        ev.where((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step)) \
            .coalesce(1).write.parquet(f"{path}/b{i}")
    return ev


def _stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_interval_join_stream_matches_batch(spark, sf, tmpdir_path):
    ev = _events(spark, sf, f"{tmpdir_path}/in")
    left = _stream(spark, ev.schema, f"{tmpdir_path}/in")
    right = _stream(spark, ev.schema, f"{tmpdir_path}/in").where("event_type = 'purchase'")
    j = jobs.interval_join_stream(left, right, "user_id", "ts", "ts", -7200, 3600, "1 day")
    got = run_available_now(j.select(F.col("l.event_id").alias("a"), F.col("r.event_id").alias("b")),
                            "ij_" + uuid.uuid4().hex[:6])
    exp = joins.interval_join(ev, ev.where("event_type = 'purchase'"), "user_id", "ts", "ts", -7200, 3600) \
        .select(F.col("l.event_id").alias("a"), F.col("r.event_id").alias("b")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp)) and len(exp) > 0


def test_window_join_stream_matches_batch(spark, sf, tmpdir_path):
    ev = _events(spark, sf, f"{tmpdir_path}/in")
    left = _stream(spark, ev.schema, f"{tmpdir_path}/in")
    right = _stream(spark, ev.schema, f"{tmpdir_path}/in").where("event_type = 'purchase'")
    j = jobs.window_join_stream(left, right, "user_id", "ts", "ts", 36000, "1 day")
    got = run_available_now(j.select(F.col("l.event_id").alias("a"), F.col("r.event_id").alias("b")),
                            "wj_" + uuid.uuid4().hex[:6])
    exp = joins.window_join(ev, ev.where("event_type = 'purchase'"), "user_id", "ts", "ts", 36000) \
        .select(F.col("l.event_id").alias("a"), F.col("r.event_id").alias("b")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp)) and len(exp) > 0


def test_union_distinct_stream(spark, sf, tmpdir_path):
    ev = _events(spark, sf, f"{tmpdir_path}/in")
    s = _stream(spark, ev.schema, f"{tmpdir_path}/in")
    a = s.where("value > 50").select("ts", "user_id", "event_type")
    b = s.where("value > 20").select("ts", "user_id", "event_type")
    got = run_available_now(jobs.union_distinct_stream(a, b, ts="ts", delay="1 hour"), "ud_" + uuid.uuid4().hex[:6])
    exp = routing.union_distinct(ev.where("value > 50").select("ts", "user_id", "event_type"),
                                 ev.where("value > 20").select("ts", "user_id", "event_type")).count()
    assert len(got) == exp


def test_wordcount_cli(spark, tmpdir_path):
    src = f"{tmpdir_path}/words.txt"
    with open(src, "w") as f:
        f.write("lemon hadoop spark\nlemon hadoop spark\nlemon hadoop\nlemon\n")
    out = f"{tmpdir_path}/out"
    wordcount_job.main(["--input", src, "--output", out, "--files", "2"])
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(hadoop,3)", "(lemon,4)", "(spark,2)"]


def test_session_and_sliding_streams_match_batch_closed(spark, sf, tmpdir_path):
    import datetime as dt
    from tidewater.operators import windows
    ev = _events(spark, sf, f"{tmpdir_path}/in")
    s = _stream(spark, ev.schema, f"{tmpdir_path}/in")
    aggs = [F.count(F.lit(1)).alias("n")]
    sess = windows.session_stream(s.withWatermark("ts", "1 hour"), "ts", "10 hours", "user_id", aggs)
    got = run_available_now(sess, "ss_" + uuid.uuid4().hex[:6])
    exp = windows.session(ev, "ts", 36000, "user_id", aggs, seq="event_id")
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = {(r.user_id, r.session_start, r.n) for r in exp.collect()
              if r.session_end <= max_ts - dt.timedelta(hours=1)}
    streamed = {(r.user_id, r.session_start, r.n) for r in got}
    assert closed and closed <= streamed
    slid = run_available_now(jobs.windowed_sum_stream(s, "ts", "10 hours", "1 hour", "user_id", "value",
                                                      slide="5 hours"), "sl_" + uuid.uuid4().hex[:6])
    batch = jobs.windowed_sum_stream(ev, "ts", "10 hours", "1 hour", "user_id", "value", slide="5 hours")
    closed = sorted(map(tuple, [r for r in batch.collect() if r.window_end <= max_ts - dt.timedelta(hours=1)]))
    assert sorted(map(tuple, slid)) == closed


def test_day_totals_stream_update_mode(spark, sf, tmpdir_path):
    ev = _events(spark, sf, f"{tmpdir_path}/in")
    s = _stream(spark, ev.schema, f"{tmpdir_path}/in")
    got = run_available_now(jobs.day_totals_stream(s, "ts", "event_type", "value"), "dt_" + uuid.uuid4().hex[:6],
                            mode="update")
    final = {}
    for r in got:  # the last update per (day, category) is its total
        final[(r.window_start, r.event_type)] = r.total
    exp = jobs.day_totals_stream(ev, "ts", "event_type", "value").collect()
    assert final == {(r.window_start, r.event_type): r.total for r in exp}


def test_rate_orders_source(spark, tmpdir_path):
    from tidewater.sources import basic as sources
    q = (sources.rate_orders(spark, rows_per_second=20).writeStream.format("memory")
         .queryName("rate_" + uuid.uuid4().hex[:6]).option("checkpointLocation", f"{tmpdir_path}/ck")
         .trigger(processingTime="200 milliseconds").start())
    try:
        q.awaitTermination(3)
    finally:
        q.stop()
    rows = spark.table(q.name).collect()
    assert rows and all(0 <= r.user_id < 3 and 0 <= r.money <= 100 for r in rows)


def test_ingestion_time_windows(spark, tmpdir_path):
    from tidewater.operators import windows
    src = f"{tmpdir_path}/in"
    spark.createDataFrame([("a",), ("b",), ("a",)], "value string").write.parquet(f"{src}/b0")
    s = jobs.with_ingestion_time(spark.readStream.schema("value string").parquet(f"{src}/*"))
    counts = windows.tumbling(s, "ingest_ts", "5 seconds", "value", [F.count(F.lit(1)).alias("n")])
    got = run_available_now(counts, "it_" + uuid.uuid4().hex[:6], mode="update")
    assert sorted((r.value, r.n) for r in got) == [("a", 2), ("b", 1)]


def test_idempotent_sink_keys(spark, tmpdir_path):
    from tidewater.streaming.recovery import IdempotentBatchSink
    sink = IdempotentBatchSink(f"{tmpdir_path}/out", key=["id"])
    sink(spark.range(5).repartition(3), 3)
    before = {r.id: r.record_key for r in sink.read(spark).collect()}
    sink(spark.range(5).orderBy(F.col("id").desc()).coalesce(1), 3)  # a replay in another order
    rows = sink.read(spark).collect()
    assert {r.id: r.record_key for r in rows} == before and len(rows) == len(set(before.values())) == 5
    sink(spark.range(5), 4)
    assert len({r.record_key for r in sink.read(spark).collect()}) == 10


def test_rolling_file_stream_sink(spark, sf, tmpdir_path):
    from tidewater.functions.text import pair_text
    from tidewater.sinks import basic as sinks
    ev = _events(spark, sf, f"{tmpdir_path}/in")
    s = _stream(spark, ev.schema, f"{tmpdir_path}/in")
    w = sinks.rolling_stream(s, pair_text("event_id", "event_type"), sinks.bucket_daily("ts"), f"{tmpdir_path}/out",
                             f"{tmpdir_path}/ck", max_records_per_file=50)
    w.trigger(availableNow=True).start().awaitTermination()
    got = sinks.read_rolling(spark, f"{tmpdir_path}/out")
    assert got.count() == ev.count()
    days = {r.dt for r in got.select("dt").distinct().collect()}
    assert days == {r.d for r in ev.select(F.date_format("ts", "yyyy-MM-dd").alias("d")).distinct().collect()}
