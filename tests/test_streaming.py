"""Stream/batch parity, stateful processors, recovery and exactly-once output."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import run_available_now, stream_files
from tidewater.functions.timecols import as_event_time
from tidewater.operators import keyed, windows
from tidewater.plans import jobs as batch_jobs
from tidewater.streaming import jobs, processors
from tidewater.streaming.recovery import IdempotentBatchSink, JobConfig, RestartPolicy, run_with_restart


def _batches_by_id(spark, df, path, n, id_col="event_id"):
    lo, hi = df.agg(F.min(id_col), F.max(id_col)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = df.where((F.col(id_col) >= lo + i * step) & (F.col(id_col) < lo + (i + 1) * step))
        part.coalesce(1).write.parquet(f"{path}/b{i:03d}")
    return path


def _name():
    return "q_" + uuid.uuid4().hex[:8]


def test_running_max_stream_matches_batch(spark, sf, tmpdir_path):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "value")
    src = _batches_by_id(spark, ev, f"{tmpdir_path}/in", 4)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    got = run_available_now(processors.running_stream(s, "event_type", "event_id", "value", "max"), _name())
    exp = keyed.running_max(ev, "event_type", "event_id", "value").collect()
    assert sorted((r.event_id, r.result) for r in got) == sorted((r.event_id, r.max_so_far) for r in exp)


def test_changelog_stream_matches_batch(spark, sf, tmpdir_path):
    from tidewater.operators import changelog
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id")
    src = _batches_by_id(spark, ev, f"{tmpdir_path}/in", 3)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    got = run_available_now(processors.running_stream(s, "user_id", "event_id", None, "count", changelog=True),
                            _name())
    exp = changelog.count_changelog(ev, "user_id", "event_id").collect()
    assert sorted((r.event_id, r.change_seq, r.flag, r.user_id, int(r.result)) for r in got) == \
        sorted((r.event_id, r.change_seq, r.flag, r.user_id, r.cnt) for r in exp)


def test_count_windows_stream_match_batch(spark, sf, tmpdir_path):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "value")
    src = _batches_by_id(spark, ev, f"{tmpdir_path}/in", 3)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    tumb = run_available_now(processors.count_window_stream(s, "user_id", "event_id", "value", 5), _name())
    exp = windows.count_tumbling(ev, "user_id", "event_id", 5, [F.sum("value").alias("s"),
                                                                 F.max("event_id").alias("last")])
    assert len(tumb) == exp.count()
    slid = run_available_now(processors.count_window_stream(s, "user_id", "event_id", "value", 5, 3), _name())
    exp2 = windows.count_sliding(ev, "user_id", "event_id", 5, 3, F.col("value"), "s").collect()
    assert sorted((r.user_id, r.fire_at, round(r.value_sum, 6)) for r in slid) == \
        sorted((r.user_id, r.fire_at, round(r.s, 6)) for r in exp2)


def test_tumbling_stream_parity_closed_windows(spark, sf, tmpdir_path):
    ev = (as_event_time(spark.read.parquet(f"{sf}/events.parquet"), "ts")
          .select("event_id", "ts", "user_id", keyed.exact("value").alias("value")))
    src = _batches_by_id(spark, ev, f"{tmpdir_path}/in", 4)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    got = run_available_now(jobs.windowed_sum_stream(s, "ts", "5 hours", "3 hours", "user_id", "value"), _name())
    batch = jobs.windowed_sum_stream(ev, "ts", "5 hours", "3 hours", "user_id", "value")
    max_ts = ev.agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = [r for r in batch.collect() if r.window_end <= max_ts - dt.timedelta(hours=3)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, closed))


def test_order_timeout_timers_match_batch(spark, sf, tmpdir_path):
    o = (spark.read.parquet(f"{sf}/orders.parquet")
         .select("o_orderkey", "o_custkey", "o_orderdate")
         .withColumn("reviewed", F.pmod("o_orderkey", F.lit(2)) == 0)
         .withColumn("ts", F.col("o_orderdate").cast("timestamp"))
         .withColumn("created_ms", F.unix_millis("ts")))
    src = f"{tmpdir_path}/in"
    o.orderBy("ts").coalesce(1).write.parquet(f"{src}/b0")
    s = spark.readStream.schema(o.schema).parquet(f"{src}/*").withWatermark("ts", "0 seconds")
    interval_ms = 30 * 86400 * 1000
    got = run_available_now(processors.order_timeout_stream(s, "o_custkey", "o_orderkey", "created_ms",
                                                            "reviewed", interval_ms), _name())
    assert got, "timers fired"
    last_fire = max(r.action_ms for r in got)
    exp = batch_jobs.timeout_review(o, "o_custkey", "o_orderkey", "ts", "reviewed", 30 * 86400)
    exp = exp.where(F.unix_millis("action_time") <= last_fire)
    assert sorted((r.order_id, r.action, r.action_ms) for r in got) == \
        sorted((r.order_id, r.action, r.ms) for r in exp.withColumn("ms", F.unix_millis("action_time")).collect())


def test_exactly_once_word_count_with_failure(spark, tmpdir_path):
    """M4/M8: a poison word fails the first attempt; the restarted query replays
    the batch from its checkpoint and the idempotent sink keeps one copy."""
    src, ck, out = f"{tmpdir_path}/in", f"{tmpdir_path}/ck", f"{tmpdir_path}/out"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("hello world\nhello spark bug\n")
    marker = f"{tmpdir_path}/failed-once"

    sink = IdempotentBatchSink(out)

    def handle(batch, batch_id):
        if not os.path.exists(marker) and batch.where(F.col("word") == "bug").count() > 0:
            open(marker, "w").close()
            raise RuntimeError("poison row")
        sink(jobs.word_count_lines(batch), batch_id)

    def start():
        lines = spark.readStream.schema("value string").text(src)
        counts = jobs.word_counts_stream(lines)
        cfg = JobConfig(checkpoint_location=ck, available_now=True)
        return cfg.apply(counts.writeStream.outputMode("update").foreachBatch(handle)).start()

    q, restarts = run_with_restart(start, RestartPolicy.fixed_delay(3, 0.1))
    assert restarts == 1
    final = {r.word: r.n for r in sink.read(spark).collect()}
    assert final == {"hello": 2, "world": 1, "spark": 1, "bug": 1}
    assert sink.read(spark).count() == 4  # no duplicate rows from the replay


def test_restart_policy_none_raises(spark, tmpdir_path):
    import pytest
    from pyspark.errors import StreamingQueryException
    src = f"{tmpdir_path}/in"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("x\n")

    def boom(batch, batch_id):
        raise RuntimeError("always")

    def start():
        return spark.readStream.schema("value string").text(src).writeStream.foreachBatch(boom) \
            .option("checkpointLocation", f"{tmpdir_path}/ck").trigger(availableNow=True).start()
    with pytest.raises(StreamingQueryException):
        run_with_restart(start, RestartPolicy.none())


def test_enrich_reads_dimension_every_batch(spark, tmpdir_path):
    dim_path, src, out = f"{tmpdir_path}/dim", f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    spark.createDataFrame([("user_1", "张三")], "userID string, userName string").write.parquet(dim_path)
    stream_files(spark, [[("user_1", 1)]], "userID string, n int", src)
    sink = IdempotentBatchSink(out)
    handle = jobs.enrich_each_batch(lambda s: s.read.parquet(dim_path), "userID", "inner", sink)
    s = spark.readStream.schema("userID string, n int").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    ck = f"{tmpdir_path}/ck"
    s.writeStream.foreachBatch(handle).option("checkpointLocation", ck).trigger(availableNow=True).start() \
        .awaitTermination()
    # the dimension changes, then a new event for the new user arrives
    spark.createDataFrame([("user_2", "李四")], "userID string, userName string").write.mode("append") \
        .parquet(dim_path)
    spark.createDataFrame([("user_2", 2)], "userID string, n int").coalesce(1).write.parquet(f"{src}/b9999")
    s.writeStream.foreachBatch(handle).option("checkpointLocation", ck).trigger(availableNow=True).start() \
        .awaitTermination()
    got = sorted((r.userID, r.userName) for r in sink.read(spark).collect())
    assert got == [("user_1", "张三"), ("user_2", "李四")]


def test_running_sum_stream_exact_matches_batch(spark, sf, tmpdir_path):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "value")
    src = _batches_by_id(spark, ev, f"{tmpdir_path}/in", 3)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    exact = s.withColumn("value", keyed.exact("value"))
    got = run_available_now(processors.running_stream(exact, "event_type", "event_id", "value", "sum"), _name())
    exp = keyed.running_sum(ev, "event_type", "event_id", "value", exact_scale=2).collect()
    assert sorted((r.event_id, float(r.result)) for r in got) == sorted((r.event_id, r.running) for r in exp)


def test_keyed_streams_take_nulls_strings_and_decimals(spark, tmpdir_path):
    from decimal import Decimal as D
    schema = "k string, seq bigint, v decimal(10,3)"
    rows = [("a", 1, D("1.005")), ("a", 2, None), ("b", 3, None), ("a", 4, D("2.000")), ("b", 5, D("-1.500"))]
    src = stream_files(spark, [rows[:3], rows[3:]], schema, f"{tmpdir_path}/in")

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    got = run_available_now(processors.running_stream(stream(), "k", "seq", "v", "sum"), _name())
    assert sorted((r.seq, r.result) for r in got) == [
        (1, D("1.005")), (2, D("1.005")), (3, None), (4, D("3.005")), (5, D("-1.500"))]
    got = run_available_now(processors.running_stream(stream(), "k", "seq", "v", "max", changelog=True), _name())
    assert sorted((r.seq, r.change_seq, r.flag, r.result) for r in got if r.k == "a") == [
        (1, 1, True, D("1.005")), (2, 0, False, D("1.005")), (2, 1, True, D("1.005")),
        (4, 0, False, D("1.005")), (4, 1, True, D("2.000"))]
    got = run_available_now(processors.count_window_stream(stream(), "k", "seq", "v", 2, 1), _name())
    assert sorted((r.k, r.fire_at, r.value_sum) for r in got if r.k == "a") == [
        ("a", 1, D("1.005")), ("a", 2, D("1.005")), ("a", 3, D("2.000"))]


def test_order_timeout_string_ids_and_processing_time(spark, tmpdir_path):
    import time
    now = int(time.time() * 1000)
    schema = "user string, ordr string, created_ms bigint, reviewed boolean"
    src = stream_files(spark, [[("u1", "o1", now, False), ("u1", "o2", now, True)]], schema, f"{tmpdir_path}/in")
    s = spark.readStream.schema(schema).parquet(f"{src}/*")
    out = processors.order_timeout_stream(s, "user", "ordr", "created_ms", "reviewed", 1000, event_time=False)
    name = _name()
    q = (out.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{tmpdir_path}/ck").trigger(processingTime="500 milliseconds").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(name).count() < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    got = sorted((r.user_id, r.order_id, r.action) for r in spark.table(name).collect())
    assert got == [("u1", "o1", "auto_good"), ("u1", "o2", "already_reviewed")]


def test_failure_between_write_and_commit_keeps_one_copy(spark, tmpdir_path):
    """Rows of a batch are written, the job dies before the commit: readers don't see the
    batch, and its replay after the restart leaves one copy under the same keys."""
    src = stream_files(spark, [[("a", 1)], [("b", 2), ("c", 3)], [("d", 4)]], "k string, n int", f"{tmpdir_path}/in")
    seen = []

    class Dying(IdempotentBatchSink):
        def _commit(self, session, batch_id, done):
            if batch_id == 1 and not seen:
                seen.append(sorted(r.k for r in self.read(session).collect()))
                raise RuntimeError("lost before the commit")
            super()._commit(session, batch_id, done)

    sink = Dying(f"{tmpdir_path}/out", key=["k"])

    def start():
        s = spark.readStream.schema("k string, n int").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        cfg = JobConfig(checkpoint_location=f"{tmpdir_path}/ck", available_now=True)
        return cfg.apply(s.writeStream.foreachBatch(sink)).start()

    _, restarts = run_with_restart(start, RestartPolicy.failure_rate(2, 60, 0.1))
    rows = sink.read(spark).collect()
    assert restarts == 1 and seen == [["a"]]
    assert sorted(r.k for r in rows) == ["a", "b", "c", "d"] and len({r.record_key for r in rows}) == 4
