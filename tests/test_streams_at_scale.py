"""Streams whose keys share state by bucket, and whose rows carry their own watermark."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tidewater.plans import arrival
from tidewater.streaming import late_windows, processors

EPOCH = dt.datetime(2024, 1, 1)


def _run(df, path, name):
    q = (df.writeStream.format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/{name}-ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q, df.sparkSession.read.parquet(f"{path}/{name}").collect()


# --- running state (F4, F5, F8, F10) ---

def _staged(spark, path, n=3000, keys=700):
    rows = spark.range(n).select(F.col("id"), F.when(F.col("id") % 11 > 0, F.col("id") % keys).alias("k"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") % 13).alias("v"))
    files = arrival.write_slices(rows, f"{path}/in", "id", rows_per_file=300, min_slices=3)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in/*")
    return rows.collect(), files, stream


def test_keys_share_state_by_bucket(spark, tmpdir_path):
    """700 keys make no more than ``BUCKETS`` state values; before, one each."""
    rows, files, stream = _staged(spark, tmpdir_path)
    assert files == 4
    q, got = _run(processors.running_stream(stream, "k", "id", "v", "sum", block=100), tmpdir_path, "sum")
    states = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert 0 < max(states) <= processors.BUCKETS
    now, want = {}, {}
    for i, k, v in sorted(rows):
        now[k] = processors._merge("sum", now.get(k), v)
        want[i] = now[k]
    assert {r["id"]: r["result"] for r in got} == want


def test_a_task_holds_one_block_of_a_bucket(spark, tmpdir_path):
    """Rows and carries meet in groups; before, a task held its whole share of the micro-batch as Python objects."""
    rows, _, stream = _staged(spark, tmpdir_path)
    out = processors.count_window_stream(stream, "k", "id", "v", 3, 2, block=100)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.lstrip("~").startswith("FlatMapGroupsInArrow")
    _, got = _run(out, tmpdir_path, "slide")
    seen, want = {}, set()
    for _, k, v in sorted(rows):
        seen.setdefault(k, []).append(v)
        if len(seen[k]) % 2 == 0:
            known = [x for x in seen[k][-3:] if x is not None]
            want.add((k, len(seen[k]), sum(known) if known else None))
    assert {(r["k"], r["fire_at"], r["value_sum"]) for r in got} == want


def test_slices_have_many_files_and_the_same_number_each(spark, tmpdir_path):
    """Ids with a gap: two slices are sparse or empty, and still have as many files as the others."""
    ids = spark.range(900).select(F.when(F.col("id") < 899, F.col("id")).otherwise(3999).alias("id"))
    files = arrival.write_slices(ids, f"{tmpdir_path}/in", "id", rows_per_file=100)
    assert files == 3
    counts = [(len(x.inputFiles()), x.count()) for x in (spark.read.schema("id long").parquet(f"{tmpdir_path}/in/slice={i:06d}") for i in range(4))]
    assert counts == [(3, 899), (3, 0), (3, 0), (3, 1)]
    assert arrival.ROWS_PER_FILE <= 250_000


# --- late windows (F1, F2) ---

LATE = "user string, seq long, at timestamp, value decimal(10,2)"


def _late(spark, path, batches):
    for i, rows in enumerate([*batches, [(None, None, None)]]):
        made = [(u, s, None if m is None else EPOCH + dt.timedelta(minutes=m), decimal.Decimal(s)) if s is not None
                else (None, None, dt.datetime(9000, 1, 1), None) for u, s, m in rows]
        spark.createDataFrame(made, LATE).coalesce(1).write.parquet(f"{path}/in/{i}")
    s = spark.readStream.schema(LATE).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    q, _ = _run(late_windows.late_windows(s, ["user"], "seq", "at", "value", 600, 60, 300), path, "out")
    out = spark.read.parquet(f"{path}/out")
    fired = sorted((r["user"], (r["window_start"] - EPOCH).seconds // 60, r["fire_no"], r["trigger_id"], r["value_sum"])
                   for r in late_windows.firings(out, ["user"], 600).collect())
    side = sorted((r["seq"], r["user"]) for r in late_windows.side_output(out, ["user"], "seq", "at", "value").collect())
    return q, fired, side


def test_watermark_moves_with_every_row(spark, tmpdir_path):
    """One micro-batch or many: the same firings and the same side output; before, a batch's own rows never were late in it."""
    rows = [("a", 1, 1), ("b", 2, 12), ("a", 3, 3), ("b", 4, 17), ("a", 5, 4), ("c", 6, None), ("b", 7, 14), ("a", 8, 31), ("b", 9, 16)]
    want = [("a", 0, 0, None, 1.0), ("a", 0, 1, 3, 4.0), ("a", 30, 0, None, 8.0), ("b", 10, 0, None, 13.0)]
    for name, size in (("one", 9), ("two", 4), ("each", 1)):
        _, fired, side = _late(spark, f"{tmpdir_path}/{name}", [rows[lo:lo + size] for lo in range(0, 9, size)])
        assert fired == want, name
        assert side == [(5, "a"), (6, "c"), (9, "b")], name


# --- order timers (F3) ---

def test_users_share_timers_by_bucket(spark, tmpdir_path):
    """400 users in 8 buckets, three batches: as by hand, with 8 timers and heads at most; before, each user had its own."""
    rows = [(f"u{i * 7 % 400}" if i % 50 else None, f"o{i}", EPOCH + dt.timedelta(minutes=i), i % 3 == 0) for i in range(1500)]
    for b in range(3):
        spark.createDataFrame(rows[b * 500:(b + 1) * 500], "u string, o string, ts timestamp, reviewed boolean") \
            .withColumn("ms", F.unix_millis("ts")).coalesce(1).write.parquet(f"{tmpdir_path}/in/{b}")
    s = (spark.readStream.schema("u string, o string, ts timestamp, reviewed boolean, ms long").option("maxFilesPerTrigger", 1)
         .parquet(f"{tmpdir_path}/in/*").withWatermark("ts", "0 seconds"))
    out = processors.order_timeout_stream(s, "u", "o", "ms", "reviewed", 300 * 60_000, buckets=8)
    q, got = _run(out, tmpdir_path, "out")
    # per bucket: its head, its timer and that timer's index, and the runs
    assert 0 < max(x["numRowsTotal"] for p in q.recentProgress for x in p["stateOperators"]) <= 8 * 4
    minutes = {r["order_id"]: (r["user_id"], r["action"], (r["action_ms"] / 1000 - EPOCH.replace(tzinfo=dt.timezone.utc).timestamp()) / 60) for r in got}
    want, deadlines = {}, {}
    for i, (u, *_) in enumerate(rows):
        deadlines.setdefault(u, []).append(i + 300)
    for i, (u, o, _, reviewed) in enumerate(rows):
        at = min(t for t in deadlines[u] if t >= i) if reviewed else i + 300
        if at < 1499:
            want[o] = (u, "already_reviewed" if reviewed else "auto_good", at)
    assert {k: v for k, v in minutes.items() if v[2] < 1499} == want and len(got) == len(minutes)


# --- staged texts (F9) ---

def test_texts_are_staged_in_files_of_a_task_each(spark, tmpdir_path, monkeypatch):
    """Files of a slice follow from the number of texts; before, 2,000,000 were one file and one task wrote them."""
    from tidewater.plans import delivery_queries
    monkeypatch.setattr(delivery_queries, "DOCUMENTS_PER_FILE", 5)
    seen = []
    make = arrival.write_slices
    monkeypatch.setattr(arrival, "write_slices", lambda *a, **k: seen.append(make(*a, **k)) or seen[-1])
    spark.createDataFrame([(i, f"a b{i % 7} c") for i in range(60)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmpdir_path}/documents.parquet")
    got = delivery_queries.etl_exactly_once(spark, tmpdir_path).collect()
    assert seen == [3]
    assert {r["line"] for r in got if r["word"] == "a"} == {"a:15", "a:30", "a:45", "a:60"}
    assert len(got) == 4 * 9 and {r["line"] for r in got if r["word"] == "b0"} >= {"b0:9"}
