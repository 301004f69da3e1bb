"""Late windows on keyed state, transactional and rolling files, the source with offsets."""

import collections
import datetime as dt
import decimal
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater import files
from tidewater.plans.arrival import until_end
from tidewater.sinks import transactional
from tidewater.sources import offset_source
from tidewater.streaming import late_windows

EPOCH = dt.datetime(2024, 1, 1)


def _minutes(n):
    return EPOCH + dt.timedelta(minutes=n)


def _write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def _run(df, path, name, **options):
    q = (df.writeStream.format("parquet").outputMode("append").option("path", f"{path}/{name}")
         .option("checkpointLocation", f"{path}/{name}-ckpt").options(**options).trigger(availableNow=True).start())
    q.awaitTermination()


# --- late windows ---

LATE_SCHEMA = "user string, seq long, at timestamp, value decimal(10,2), tag string"


def _late(spark, path):
    s = spark.readStream.schema(LATE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    return late_windows.late_windows(s, ["user"], "seq", "at", "value", 600, 60, 300)


def test_late_windows_fire_refire_and_side_output(spark, tmpdir_path):
    """Windows of 10 min, delay 1 min, lateness 5 min; the query is stopped after each batch and run on."""
    batches = [
        [("a", 1, 1), ("a", 2, 9), ("b", 3, 2)],
        [("a", 4, 12)],                       # watermark 11: [0, 10) fires after this batch
        [("a", 6, 8), ("a", 5, 7), ("b", 7, 3), ("c", 8, 4)],  # late: in order of seq; c's window never had a row in time
        [("a", 9, 17)],                       # watermark 16: [0, 10) expires
        [("a", 10, 5), (None, 11, 6), ("a", 12, 18)],   # too late, also for the null key
    ]
    got = collections.Counter()
    for i, rows in enumerate([*batches, None]):
        row = [(u, s, _minutes(m), decimal.Decimal(s), "x") for u, s, m in rows] if rows else \
            [(None, None, dt.datetime(9000, 1, 1), None, None)]
        _write(spark, row, LATE_SCHEMA, f"{tmpdir_path}/in/{i}")
        _run(_late(spark, tmpdir_path), tmpdir_path, "out")
    out = spark.read.parquet(f"{tmpdir_path}/out")
    for r in late_windows.firings(out, ["user"], 600).collect():
        got[(r["user"], (r["window_start"] - EPOCH).seconds // 60, r["fire_no"], r["trigger_id"], r["value_sum"])] += 1
    assert got == collections.Counter([
        ("a", 0, 0, None, 3.0), ("b", 0, 0, None, 3.0), ("a", 0, 1, 5, 8.0), ("a", 0, 2, 6, 14.0), ("b", 0, 1, 7, 10.0), ("c", 0, 1, 8, 8.0),
        ("a", 10, 0, None, 25.0)])
    side = late_windows.side_output(out, ["user"], "seq", "at", "value").collect()
    assert sorted((r["seq"], r["user"], r["at"], r["value"]) for r in side) == [
        (10, "a", _minutes(5), decimal.Decimal(10)), (11, None, _minutes(6), decimal.Decimal(11))]


def test_late_windows_take_nulls_and_ties(spark, tmpdir_path):
    rows = [("a", 1, _minutes(1), None, "x"), ("a", 1, _minutes(1), decimal.Decimal(2), "x"), ("n", 1, _minutes(2), None, "x")]
    _write(spark, rows, LATE_SCHEMA, f"{tmpdir_path}/in/0")
    _write(spark, [(None, None, dt.datetime(9000, 1, 1), None, None)], LATE_SCHEMA, f"{tmpdir_path}/in/1")
    _run(_late(spark, tmpdir_path), tmpdir_path, "out")
    got = late_windows.firings(spark.read.parquet(f"{tmpdir_path}/out"), ["user"], 600).collect()
    assert sorted((r["user"], r["fire_no"], r["value_sum"]) for r in got) == [("a", 0, 2.0), ("n", 0, None)]


def test_end_of_input_stays_above_the_watermark(spark, tmpdir_path):
    schema = "k string, ts timestamp"
    _write(spark, [("a", _minutes(0))], schema, f"{tmpdir_path}/in/0")
    _write(spark, [(None, dt.datetime(9000, 1, 1))], schema, f"{tmpdir_path}/in/1")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in/*")
    counted = until_end(s.withWatermark("ts", "1 hour"), "ts").groupBy(F.window("ts", "10 minutes"), "k").count()
    _run(counted.select("k", "count"), tmpdir_path, "out")
    assert [tuple(r) for r in spark.read.parquet(f"{tmpdir_path}/out").collect()] == [("a", 1)]


# --- transactional files ---

def _transaction(path):
    return transactional.FileTransaction(path, "w", "part", ".txt")


def _stage(path, names):
    os.makedirs(f"{path}/_staging", exist_ok=True)
    for n in names:
        with open(f"{path}/_staging/{n}", "w") as f:
            f.write(n)
    return transactional.Staged([(f"{path}/_staging/{n}", "b", 0, i, 1) for i, n in enumerate(names)])


def _final(path):
    return sorted(os.path.basename(p) for p in files.names(*files.open_fs(f"{path}/b")))


def test_commit_counts_each_batch_once(tmpdir_path):
    first = _stage(tmpdir_path, ["x", "y"])
    _transaction(tmpdir_path).commit([first, None], 0)
    assert _final(tmpdir_path) == ["part-0-0-0.txt", "part-0-0-1.txt"]
    _transaction(tmpdir_path).commit([_stage(tmpdir_path, ["z"])], 0)  # replayed: thrown away
    assert _final(tmpdir_path) == ["part-0-0-0.txt", "part-0-0-1.txt"] and os.listdir(f"{tmpdir_path}/_staging") == []
    _transaction(tmpdir_path).abort([_stage(tmpdir_path, ["q"])])
    assert os.listdir(f"{tmpdir_path}/_staging") == [] and _transaction(tmpdir_path).last_batch() == 0


def test_crash_between_manifest_and_files(tmpdir_path, monkeypatch):
    message = _stage(tmpdir_path, ["x", "y"])
    t = _transaction(tmpdir_path)
    moved = []

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, a, b):
            if "_staging" in a and moved:
                raise OSError("died")
            moved.append(a)
            self.fs.move(a, b)
    moved.clear()
    t.fs = Dying(t.fs)
    monkeypatch.setattr(files, "write_json", lambda fs, p, v, w=files.write_json: w(getattr(fs, "fs", fs), p, v))
    with pytest.raises(OSError, match="died"):
        t.commit([message], 0)
    assert _final(tmpdir_path) == ["part-0-0-0.txt"]
    _transaction(tmpdir_path).abort([message])  # Spark's answer to the failed commit: the files count already
    assert transactional.clean_staging(tmpdir_path) == 0
    _transaction(tmpdir_path).commit([_stage(tmpdir_path, ["x2", "y2"])], 0)  # the replay finishes the first copy
    assert _final(tmpdir_path) == ["part-0-0-0.txt", "part-0-0-1.txt"]
    assert {open(f"{tmpdir_path}/b/{n}").read() for n in _final(tmpdir_path)} == {"x", "y"}


def test_files_roll_by_size_age_and_idle_time(tmpdir_path):
    now = [0.0]

    def make(path):
        return transactional.LineFile(pa.OSFile(path, "wb"), None)

    def files_of(**limits):
        args = {"max_bytes": 1 << 30, "max_age": float("inf"), "max_idle": float("inf"), "max_open": 2, **limits}
        return transactional.RollingFiles(make, lambda n: f"{tmpdir_path}/f{n}", clock=lambda: now[0], **args)
    line = pa.RecordBatch.from_arrays([pa.array(["12345678", None])], names=["v"])
    sized = files_of(max_bytes=20)
    for _ in range(5):
        sized.write("b", line)  # 10 bytes
    assert [n for *_, n in sized.finish()] == [4, 4, 2]
    aged = files_of(max_age=10)
    for t in (0, 5, 11, 12):
        now[0] = t
        aged.write("b", line)
    assert [n for *_, n in aged.finish()] == [4, 4]
    idle, now[0] = files_of(max_idle=3), 0
    for t, bucket in ((0, "a"), (2, "b"), (4, "b"), (5, "a")):
        now[0] = t
        idle.write(bucket, line)
    assert sorted((b, n) for _, b, _, n in idle.finish()) == [("a", 2), ("a", 2), ("b", 4)]
    full, now[0] = files_of(), 0
    for t, bucket in enumerate("abcab"):
        now[0] = t
        full.write(bucket, line)
    assert collections.Counter(b for _, b, _, _ in full.finish()) == {"a": 2, "b": 2, "c": 1}


def test_rolling_stream_writes_files_up_to_a_size(spark, tmpdir_path):
    transactional.register(spark)
    spark.range(40_000).select(F.concat(F.lit("line "), "id").alias("value"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("d/"), F.col("id") % 2)).alias("dt")) \
        .repartition(2).write.parquet(f"{tmpdir_path}/in/0")
    s = spark.readStream.schema("value string, dt string").parquet(f"{tmpdir_path}/in/*")
    q = (s.writeStream.format("tw_rolling").options(path=f"{tmpdir_path}/out", checkpointLocation=f"{tmpdir_path}/ck", bucketColumn="dt",
                                                    bucketPrefix="dt=", prefix="pre", suffix=".log", maxBytes="50000").trigger(availableNow=True).start())
    q.awaitTermination()
    found = [p for p in files.names(*files.open_fs(f"{tmpdir_path}/out"), recursive=True) if "/_" not in p]
    assert all(os.path.basename(p).startswith("pre-0-") and p.endswith(".log") for p in found)
    sizes = [os.path.getsize(p) for p in found]
    assert max(sizes) < 50_000 + transactional.SLICE_ROWS * 11 and len(sizes) >= sum(sizes) // 70_000
    back = spark.read.schema("value string, dt string").text(f"{tmpdir_path}/out")
    assert {tuple(r) for r in back.groupBy("dt").count().collect()} == {("d/0", 16_000), ("d/1", 20_000), (None, 4_000)}
    assert back.select("value").distinct().count() == 40_000


def test_batch_write_is_a_transaction(spark, tmpdir_path):
    transactional.register(spark)
    for n in (3, 4):
        spark.range(n).write.format("tw_committed").mode("append").save(path=f"{tmpdir_path}/out")
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 7
    sink = transactional.batch_sink(f"{tmpdir_path}/out2")
    for batch_id, n in ((0, 5), (0, 5), (1, 2)):
        sink(spark.range(n), batch_id)
    assert spark.read.parquet(f"{tmpdir_path}/out2").count() == 7
    with pytest.raises(Exception, match="appended"):
        spark.range(1).write.format("tw_committed").mode("overwrite").save(path=f"{tmpdir_path}/out")

    def failing(it):
        yield from it
        raise RuntimeError("task died")
    with pytest.raises(Exception, match="task died"):
        spark.range(9).mapInArrow(failing, "id long").write.format("tw_committed").mode("append").save(path=f"{tmpdir_path}/out")
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 7


# --- source with offsets ---

def test_offsets_admission_restart_and_new_files(spark, tmpdir_path):
    offset_source.register(spark)
    os.makedirs(f"{tmpdir_path}/t")

    def add(name, lo, hi):
        pq.write_table(pa.table({"v": list(range(lo, hi)), "w": ["x"] * (hi - lo)}), f"{tmpdir_path}/t/{name}.parquet", row_group_size=7)
    add("a", 0, 25)
    add("b", 25, 30)
    seen, fail = [], [3]

    def start():
        s = (spark.readStream.format("tw_offsets").options(path=f"{tmpdir_path}/t", columns="v", rowsPerBatch="8", rowsPerTask="3",
                                                           progress=f"{tmpdir_path}/progress").load())

        def write(batch, batch_id):
            rows = batch.collect()
            if batch_id in fail:
                fail.remove(batch_id)
                raise RuntimeError("died")
            seen.append((batch_id, sorted(r["v"] for r in rows), len({r["task"] for r in rows})))
            assert all(r["offset"] == r["v"] for r in rows)
        return s.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmpdir_path}/ck").trigger(processingTime="0 seconds").start()
    q = start()
    with pytest.raises(StreamingQueryException):
        q.processAllAvailable()
    q.stop()
    add("c", 30, 41)
    q = start()
    q.processAllAvailable()
    q.stop()
    assert [v for _, rows, _ in seen for v in rows] == list(range(41))
    assert [b for b, _, _ in seen] == list(range(len(seen))) and max(len(r) for _, r, _ in seen) <= 8 and max(t for *_, t in seen) >= 3


def test_offsets_read_only_their_rows(tmpdir_path):
    path = f"{tmpdir_path}/x.parquet"
    pq.write_table(pa.table({"v": list(range(20)), "w": ["x"] * 20}), path, row_group_size=6)
    for lo, hi in ((0, 20), (5, 6), (6, 12), (5, 13), (19, 20), (3, 3)):
        got = [v for b in offset_source.read_range(path, lo, hi, ["v"], path) for v in b.column(0).to_pylist()]
        assert got == list(range(lo, hi))
    reader = offset_source.OffsetReader({"path": path}, ["v"])
    with pytest.raises(ValueError, match="stands at row 9"):
        reader.partitions({"row": 9}, {"row": 4})
