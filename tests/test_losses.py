"""Nothing is lost in silence: unreadable state, failing lookups, hung calls, days of one batch."""

import time

import pytest
from pyspark.sql import Row

from tidewater import session
from tidewater.operators.lookup import remote_lookup
from tidewater.streaming.processors import _merge, _names, _row
from tidewater.streaming.recovery import RestartPolicy, first_read, run_with_restart


def test_only_a_missing_folder_is_a_fresh_start(spark, tmpdir_path):
    assert first_read(lambda: spark.read.parquet(f"{tmpdir_path}/none")) is None
    with open(f"{tmpdir_path}/part.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark raises
        first_read(lambda: spark.read.parquet(tmpdir_path).collect())


def test_lookup_errors_are_raised_and_hung_calls_end(spark):
    facts = spark.createDataFrame([(1,), (2,)], "cid long").coalesce(1)

    def broken(keys):
        raise PermissionError("no")

    def hung(keys):
        time.sleep(20)

    with pytest.raises(Exception, match="PermissionError"):
        remote_lookup(facts, "cid", broken, "name").collect()
    began = time.monotonic()
    rows = remote_lookup(facts, "cid", hung, "name", timeout=0.2, on_missing="null").collect()
    assert [r["name"] for r in rows] == [None, None] and time.monotonic() - began < 10


def test_a_wait_that_times_out_is_no_success():
    class Query:
        stopped = False

        def awaitTermination(self, timeout=None):
            return False

        def stop(self):
            Query.stopped = True

    with pytest.raises(TimeoutError):
        run_with_restart(Query, RestartPolicy.none(), timeout=0.01)
    assert Query.stopped


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_a_connect_session_needs_a_shared_folder():
    class Connect:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

        @property
        def sparkContext(self):
            raise RuntimeError("not in Spark Connect")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Connect())


def test_lookups_keep_calls_in_flight_and_answers(spark):
    """One hung call takes one place, not all; a key is asked once a task, however many batches it is in."""
    import os
    import tempfile
    log = tempfile.mkdtemp(prefix="tw-lookup-", dir="/tmp")

    def fetch(keys):
        with open(f"{log}/{keys[0]}-{time.monotonic_ns()}", "w"):
            pass
        time.sleep(3 if keys == [0] else 0.02)
        return {k: f"n{k}" for k in keys if k != 7}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "50")
    try:
        began = time.monotonic()
        rows = remote_lookup(spark.range(200).selectExpr("id % 40 as cid").coalesce(1), "cid", fetch, "name", batch_size=1, max_in_flight=2).collect()
    finally:
        spark.conf.set(key, before)
    assert {(r["cid"], r["name"]) for r in rows} == {(k, f"n{k}" if k != 7 else "未知") for k in range(40)}
    asked = [int(n.split("-")[0]) for n in os.listdir(log)]
    assert sorted(k for k in asked if k != 7) == sorted(set(range(40)) - {7}) and time.monotonic() - began < 12


def test_names_and_parts_take_nulls_and_decimal_columns():
    assert _row(_names("k string, total decimal(18,2), m map<string,int>"), "a", 1, 2) == Row(k="a", total=1, m=2)
    for how, want in (("sum", [None, 2.0, 2.0, 5.0]), ("max", [None, 2.0, 2.0, 3.0]), ("min", [None, 2.0, 2.0, 2.0])):
        now, got = None, []
        for v in (None, 2.0, None, 3.0):
            now = _merge(how, now, v)
            got.append(now)
        assert got == want
