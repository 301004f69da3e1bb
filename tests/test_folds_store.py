"""Window functions and folds over ordered groups; the keyed store with compaction."""

import os
import random

import pyarrow as pa
import pytest

from tidewater.functions import udf
from tidewater.operators import folds
from tidewater.sinks.keyed_store import KeyedStore

# --- groups ---


def test_groups_are_read_in_batches_and_may_be_left_unread():
    rows = [("a", 1)] * 5 + [("a", None)] * 2 + [(None, None)] * 3 + [("b", 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + 4]], pa.string()), pa.array([r[1] for r in rows[i:i + 4]], pa.int64()),
                                           pa.array(range(i, min(i + 4, len(rows))))], names=["k", "w", "v"]) for i in range(0, len(rows), 4)]
    got = [(key, [b.column(2).to_pylist() for b in mine]) for key, mine in folds.groups(iter(batches), 2, batch_rows=2)]
    assert [k for k, _ in got] == [("a", 1), ("a", None), (None, None), ("b", 1)]
    assert [[v for b in bs for v in b] for _, bs in got] == [[0, 1, 2, 3, 4], [5, 6], [7, 8, 9], [10]]
    assert max(len(b) for _, bs in got for b in bs) == 2
    assert [key for key, _ in folds.groups(iter(batches), 1)] == [("a",), (None,), ("b",)]
    assert list(folds.groups(iter([]), 1)) == []


def test_apply_window_reads_a_hot_window_in_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "k", None]), i % 7200, i, "x") for i in range(20_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, s long, id long, window_start string").selectExpr("k", "id", "timestamp_seconds(s) as ts")

    def seen(batches):
        sizes, ids = [], []
        for b in batches:
            sizes.append(b.num_rows)
            ids += b.column(0).to_pylist()
        yield len(ids), len(sizes), max(sizes), all(x < y for x, y in zip(ids, ids[1:], strict=False))
    got = folds.apply_window(df, "ts", "1 hour", ["k"], ["id"], ["id"], seen, "n long, batches long, largest long, in_order boolean", batch_rows=500).collect()
    assert len(got) == 6 and sum(r["n"] for r in got) == 20_000
    assert all(r["in_order"] and r["largest"] <= 500 for r in got) and max(r["batches"] for r in got) > 10
    assert folds.apply_window(df.limit(0), "ts", "1 hour", ["k"], ["id"], ["id"], seen, "n long, batches long, largest long, in_order boolean").count() == 0


# --- folds ---

@pytest.mark.parametrize("fan,parts", [(64, 4), (2, 16), (3, 7)])
def test_ordered_fold_merges_in_order(spark, fan, parts):
    """Text put together piece by piece: associative, not commutative."""
    rng = random.Random(fan)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), i, chr(97 + i % 26) if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, id long, c string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = folds.ordered_fold(df, "k", ["id"], ["c"], lambda a, r: ((a[0] if a else "") + (r[0] or "-"),), lambda a, b: (a[0] + b[0],),
                                 lambda a: (a[0], len(a[0])), "s string", "s string, n long", fan=fan).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {}
    for k, _, c in rows:
        want[k] = want.get(k, "") + (c or "-")
    assert {r["k"]: r["s"] for r in got} == want and all(r["n"] == len(r["s"]) for r in got)


def test_keyed_fold_holds_a_bounded_number_of_keys(spark):
    """Distinct keys: whenever ``flush`` accumulators are held they are sent on, so every key, which
    comes twice and 500 keys apart, is merged from two parts."""
    df = spark.range(0, 1000, numPartitions=1).selectExpr("id % 500 as k", "id as v")
    for flush, parts in ((50, 2), (500, 1)):
        out = folds.keyed_fold(df, "k", lambda: (0, 0), lambda a, r: (a[0] + r["v"], 1), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                               lambda k, a: (k, a[0], a[1]), "s long, n long", "k long, s long, n long", flush=flush).collect()
        assert sorted(map(tuple, out)) == [(k, 2 * k + 500, parts) for k in range(500)]


def test_reduce_by_key_on_distinct_keys_and_nulls(spark):
    df = spark.createDataFrame([(None, 1, "x"), ("a", 2, None), (None, 5, "y"), ("a", 4, "z")], "k string, n long, note string")
    got = udf.reduce_by_key(df, "k", lambda a, b: a if a["n"] >= b["n"] else b)
    assert got.columns == ["k", "n", "note"] and sorted(map(tuple, got.collect()), key=str) == [("a", 4, "z"), (None, 5, "y")]
    assert udf.reduce_by_key(df.limit(0), "k", lambda a, b: a).collect() == []


# --- keyed store ---

def _state(store):
    return sorted((r["field"], r["value"]) for r in store.state().collect())


def _rows(spark, rows):
    return spark.createDataFrame(rows, "w string, n long, seq long")


def test_store_replay_before_and_after_a_compaction(spark, tmpdir_path):
    store = KeyedStore(spark, f"{tmpdir_path}/kv", "wcresult", buckets=4)
    assert _state(store) == []
    first = _rows(spark, [("a", 1, 1), ("b", 1, 2), ("a", 2, 3), (None, 9, 4), ("n", None, 5)])
    later = _rows(spark, [("a", 3, 1), ("c", 7, 2)])  # a newer batch wins, whatever its sequence numbers
    store.upsert(first, "w", "n", "seq", 0)
    store.upsert(first, "w", "n", "seq", 0)
    assert _state(store) == [("a", "2"), ("b", "1"), ("n", None)]
    store.upsert(later, "w", "n", "seq", 1)
    want = [("a", "3"), ("b", "1"), ("c", "7"), ("n", None)]
    assert _state(store) == want
    store.compact()
    assert _state(store) == want and store.manifest()["deltas"] == []
    for batch, rows in ((0, first), (1, later)):
        store.upsert(rows, "w", "n", "seq", batch)  # replays after the compaction
    assert _state(store) == want
    again = KeyedStore(spark, f"{tmpdir_path}/kv", "wcresult", buckets=9)  # the manifest's number of buckets holds
    again.upsert(_rows(spark, [("b", 5, 1)]), "w", "n", "seq", 2)
    assert _state(again) == [("a", "3"), ("b", "5"), ("c", "7"), ("n", None)]
    assert {r["hash"] for r in again.state().collect()} == {"wcresult"}


def test_store_rewrites_only_touched_buckets(spark, tmpdir_path):
    store = KeyedStore(spark, f"{tmpdir_path}/kv", "h", buckets=8, max_deltas=2)
    store.upsert(_rows(spark, [(f"k{i}", i, i) for i in range(200)]), "w", "n", "seq", 0)
    assert len(store.compact()) == 8
    before = store.manifest()["base"]
    store.upsert(_rows(spark, [("k7", 70, 1)]), "w", "n", "seq", 1)
    touched = store.compact()
    after = store.manifest()["base"]
    assert len(touched) == 1 and [b for b in after if after[b] != before[b]] == [str(touched[0])]
    assert dict(_state(store))["k7"] == "70" and len(_state(store)) == 200
    for batch in range(2, 6):  # compacts by itself, and what no version names goes one compaction later
        store.upsert(_rows(spark, [(f"k{batch}", 1000 + batch, 1)]), "w", "n", "seq", batch)
    assert len(store.manifest()["deltas"]) <= 2 and dict(_state(store))["k5"] == "1005"
    named = set(store.manifest()["base"].values()) | {d["folder"] for d in store.manifest()["deltas"]} | set(store.manifest()["retired"])
    assert {d for d in os.listdir(f"{tmpdir_path}/kv") if os.path.isdir(f"{tmpdir_path}/kv/{d}")} == named


def test_store_ignores_what_a_dead_writer_left(spark, tmpdir_path, monkeypatch):
    store = KeyedStore(spark, f"{tmpdir_path}/kv", "h")
    store.upsert(_rows(spark, [("a", 1, 1)]), "w", "n", "seq", 0)
    monkeypatch.setattr(store, "_publish", lambda m: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError, match="died"):
        store.upsert(_rows(spark, [("a", 2, 1)]), "w", "n", "seq", 1)
    with pytest.raises(OSError, match="died"):
        store.compact()
    again = KeyedStore(spark, f"{tmpdir_path}/kv", "h")
    assert _state(again) == [("a", "1")]
    again.upsert(_rows(spark, [("a", 2, 1)]), "w", "n", "seq", 1)
    assert _state(again) == [("a", "2")]
