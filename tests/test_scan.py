"""Blocked scan = plain window, for any block size (property tests)."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import changelog, keyed, lateness, scan, windows

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=40)


def _frame(spark, rows):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "seq long, k long, v long"), pd.DataFrame(data, columns=["seq", "k", "v"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, block=st.sampled_from([1, 2, 3, 7, 1000]))
def test_running_matches_pandas(spark, rows, block):
    df, pdf = _frame(spark, rows)
    out = scan.running_many(df, ["k"], ["seq"], [("v", "sum", "s"), ("v", "max", "m"), (None, "count", "c")],
                            block_size=block).toPandas().sort_values("seq")
    g = pdf.sort_values("seq").groupby("k")["v"]
    assert list(out["s"]) == list(g.cumsum())
    assert list(out["m"]) == list(g.cummax())
    assert list(out["c"]) == list(pdf.sort_values("seq").groupby("k").cumcount() + 1)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, block=st.sampled_from([1, 3, 1000]))
def test_exclusive_running_max(spark, rows, block):
    df, pdf = _frame(spark, rows)
    out = scan.running(df, ["k"], ["seq"], "v", "max", "p", inclusive=False, block_size=block) \
        .toPandas().sort_values("seq")
    exp = pdf.sort_values("seq").groupby("k")["v"].transform(lambda s: s.cummax().shift(1))
    assert [None if pd.isna(x) else x for x in out["p"]] == [None if pd.isna(x) else x for x in exp]


def test_global_scan_no_keys(spark):
    df = spark.range(0, 200).select(F.col("id").alias("seq"), (F.col("id") % 17).alias("v"))
    out = scan.running(df, [], ["seq"], "v", "sum", "s", block_size=16).orderBy("seq").toPandas()
    assert list(out["s"]) == list(out["v"].cumsum())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, block=st.sampled_from([1, 4, 1000]))
def test_changelog_folds_to_final(spark, rows, block):
    """Applying the flags (+new, -old) leaves exactly the final aggregate per key."""
    df, pdf = _frame(spark, rows)
    ch = changelog.aggregate_changelog(df, "k", "seq", "v", "sum", "s", block_size=block).toPandas()
    signed = ch.assign(w=ch["flag"].map({True: 1, False: -1}))
    # each key's last add is its final value; retracts cancel earlier adds one to one
    assert (signed.groupby("k")["w"].sum() == 1).all()
    last = ch[ch["flag"]].sort_values("seq").groupby("k")["s"].last().to_dict()
    assert last == pdf.groupby("k")["v"].sum().to_dict()


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, block=st.sampled_from([1, 3, 1000]))
def test_count_windows_any_block(spark, rows, block):
    df, pdf = _frame(spark, rows)
    tumb = windows.count_tumbling(df, "k", "seq", 3, [F.sum("v").alias("s")], block_size=block).toPandas()
    exp = []
    for k, g in pdf.sort_values("seq").groupby("k"):
        vals = list(g["v"])
        exp += [(k, i // 3, sum(vals[i:i + 3])) for i in range(0, len(vals) - len(vals) % 3, 3)]
    assert sorted(map(tuple, tumb[["k", "window_no", "s"]].values.tolist())) == sorted(exp)
    slid = windows.count_sliding(df, "k", "seq", 5, 3, F.col("v"), "s", block_size=block).toPandas()
    exp = []
    for k, g in pdf.sort_values("seq").groupby("k"):
        vals = list(g["v"])
        exp += [(k, n, sum(vals[max(0, n - 5):n])) for n in range(3, len(vals) + 1, 3)]
    assert sorted(map(tuple, slid[["k", "fire_at", "s"]].values.tolist())) == sorted(exp)


def test_lateness_classes_partition_input(spark, sf):
    from tidewater.plans.change_queries import classified
    c = classified(spark, sf)
    counts = {r.lateness: r.n for r in c.groupBy("lateness").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(counts.values()) == spark.read.parquet(f"{sf}/events.parquet").count()
    assert set(counts) <= {lateness.ON_TIME, lateness.LATE, lateness.TOO_LATE}


def test_running_sum_exact_decimals(spark):
    df = spark.createDataFrame([(1, "a", 0.1), (2, "a", 0.2), (3, "a", 0.3)], "seq long, k string, v double")
    out = keyed.running_sum(df, "k", "seq", "v", exact_scale=2, block_size=1).orderBy("seq").collect()
    assert [r.running for r in out] == [0.1, 0.3, 0.6]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, block=st.sampled_from([1, 2, 5]), fanout=st.sampled_from([1, 2, 3]),
       depth=st.sampled_from([0, 1, 2]))
def test_recursive_prefix_any_fanout(spark, rows, block, fanout, depth):
    """The per-key prefix over block totals is itself blocked (recursively)."""
    old = scan.FANOUT, scan.MAX_DEPTH
    scan.FANOUT, scan.MAX_DEPTH = fanout, depth
    try:
        df, pdf = _frame(spark, rows)
        out = scan.running_many(df, ["k"], ["seq"], [("v", "sum", "s"), ("v", "min", "m")],
                                block_size=block).toPandas().sort_values("seq")
    finally:
        scan.FANOUT, scan.MAX_DEPTH = old
    g = pdf.sort_values("seq").groupby("k")["v"]
    assert list(out["s"]) == list(g.cumsum())
    assert list(out["m"]) == list(g.cummin())


def test_planned_blocks_hold_their_budget(spark):
    """Dense, sparse and bursty order columns, one key with a third of the rows."""
    n, budget = 30_000, 1_000
    i = F.col("id")
    orders = {
        "dense": i,
        "sparse": i * (1 << 23),
        "hot hour": F.when(i % 3 == 0, i * 1_000_000).otherwise(F.lit(5_000_000_000) + i),
        "negative": i * 997 - 40_000_000,
    }
    for name, seq in orders.items():
        df = spark.range(n).select(seq.alias("seq"), F.when(i % 3 == 0, "hot").otherwise((i % 50).cast("string")).alias("k"),
                                   (i % 11).alias("v"))
        blocks = scan.plan_blocks(df, "seq", budget, bins=256)
        sized = df.groupBy(scan.block_of(df, "seq", blocks).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("b").collect()
        assert max(r.n for r in sized) <= 2 * budget and len(sized) >= n // budget, name
        assert all(a.hi < b.lo for a, b in zip(sized, sized[1:])), name
        out = scan.running(df, ["k"], ["seq"], "v", out="s", block_size=blocks).toPandas().sort_values("seq")
        assert list(out["s"]) == list(out.groupby("k")["v"].cumsum()), name


def test_planned_blocks_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([(None, 1), (3, 2), (None, 4), (7, 8)], "seq long, v long")
    assert scan.plan_blocks(df.limit(0), "seq") == scan.Blocks()
    assert scan.plan_blocks(df.where("seq is null"), "seq", 1) == scan.Blocks()
    blocks = scan.plan_blocks(df, "seq", 1)
    got = df.select("seq", scan.block_of(df, "seq", blocks).alias("b")).collect()
    assert [r.b for r in got if r.seq is None] == [None, None] and len({r.b for r in got if r.seq}) == 2


@pytest.mark.parametrize("name", ["running_sum", "running_max", "changelog_group_sum", "count_tumbling", "count_sliding",
                                  "session_sum", "watermark_audit", "late_refire", "order_timeout_review"])
def test_ordered_queries_over_many_blocks(spark, sf, name, monkeypatch):
    """The same answer whether the table is one block or dozens."""
    from tidewater.plans import QUERIES
    one = sorted(map(str, QUERIES[name](spark, sf).collect()))
    monkeypatch.setattr(scan, "ROWS_PER_BLOCK", 40)
    assert sorted(map(str, QUERIES[name](spark, sf).collect())) == one
