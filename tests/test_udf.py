"""User-function surface: flatMap, map, filter, reduce, AggregateFunction."""

from tidewater.functions import udf
from tidewater.sources import basic as sources


def test_flat_map_map_filter(spark):
    lines = sources.inline(spark, [("a b",), ("c",), ("",)], "value string")
    words = udf.flat_map(lines, lambda r: [(w, 1) for w in r["value"].split(" ")], "word string, one long")
    assert sorted(r.word for r in words.collect()) == ["", "a", "b", "c"]
    upper = udf.map_rows(lines, lambda r: (r["value"].upper(),), "value string")
    assert sorted(r.value for r in upper.collect()) == ["", "A B", "C"]
    assert udf.filter_rows(lines, lambda r: r["value"] != "").count() == 2


def test_reduce_by_key_two_phase(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("id % 3 as k", "1 as n")
    out = udf.reduce_by_key(df, "k", lambda a, b: {"k": a["k"], "n": a["n"] + b["n"]})
    assert sorted((r.k, r.n) for r in out.collect()) == [(0, 334), (1, 333), (2, 333)]


def test_aggregate_function_average(spark):
    df = spark.range(0, 100, numPartitions=5).selectExpr("id % 2 as k", "cast(id as double) as price")
    out = udf.aggregate_by_key(
        df, "k",
        create=lambda: (0.0, 0),
        add=lambda acc, r: (acc[0] + r["price"], acc[1] + 1),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        result=lambda k, acc: (int(k), acc[0] / acc[1]),
        acc_schema="s double, c long", out_schema="k long, avg double")
    assert sorted((r.k, r.avg) for r in out.collect()) == [(0, 49.0), (1, 50.0)]
