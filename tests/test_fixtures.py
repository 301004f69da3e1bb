"""Golden tests from the reference's inline inputs (FIXTURES.md section 1)."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.functions.text import java_split, tokens
from tidewater.operators import changelog, joins, keyed, routing, windows
from tidewater.sources import basic as sources


def test_wordcount_lines4(spark):
    lines = sources.inline(spark, [("lemon hadoop spark",), ("lemon hadoop spark",),
                                   ("lemon hadoop",), ("lemon",)], "value string")
    counts = {r.word: r.n for r in keyed.keyed_count(tokens(lines), "word", "n").collect()}
    assert counts == {"lemon": 4, "hadoop": 3, "spark": 2}


def test_text_file_source(spark, tmpdir_path):
    path = f"{tmpdir_path}/words.txt"
    with open(path, "w") as f:
        f.write("hello world")  # no final newline
    counts = {r.word: r.n for r in keyed.keyed_count(tokens(sources.text(spark, path)), "word", "n").collect()}
    assert counts == {"hello": 1, "world": 1}


def test_java_split_edges(spark):
    df = sources.inline(spark, [(0, "a b  "), (1, ""), (2, " "), (3, " a")], "i int, value string")
    got = {r.i: r.w for r in df.select("i", java_split("value").alias("w")).collect()}
    assert got == {0: ["a", "b"], 1: [""], 2: [], 3: ["", "a"]}


def test_union_distinct_orders(spark):
    schema = "user long, product string, amount int"
    a = sources.inline(spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], schema)
    b = sources.inline(spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], schema)
    got = routing.union_distinct(a.where("amount > 2"), b.where("amount > 1")).collect()
    assert sorted(map(tuple, got)) == [(1, "beer", 3), (1, "diaper", 4), (2, "pen", 3), (2, "rubber", 3)]
    assert routing.union_all(a, b).count() == 6


def test_changelog_word_freq(spark):
    df = sources.inline(spark, [(1, "Hello", 1), (2, "World", 1), (3, "Hello", 1)],
                        "seq long, word string, frequency long")
    ch = changelog.aggregate_changelog(df, "word", "seq", "frequency", "sum", "frequency")
    got = [(r.flag, r.word, r.frequency) for r in ch.orderBy("seq", "change_seq").collect()]
    assert got == [(True, "Hello", 1), (True, "World", 1), (False, "Hello", 1), (True, "Hello", 2)]
    having = changelog.having_changelog(ch, F.col("frequency") == 2)
    assert [(r.flag, r.word, r.frequency) for r in having.collect()] == [(True, "Hello", 2)]


def test_changelog_distinct_first_occurrence(spark):
    df = sources.inline(spark, [(1, "a"), (2, "b"), (3, "a")], "seq long, w string")
    got = sorted(map(tuple, changelog.distinct_changelog(df, ["w"], "seq").collect()))
    assert got == [(True, "a", 1), (True, "b", 2)]


CITY = [(1, "北京", 1), (2, "上海", 2), (3, "北京", 6), (4, "上海", 8), (5, "北京", 3), (6, "上海", 4)]


def test_max_by_and_running_max(spark):
    df = sources.inline(spark, CITY, "seq long, city string, value long")
    best = {r.city: r.value for r in keyed.max_by_row(df, "city", "value", "seq").collect()}
    assert best == {"北京": 6, "上海": 8}
    run = keyed.running_max(df, "city", "seq", "value").orderBy("seq").collect()
    assert [(r.city, r.value, r.max_so_far) for r in run] == [
        ("北京", 1, 1), ("上海", 2, 2), ("北京", 6, 6), ("上海", 8, 8), ("北京", 3, 6), ("上海", 4, 8)]


def test_max_by_tie_first_arrival(spark):
    df = sources.inline(spark, [(1, "k", 5, "first"), (2, "k", 5, "second")], "seq long, k string, v long, tag string")
    assert keyed.max_by_row(df, "k", "v", "seq").first().tag == "first"


def test_max_by_null_keys_and_values(spark):
    df = sources.inline(spark, [("a", 1, None), ("a", 2, 5.0), ("a", 3, 5.0), (None, 4, 1.0), (None, 5, 2.0),
                                ("b", 6, None), ("b", 7, None)], "k string, seq long, v double")
    got = sorted(map(tuple, keyed.max_by_row(df, "k", "v", "seq").collect()), key=str)
    assert got == [("a", 2, 5.0), ("b", 6, None), (None, 5, 2.0)]


def test_count_windows(spark):
    schema = "seq long, sensor_id string, count int"
    five = sources.inline(spark, [(1, "1", 1), (2, "1", 1), (3, "1", 1), (4, "1", 1), (5, "2", 1), (6, "1", 1)],
                          schema)
    got = windows.count_tumbling(five, "sensor_id", "seq", 5, [F.sum("count").alias("s")]).collect()
    assert [(r.sensor_id, r.s) for r in got] == [("1", 5)]
    slid = sources.inline(spark, [(1, "1", 1), (2, "1", 1), (3, "2", 1), (4, "1", 1), (5, "2", 1),
                                  (6, "3", 1), (7, "4", 1)], schema)
    got = windows.count_sliding(slid, "sensor_id", "seq", 5, 3, F.col("count"), "s").collect()
    assert [(r.sensor_id, r.s) for r in got] == [("1", 3)]


def test_session_windows(spark):
    rows = [("2024-01-01 00:00:01", "1", 1), ("2024-01-01 00:00:03", "1", 1),
            ("2024-01-01 00:00:02", "2", 1), ("2024-01-01 00:00:05", "2", 1)]
    df = sources.inline(spark, rows, "t string, sensor_id string, count int") \
        .withColumn("ts", F.to_timestamp("t"))
    got = windows.session(df, "ts", 10, "sensor_id", [F.sum("count").alias("s")]).collect()
    assert sorted((r.sensor_id, r.s) for r in got) == [("1", 2), ("2", 2)]


def test_session_gap_boundary_merges(spark):
    rows = [("2024-01-01 00:00:00", "k"), ("2024-01-01 00:00:10", "k"), ("2024-01-01 00:00:21", "k")]
    df = sources.inline(spark, rows, "t string, k string").withColumn("ts", F.to_timestamp("t"))
    got = windows.session(df, "ts", 10, "k", [F.count(F.lit(1)).alias("n")]).orderBy("session_start").collect()
    assert [r.n for r in got] == [2, 1]  # exactly one gap apart merges; 11 s apart splits


def test_side_output_parity(spark):
    ints = sources.inline(spark, [(i,) for i in range(1, 11)], "value int")
    outs = routing.split_by_tag(ints, routing.parity_tag("value"), {"even": 0, "odd": 1})
    assert outs["main"].count() == 0
    assert sorted(r.value for r in outs["odd"].collect()) == [1, 3, 5, 7, 9]
    assert sorted(r.value for r in outs["even"].collect()) == [2, 4, 6, 8, 10]


def test_connect_comap(spark):
    names = sources.inline(spark, [("hadoop",), ("spark",), ("storm",)], "value string")
    longs = sources.inline(spark, [(1,), (2,), (3,)], "value long")
    got = routing.connect_map(names, longs, lambda d: F.concat(F.lit("String:"), F.col("value")),
                              lambda d: F.concat(F.lit("Long:"), F.col("value").cast("string")))
    assert sorted(r.value for r in got.collect()) == sorted(
        ["String:hadoop", "String:spark", "String:storm", "Long:1", "Long:2", "Long:3"])


def test_sequences(spark):
    assert sources.sequence(spark, 1, 100).count() == 100
    s = sources.sequence(spark, 0, 100)
    assert s.count() == 101
    assert s.where(F.col("value") > 10).count() == 90


def test_lookup_missing_gets_default(spark):
    cats = sources.inline(spark, [(i, None) for i in range(1, 6)], "id int, name string")
    facts = sources.inline(spark, [(1,), (3,), (9,)], "cid int")
    got = joins.lookup_enrich(facts, cats, "cid", "id", "name", "name").collect()
    assert all(r.name == "未知" for r in got)
    null_mode = joins.lookup_enrich(facts, cats, "cid", "id", "name", "name", on_missing="null").collect()
    assert all(r.name is None for r in null_mode)


def test_broadcast_enrich_user_info(spark):
    users = sources.inline(spark, [("user_1", "张三", 10), ("user_2", "李四", 20), ("user_3", "王五", 30),
                                   ("user_4", "赵六", 40)], "userID string, userName string, userAge int")
    events = sources.inline(spark, [("user_2", "click"), ("user_9", "view")], "userID string, eventType string")
    got = joins.enrich(events, users, "userID", "inner").collect()
    assert [(r.userID, r.userName, r.userAge) for r in got] == [("user_2", "李四", 20)]
    assert joins.enrich(events, users, "userID", "left").count() == 2


def test_window_join_goods(spark):
    goods = sources.inline(spark, [("1", "小米12", Decimal("4890")), ("2", "iphone12", Decimal("12000"))],
                           "goods_id string, goods_name string, goods_price decimal(18,2)") \
        .withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:00:01")))
    items = sources.inline(spark, [("a", "1", 2), ("a", "111", 2), ("b", "2", 1)],
                           "item_id string, goods_id string, count int") \
        .withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:00:03")))
    j = joins.window_join(goods, items, "goods_id", "ts", "ts", 5)
    got = sorted((r.goods_id, r.goods_name, r.total) for r in j.select(
        "goods_id", "l.goods_name", (F.col("l.goods_price") * F.col("r.count")).alias("total")).collect())
    assert got == [("1", "小米12", Decimal("9780.00")), ("2", "iphone12", Decimal("12000.00"))]


def test_interval_join_bounds_inclusive(spark):
    base = F.to_timestamp(F.lit("2024-01-01 00:00:10"))
    left = sources.inline(spark, [("k", 0)], "k string, off int").withColumn("ts", base)
    right = sources.inline(spark, [("k", -3), ("k", -2), ("k", 0), ("k", 1), ("k", 2)], "k string, off int") \
        .withColumn("ts", base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("off")))
    got = joins.interval_join(left, right, "k", "ts", "ts", -2, 1).select("r.off").collect()
    assert sorted(r.off for r in got) == [-2, 0, 1]


def test_random_orders_ranges(spark):
    ids = spark.range(2000)
    rows = sources.random_orders(ids).collect()
    assert len({r.order_id for r in rows}) == 2000
    assert {r.user_id for r in rows} == {0, 1, 2}
    assert min(r.money for r in rows) >= 0 and max(r.money for r in rows) <= 100
