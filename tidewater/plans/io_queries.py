"""Sources, sinks, record formats and partitioning over the driver's tables
(S2, S5-S7, S10, S11, K2-K4, K6, K7, K9, K10, P5-P7, P9, P10, P13, P14, X1-X8).

Sink queries write to a fresh folder under the shared checkpoint root and
return what a reader sees there afterwards.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import formats, records
from tidewater.functions.text import pair_text
from tidewater.operators import keyed, partitioning
from tidewater.plans.registry import query, table
from tidewater.session import scratch_path
from tidewater.sinks import basic as sinks
from tidewater.sinks.keyed_store import KeyedStore
from tidewater.sources import basic as sources
from tidewater.streaming import jobs as stream_jobs
from tidewater.streaming.recovery import IdempotentBatchSink, JobConfig, latest_per_key

EVENT_JSON_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

EVENTS_ALL = "select event_id, ts, user_id, event_type, value, props from events"


def events_topic(spark, sf):
    """``events`` as consumed from a topic: key = user id, value = JSON row."""
    ev = table(spark, sf, "events")
    frame = records.kafka_frame(ev, F.col("user_id"), records.to_json(F.struct(*ev.columns)), "events")
    return records.as_consumed(frame)


@query("src_kafka_decode", EVENTS_ALL)
def src_kafka_decode(spark, sf):
    return records.decode_value(events_topic(spark, sf), EVENT_JSON_SCHEMA)


@query("src_kafka_json", "select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def src_kafka_json(spark, sf):
    ev = table(spark, sf, "events")
    frame = records.kafka_frame(ev, F.col("event_id"), F.col("props"), "props")
    decoded = records.decode_value(frame, T.StructType([T.StructField("k", T.IntegerType())]), keep=["key"])
    return decoded.select(F.col("key").cast("string").cast("long").alias("event_id"), "k")


@query("sink_kafka_encode", """
select cast(user_id as varchar) as key,
       cast(json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type, 'value', value)
            as varchar) as value
from events
""")
def sink_kafka_encode(spark, sf):
    ev = table(spark, sf, "events")
    frame = records.kafka_frame(ev, F.col("user_id"),
                                F.to_json(F.struct("event_id", "user_id", "event_type", "value")), "out")
    return frame.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("sink_kafka_json", """
select cast(json_object('user_id', user_id, 'page_id', event_id, 'status', event_type) as varchar) as value
from events
""")
def sink_kafka_json(spark, sf):
    """``insert into output_kafka select *`` with JSON format, round-robin partitioner."""
    ev = table(spark, sf, "events").select("user_id", F.col("event_id").alias("page_id"),
                                          F.col("event_type").alias("status"))
    frame = records.kafka_frame(ev, None, records.row_json(ev, sort_keys=False), "output_kafka")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return partitioning.rebalance(frame, tasks).select(F.col("value").cast("string").alias("value"))


@query("src_generated_orders", """
select 'order-' || cast(event_id as varchar) as order_id, cast(event_id % 3 as integer) as user_id,
       cast((event_id * 37) % 101 as integer) as money, ts as create_time
from events
""")
def src_generated_orders(spark, sf):
    ev = table(spark, sf, "events")
    return sources.generated_orders(ev, "event_id", F.col("ts"))


@query("src_sequence", """
select range as value from range((select min(event_id) from events), (select max(event_id) from events) + 1)
where range > 10
""")
def src_sequence(spark, sf):
    """``fromSequence(min, max)`` over the id range of ``events``, then ``> 10`` (P5)."""
    b = table(spark, sf, "events").agg(F.min("event_id").alias("a"), F.max("event_id").alias("b")).first()
    return sources.sequence(spark, b["a"], b["b"]).where(F.col("value") > 10)


BYTES_PER_FILE = 128 << 20
MAX_FILES_PER_BATCH = 4096


def documents_as_text(spark, sf, path: str) -> int:
    """Write each document's text as text files (its newlines become lines); the number of
    files follows from the size of the texts and is returned."""
    texts = table(spark, sf, "documents").select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(4, -(-size // BYTES_PER_FILE))
    texts.repartition(files).write.mode("overwrite").text(path)
    return files


_LINES_SQL = "select unnest(string_split(text, chr(10))) as value from documents"


@query("src_text", _LINES_SQL)
def src_text(spark, sf):
    """``readTextFile``: one row per line of files written from ``documents``."""
    path = scratch_path(spark, "documents-text")
    documents_as_text(spark, sf, path)
    return sources.text(spark, path)


@query("stream_wordcount", f"""
select word, cast(count(*) as bigint) as n from (
  select unnest(string_split(rtrim(value, ' '), ' ')) as word
  from ({_LINES_SQL}) where not (value <> '' and rtrim(value, ' ') = '')
) group by word
""")
def stream_wordcount(spark, sf):
    """Word count over a line stream (S4 -> A2 in update mode -> K8): files
    arrive a quarter of them per micro-batch (4,096 at most), each batch's updated counts go to an
    idempotent per-batch sink, and the final count is the latest update."""
    src = scratch_path(spark, "lines")
    files = documents_as_text(spark, sf, src)
    sink = IdempotentBatchSink(scratch_path(spark, "wordcount-updates"))
    lines = sources.text_stream(spark, src, max_files_per_trigger=min(-(-files // 4), MAX_FILES_PER_BATCH))
    cfg = JobConfig(checkpoint_location=scratch_path(spark, "wordcount-ckpt"), available_now=True)
    q = cfg.apply(stream_jobs.word_counts_stream(lines).writeStream.outputMode("update").foreachBatch(sink)).start()
    q.awaitTermination()
    return latest_per_key(sink.read(spark), "word", "n")


@query("src_view", "select r_regionkey, r_name from region")
def src_view(spark, sf):
    return sources.view(table(spark, sf, "region"), "region_view", ["r_regionkey", "r_name"])


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("src_catalog_table", "select r_regionkey, r_name from region")
def src_catalog_table(spark, sf):
    name = _table_name("tw_region")
    sinks.create_table(table(spark, sf, "region"), name, scratch_path(spark, name))
    return sources.catalog_table(spark, name)


@query("sink_catalog_self_append", "select * from region union all select * from region")
def sink_catalog_self_append(spark, sf):
    name = _table_name("tw_person")
    sinks.create_table(table(spark, sf, "region"), name, scratch_path(spark, name))
    sinks.insert_select(spark, name, f"SELECT * FROM {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


@query("sink_text_tuple", """
select '(' || cast(user_id as varchar) || ',' || cast(count(*) as varchar) || ')' as value
from events group by user_id
""")
def sink_text_tuple(spark, sf):
    counts = keyed.keyed_count(table(spark, sf, "events"), "user_id", "n")
    path = scratch_path(spark, "tuples")
    sinks.write_tuples(counts, ["user_id", "n"], path, files=2)
    return sources.text(spark, path)


def _rolling(spark, sf, bucket_fn, name):
    ev = table(spark, sf, "events")
    path = scratch_path(spark, name)
    line = pair_text(F.col("event_id"), F.col("event_type"), ":::")
    sinks.write_rolling(ev, line, bucket_fn(F.col("ts")), path, max_records_per_file=1_000_000, time_col="ts")
    return sinks.read_rolling(spark, path)


@query("sink_rolling_bucketed", """
select cast(event_id as varchar) || ':::' || event_type as value, strftime(ts, '%Y-%m-%d') as dt from events
""")
def sink_rolling_bucketed(spark, sf):
    return _rolling(spark, sf, sinks.bucket_daily, "rolling-daily")


@query("sink_rolling_hourly", """
select cast(event_id as varchar) || ':::' || event_type as value, strftime(ts, '%Y-%m-%d--%H') as dt from events
""")
def sink_rolling_hourly(spark, sf):
    return _rolling(spark, sf, sinks.bucket_hourly, "rolling-hourly")


@query("sink_keyed_upsert", """
select 'wcresult' as hash, cast(user_id as varchar) as field, cast(count(*) as varchar) as value
from events group by user_id
""")
def sink_keyed_upsert(spark, sf):
    """Running count per user streamed into ``HSET wcresult <user> <count>``,
    in two batches (first half of the month, then the rest), with a compaction and a replay between them."""
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id")
    running = keyed.running_sum(ev.withColumn("one", F.lit(1)), "user_id", "event_id", "one",
                                out="cnt", exact_scale=None)
    store = KeyedStore(spark, scratch_path(spark, "wcresult"), formats.UPSERT_HASH)
    cut = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    first, rest = running.where(cut), running.where(~cut)
    store.upsert(first, "user_id", "cnt", "event_id", 0)
    store.compact()
    store.upsert(first, "user_id", "cnt", "event_id", 0)  # a replay after the compaction
    store.upsert(rest, "user_id", "cnt", "event_id", 1)
    return store.state()


@query("filter_threshold", "select event_id, value from events where value > 10")
def filter_threshold(spark, sf):
    return table(spark, sf, "events").where(F.col("value") > 10).select("event_id", "value")


@query("filter_contains", "select event_id, props from events where props like '%9%'")
def filter_contains(spark, sf):
    return table(spark, sf, "events").where(F.col("props").contains("9")).select("event_id", "props")


@query("sql_filter_status", f"{EVENTS_ALL} where event_type = 'purchase'")
def sql_filter_status(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("tw_events")
    return spark.sql(EVENTS_ALL.replace("from events", "from tw_events") + " where event_type = 'purchase'")


@query("sql_project_date", """
select user_id, event_type, value, strftime(ts, '%Y-%m-%d') as tp from events where value > 2
""")
def sql_project_date(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("tw_events")
    return spark.sql("""select user_id, event_type, value, date_format(ts, 'yyyy-MM-dd') as tp
                        from tw_events where value > 2""")


@query("parse_csv_records", """
select event_id, cast(user_id as varchar) as sensor_id, cast(event_id % 10 as integer) as count from events
""")
def parse_csv_records(spark, sf):
    ev = table(spark, sf, "events")
    lines = ev.select("event_id", F.concat_ws(",", "user_id", F.pmod("event_id", F.lit(10))).alias("line"))
    return lines.select("event_id", *records.parse_csv("line", [("sensor_id", "string"), ("count", "int")]))


@query("map_format_pairs", """
select event_type, event_type || ':::' || cast(count(*) as varchar) as pair3,
       event_type || ':' || cast(count(*) as varchar) as pair1
from events group by event_type
""")
def map_format_pairs(spark, sf):
    c = keyed.keyed_count(table(spark, sf, "events"), "event_type", "n")
    return c.select("event_type", pair_text("event_type", "n", formats.PAIR_SEPARATOR).alias("pair3"),
                    pair_text("event_type", "n", formats.PAIR_SEPARATOR_SHORT).alias("pair1"))


@query("row_to_json", """
select o_orderkey,
       cast(json_object('o_custkey', o_custkey, 'o_orderkey', o_orderkey, 'o_orderpriority', o_orderpriority,
                        'o_orderstatus', o_orderstatus) as varchar) as json
from orders
""")
def row_to_json(spark, sf):
    o = table(spark, sf, "orders")
    cols = ["o_orderstatus", "o_orderkey", "o_orderpriority", "o_custkey"]
    return o.select("o_orderkey", records.row_json(o, cols).alias("json"))


@query("partition_custom", "select event_id, user_id, cast(user_id % 4 as integer) as partition from events")
def partition_custom(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id")
    return partitioning.with_task_id(partitioning.custom(ev, 4, F.col("user_id")))


@query("partition_suite", """
select mode, n, cast(0 as bigint) as misplaced from (
  select 'broadcast' as mode, 4 * count(*) as n from events union all
  select 'forward', count(*) from events union all
  select 'shuffle', count(*) from events union all
  select 'rebalance', count(*) from events union all
  select 'rescale', count(*) from events union all
  select 'custom', count(*) from events union all
  select 'key_by', count(*) from events)
""")
def partition_suite(spark, sf):
    """Rows that reach the next stage under each partitioning mode, and what a wrong
    partitioner would misplace:

    * broadcast: copies of a replica number in more than one task, or two numbers in one
    * forward: rows in another task than before
    * shuffle: tasks further than eight standard deviations from an equal share
    * rebalance: tasks further from an equal share than one row for each task that sends
    * rescale: earlier tasks whose rows were torn apart
    * custom: rows in another task than the key names
    * key_by: keys in more than one task

    ``global()`` (all rows to one task) is left out on purpose: it is only
    meant for small bounded inputs and is covered by the unit tests."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ev = table(spark, sf, "events").select("event_id", "user_id").withColumn("sender", F.spark_partition_id())
    one = F.count(F.lit(1)).alias("n")

    def placed(df, *cols):
        return partitioning.with_task_id(df, "task").groupBy(*cols, "task").agg(one)

    def report(mode, groups, wrong):
        return groups.agg(F.sum("n").alias("n"), wrong.cast("long").alias("misplaced")).select(
            F.lit(mode).alias("mode"), "n", "misplaced")

    def split(groups, col):
        return groups.groupBy(col).agg(F.sum("n").alias("n"), (F.count(F.lit(1)) > 1).cast("long").alias("torn"))

    def uneven(groups, slack):
        share = F.sum("n") / n
        far = F.greatest(F.max("n") - share, share - F.when(F.count(F.lit(1)) < n, 0).otherwise(F.min("n")))
        return F.when(far > slack(share), 1).otherwise(0)

    copies = placed(partitioning.replicate(ev, 4), "replica")
    rebalanced = placed(partitioning.rebalance(ev, n), "sender").groupBy("task").agg(
        F.sum("n").alias("n"), F.collect_set("sender").alias("senders"))
    forward = placed(partitioning.forward(ev), "sender")
    custom = placed(partitioning.custom(ev, n, F.col("user_id")), "user_id")
    mixed = placed(partitioning.shuffle(ev, n))
    parts = [
        report("broadcast", copies, F.count(F.lit(1)) - F.least(F.countDistinct("replica"), F.countDistinct("task"))),
        report("forward", forward, F.sum(F.when(F.col("sender") != F.col("task"), F.col("n")).otherwise(0))),
        report("shuffle", mixed, uneven(mixed, lambda share: 8 * F.sqrt(share) + 1)),
        report("rebalance", rebalanced, uneven(rebalanced, lambda share: F.max(F.size("senders")))),
        report("rescale", split(placed(partitioning.rescale(ev, n), "sender"), "sender"), F.sum("torn")),
        report("custom", custom,
               F.sum(F.when(F.pmod("user_id", F.lit(n)) != F.col("task"), F.col("n")).otherwise(0))),
        report("key_by", split(placed(partitioning.key_by(ev, n, "user_id"), "user_id"), "user_id"), F.sum("torn")),
    ]
    return reduce(DataFrame.unionByName, parts)
