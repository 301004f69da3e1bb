"""Keyed state, watermarked windows and union distinct as Structured Streaming queries over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.timecols import as_event_time, as_ntz
from tidewater.operators import keyed, routing
from tidewater.plans.arrival import arriving, run_batches, run_stream, until_end
from tidewater.plans.registry import query, table
from tidewater.session import scratch_path
from tidewater.streaming import jobs, processors
from tidewater.streaming.recovery import IdempotentBatchSink


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


def _cents(s: DataFrame) -> DataFrame:
    return s.withColumn("value", keyed.exact("value"))


@query("stream_running_sum", """
select user_id, event_id, value,
       cast(sum(cast(value as decimal(18,2))) over (partition by user_id order by event_id
            rows between unbounded preceding and current row) as double) as running_value
from events
""")
def stream_running_sum(spark, sf):
    """Running sum per user from keyed value state, a row out for each row in."""
    out = run_stream(spark, _events(spark, sf), "event_id",
                     lambda s: processors.running_stream(_cents(s), "user_id", "event_id", "value", "sum"), "running-sum")
    return out.select("user_id", "event_id", F.col("value").cast("double").alias("value"),
                      F.col("result").cast("double").alias("running_value"))


@query("stream_running_max", """
select user_id, event_id, value,
       max(value) over (partition by user_id order by event_id
            rows between unbounded preceding and current row) as max_so_far
from events
""")
def stream_running_max(spark, sf):
    """Running maximum per user from keyed value state."""
    out = run_stream(spark, _events(spark, sf), "event_id",
                     lambda s: processors.running_stream(s, "user_id", "event_id", "value", "max"), "running-max")
    return out.withColumnRenamed("result", "max_so_far")


@query("stream_changelog", """
with r as (select event_id, user_id, row_number() over (partition by user_id order by event_id) as n from events)
select event_id, cast(1 as integer) as change_seq, true as flag, user_id, n as cnt from r
union all
select event_id, cast(0 as integer), false, user_id, n - 1 from r where n > 1
""")
def stream_changelog(spark, sf):
    """Retract changelog of a count per user: the old count out, the new one in."""
    out = run_stream(spark, _events(spark, sf), "event_id",
                     lambda s: processors.running_stream(s, "user_id", "event_id", None, "count", changelog=True), "changelog")
    return out.withColumnRenamed("result", "cnt")


@query("stream_count_tumbling", """
with r as (select user_id, value, row_number() over (partition by user_id order by event_id) as n from events)
select user_id, max(n) as fire_at, cast(sum(cast(value as decimal(18,2))) as double) as value_sum
from r group by user_id, (n - 1) // 5 having count(*) = 5
""")
def stream_count_tumbling(spark, sf):
    """Count windows of five rows per user; open ones wait for more rows."""
    out = run_stream(spark, _events(spark, sf), "event_id",
                     lambda s: processors.count_window_stream(_cents(s), "user_id", "event_id", "value", 5),
                     "count-tumbling")
    return out.withColumn("value_sum", F.col("value_sum").cast("double"))


@query("stream_count_sliding", """
with r as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as n from events),
s as (select user_id, n, cast(sum(cast(value as decimal(18,2))) over (partition by user_id order by n
             rows between 4 preceding and current row) as double) as value_sum from r)
select user_id, n as fire_at, value_sum from s where n % 3 = 0
""")
def stream_count_sliding(spark, sf):
    """Every third row of a user, the sum of the last five."""
    out = run_stream(spark, _events(spark, sf), "event_id",
                     lambda s: processors.count_window_stream(_cents(s), "user_id", "event_id", "value", 5, 3),
                     "count-sliding")
    return out.withColumn("value_sum", F.col("value_sum").cast("double"))


@query("stream_tumbling", """
with w as (select time_bucket(interval '1 hour', ts, timestamp '1970-01-01') as window_start, event_type,
                  cast(sum(cast(value as decimal(18,2))) as double) as value_sum
           from events group by 1, 2)
select window_start, window_start + interval '1 hour' as window_end, event_type, value_sum from w
""")
def stream_tumbling(spark, sf):
    """Hourly sums per event type with a watermark of two hours; rows arrive up to an
    hour out of order. A window comes out when the watermark passes its end, the last ones at
    the end of the input."""
    ev = as_event_time(table(spark, sf, "events"), "ts").select("event_id", "ts", "event_type", "value")
    late = (F.unix_micros("ts") / F.lit(60_000_000)).cast("long") + F.pmod(F.col("event_id") * 7919, F.lit(60))
    out = run_stream(spark, ev.withColumn("arrival", late), "arrival",
                     lambda s: jobs.windowed_sum_stream(_cents(s), "ts", "1 hour", "2 hours", "event_type", "value",
                                                       keep=lambda w: until_end(w, "ts")), "tumbling", ends="ts")
    return as_ntz(out, "window_start", "window_end")


@query("stream_union_distinct", """
select user_id, event_type from events where value > 50
union
select user_id, event_type from events where event_type = 'purchase'
""")
def stream_union_distinct(spark, sf):
    """``UNION`` of two streams: each row once, when it first comes."""
    def make(s):
        a, b = s.where("value > 50"), s.where("event_type = 'purchase'")
        return a.select("user_id", "event_type").union(b.select("user_id", "event_type")).dropDuplicates()
    return run_stream(spark, _events(spark, sf), "event_id", make, "union-distinct")


REVIEW_DAYS = 30

_REVIEW_SQL = f"""
with o as (select 'c' || o_custkey as user_id, 'o' || o_orderkey as order_id, o_orderdate as created,
                  o_orderkey % 2 = 0 as reviewed from orders),
t as (select user_id, created + interval '{REVIEW_DAYS} days' as fire from o),
n as (select o.*, (select min(t.fire) from t where t.user_id = o.user_id and t.fire >= o.created) as first_fire from o),
a as (select user_id, order_id, case when reviewed then 'already_reviewed' else 'auto_good' end as action,
             case when reviewed then first_fire else created + interval '{REVIEW_DAYS} days' end as action_time from n)
select user_id, order_id, action, cast(epoch_ms(cast(action_time as timestamp)) as bigint) as action_ms
from a where action_time <= (select max(o_orderdate) from orders)
"""


@query("stream_order_timeout", _REVIEW_SQL)
def stream_order_timeout(spark, sf):
    """Automatic good reviews by event-time timers and map state, ids as strings. Timers up to
    the last watermark (the newest order) have fired."""
    o = table(spark, sf, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("ordr"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        (F.pmod("o_orderkey", F.lit(2)) == 0).alias("reviewed"))
    o = o.withColumn("created_ms", F.unix_millis("ts"))
    return run_stream(
        spark, o, "created_ms",
        lambda s: processors.order_timeout_stream(s.withWatermark("ts", "0 seconds"), "user", "ordr", "created_ms",
                                                  "reviewed", REVIEW_DAYS * 86_400_000), "order-timeout")


@query("stream_side_output", """
select case when event_id % 2 = 0 then 'even' else 'odd' end as tag, event_id, value from events
""")
def stream_side_output(spark, sf):
    """Side outputs of a stream from one pass: a batch is written once, in a folder for each tag."""
    rows = table(spark, sf, "events").select("event_id", "value")
    sink = IdempotentBatchSink(scratch_path(spark, "side-out"), partition_by=["tag"])
    tagged = routing.tag_rows(arriving(spark, rows, "event_id", "side")(), routing.parity_tag("event_id"))
    run_batches(spark, tagged, sink, "side")
    return sink.read(spark).select("tag", "event_id", "value")


@query("stream_broadcast_enrich", """
select e.event_id, e.user_id, c.c_name from events e join customer c on e.user_id = c.c_custkey
""")
def stream_broadcast_enrich(spark, sf):
    """Events enriched with the customer table, which every micro-batch reads afresh."""
    rows = table(spark, sf, "events").select("event_id", "user_id")
    sink = IdempotentBatchSink(scratch_path(spark, "enrich-out"))

    def customers(session):
        return table(session, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    run_batches(spark, arriving(spark, rows, "event_id", "enrich")(),
                jobs.enrich_each_batch(customers, "user_id", "inner", sink), "enrich")
    return sink.read(spark).select("event_id", "user_id", "c_name")
