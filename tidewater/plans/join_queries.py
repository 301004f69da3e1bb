"""Join, union and routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import formats
from tidewater.operators import joins, routing, scan, versions
from tidewater.functions.timecols import as_event_time
from tidewater.plans.registry import query, table
from tidewater.plans.arrival import arriving, run_batches
from tidewater.session import scratch_path
from tidewater.streaming import jobs as stream_jobs
from tidewater.streaming.recovery import IdempotentBatchSink

B10 = "time_bucket(interval '10 hours', ts, timestamp '1970-01-01')"


def purchases(ev):
    return ev.where(F.col("event_type") == "purchase")


_WINDOW_JOIN_SQL = f"""
with l as (select *, {B10} as b from events),
     r as (select *, {B10} as b from events where event_type = 'purchase')
select l.b as window_start, l.b + interval '10 hours' as window_end, l.user_id,
       l.event_id as l_event_id, r.event_id as r_event_id,
       cast(cast(l.value as decimal(18,2)) * cast(r.value as decimal(18,2)) as double) as amount
from l join r on l.user_id = r.user_id and l.b = r.b
"""


@query("window_join", _WINDOW_JOIN_SQL)

def window_join(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    j = joins.window_join(ev, purchases(ev), "user_id", "ts", "ts", 10 * 3600)
    amount = F.col("l.value").cast("decimal(18,2)") * F.col("r.value").cast("decimal(18,2)")
    return j.select("window_start", "window_end", "user_id", F.col("l.event_id").alias("l_event_id"),
                    F.col("r.event_id").alias("r_event_id"), amount.cast("double").alias("amount"))


_INTERVAL_JOIN_SQL = """
select l.event_id as l_event_id, r.event_id as r_event_id, l.user_id, l.ts as l_ts, r.ts as r_ts
from events l join events r
  on l.user_id = r.user_id and r.event_type = 'purchase'
 and r.ts between l.ts - interval '2 hours' and l.ts + interval '1 hours'
"""


@query("interval_join", _INTERVAL_JOIN_SQL)

def interval_join(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    j = joins.interval_join(ev, purchases(ev), "user_id", "ts", "ts", -2 * 3600, 3600)
    return j.select(F.col("l.event_id").alias("l_event_id"), F.col("r.event_id").alias("r_event_id"),
                    F.col("l.user_id").alias("user_id"), F.col("l.ts").alias("l_ts"),
                    F.col("r.ts").alias("r_ts"))


@query("broadcast_enrich", """
select o_orderkey, o_custkey, o_totalprice, c_name, c_nationkey
from orders join customer on o_custkey = c_custkey
""")
def broadcast_enrich(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return joins.enrich(orders, cust, "o_custkey", "inner")


@query("enrich_as_of", """
with v as (select user_id, ts, event_id as purchase_id, value as purchase_value from events where event_type = 'purchase'),
f as (select event_id, user_id, ts, event_type from events where event_type <> 'purchase')
select f.event_id, f.user_id, f.ts, f.event_type, v.purchase_id, v.purchase_value
from f asof join v on f.user_id = v.user_id and f.ts >= v.ts
""")
def enrich_as_of(spark, sf):
    """Versioned broadcast state: every event with its user's newest purchase at that time;
    events before a user's first purchase are dropped."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    bought = F.col("event_type") == "purchase"
    return versions.enrich_as_of(ev.where(~bought).drop("value"), ev.where(bought), ["user_id"], "ts", "ts",
                                 {"purchase_id": "event_id", "purchase_value": "value"}, block_size=scan.plan_blocks(ev, "ts"))


@query("lookup_enrich_default", """
select d.doc_id, coalesce(l.label, '未知') as label
from documents d
left join (select doc_id, case when quality = 1 then 'good' else 'poor' end as label from labels) l
  on d.doc_id = l.doc_id
""")
def lookup_enrich_default(spark, sf):
    """Each document's quality label looked up in ``labels``, which covers only
    some documents: a miss gets the reference's fallback name."""
    docs = table(spark, sf, "documents").select("doc_id")
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("label_doc"),
        F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("poor")).alias("label"))
    return joins.lookup_enrich(docs, labels, "doc_id", "label_doc", "label", "label")


_UNION_PARTS = ("select user_id, event_type from events where value > 50",
                "select user_id, event_type from events where value > 20")


def _union_of_views(spark, sf):
    """Both union inputs are filtered views of ``events``: read it once."""
    ev = table(spark, sf, "events").select("user_id", "event_type", "value")
    return routing.union_filtered(ev, F.col("value") > 50, F.col("value") > 20).drop("value")


@query("union_all", " union all ".join(_UNION_PARTS))
def union_all(spark, sf):
    return _union_of_views(spark, sf)


@query("union_distinct", " union ".join(_UNION_PARTS))
def union_distinct(spark, sf):
    return _union_of_views(spark, sf).distinct()


@query("side_output_split", """
select case when event_id % 2 = 0 then 'even' else 'odd' end as tag, event_id, value from events
""")
def side_output_split(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    # every side output in one frame, one read (split_by_tag gives the separate views)
    return routing.tag_rows(ev, routing.parity_tag("event_id")).select("tag", "event_id", "value")


@query("connect_comap", """
select 'String:' || r_name as value from region
union all
select 'Long:' || cast(n_nationkey as varchar) as value from nation
""")
def connect_comap(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    return routing.connect_map(
        region, nation,
        lambda d: F.concat(F.lit(formats.CONNECT_STRING_PREFIX), F.col("r_name")),
        lambda d: F.concat(F.lit(formats.CONNECT_LONG_PREFIX), F.col("n_nationkey").cast("string")))


def _event_streams(spark, sf):
    """``events`` arriving in slices, read as two streams (all events, purchases)."""
    ev = as_event_time(table(spark, sf, "events"), "ts").select("event_id", "ts", "user_id", "event_type", "value")
    stream = arriving(spark, ev, "event_id", "events")
    return stream(), purchases(stream())


def _run_stream(spark, df, name):
    sink = IdempotentBatchSink(scratch_path(spark, name))
    run_batches(spark, df, sink, name)
    return sink.read(spark).drop("batch")


@query("stream_window_join", _WINDOW_JOIN_SQL)
def stream_window_join(spark, sf):
    """Stream-stream window join (J1 in a stream): both sides watermarked,
    joined on (user, 10 h window); join state is evicted by the watermarks."""
    left, right = _event_streams(spark, sf)
    j = stream_jobs.window_join_stream(left, right, "user_id", "ts", "ts", 10 * 3600, "1 hour")
    amount = F.col("l.value").cast("decimal(18,2)") * F.col("r.value").cast("decimal(18,2)")
    out = j.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                   F.col("window_end").cast("timestamp_ntz").alias("window_end"), "user_id",
                   F.col("l.event_id").alias("l_event_id"), F.col("r.event_id").alias("r_event_id"),
                   amount.cast("double").alias("amount"))
    return _run_stream(spark, out, "window-join-out")


@query("stream_interval_join", _INTERVAL_JOIN_SQL)
def stream_interval_join(spark, sf):
    """Stream-stream interval join (J2 in a stream), state bounded by both watermarks."""
    left, right = _event_streams(spark, sf)
    j = stream_jobs.interval_join_stream(left, right, "user_id", "ts", "ts", -2 * 3600, 3600, "1 hour")
    out = j.select(F.col("l.event_id").alias("l_event_id"), F.col("r.event_id").alias("r_event_id"),
                   F.col("l.user_id").alias("user_id"), F.col("l.ts").cast("timestamp_ntz").alias("l_ts"),
                   F.col("r.ts").cast("timestamp_ntz").alias("r_ts"))
    return _run_stream(spark, out, "interval-join-out")
