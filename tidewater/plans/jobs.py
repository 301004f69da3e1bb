"""End-to-end jobs (M2, M3) and the scalar-function suite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import records
from tidewater.functions.text import java_split
from tidewater.functions.timecols import micros_of, seconds
from tidewater.operators import keyed, scan
from tidewater.plans.io_queries import events_topic
from tidewater.plans.registry import query, table

# ---------------------------------------------------------------- M2: order timeout review
REVIEW_INTERVAL_DAYS = 30
REVIEW_AS_OF = "2001-06-01 00:00:00"


def timeout_review(orders: DataFrame, user: str, order: str, created: str, reviewed: str,
                   interval_seconds: int, as_of: str | None = None) -> DataFrame:
    """Auto positive review (M2) as a batch computation.

    Each order registers a timer at ``created + interval``. When any timer of a
    user fires, all of that user's pending orders are checked: reviewed ones
    are cleared (``already_reviewed``), unreviewed ones past their interval get
    ``auto_good``. So an unreviewed order acts at its own timer, and a reviewed
    one at the user's first timer firing at or after its creation. That "next
    timer" is a running min over the user's timers in reverse time order,
    computed with the blocked scan, whose blocks are planned from the timers' times
    (no user is gathered in one task).
    Output: user_id, order_id, action, action_time (only actions up to ``as_of``).
    """
    iv = seconds(interval_seconds)
    base = orders.select(F.col(user).alias("user_id"), F.col(order).alias("order_id"),
                         F.col(created).alias("created"), F.col(reviewed).alias("reviewed"))
    # each order yields its timer row (kind 0) and its own row (kind 1), from one read
    fire = F.col("created") + iv
    both = base.select("user_id", "order_id", "reviewed", F.explode(F.array(
        F.struct(fire.alias("t"), F.lit(0).alias("kind"), fire.alias("fire")),
        F.struct(F.col("created").alias("t"), F.lit(1).alias("kind"), F.lit(None).cast(
            base.schema["created"].dataType).alias("fire")))).alias("_e")) \
        .select("user_id", "order_id", "reviewed", "_e.*").withColumn("_rev", -micros_of("t"))
    nxt = scan.running(both, ["user_id"], ["_rev", "kind"], F.col("fire"), how="min", out="first_fire",
                       block_size=scan.plan_blocks(both, "_rev"))
    res = nxt.where(F.col("kind") == 1).select(
        "user_id", "order_id",
        F.when(F.col("reviewed"), F.lit("already_reviewed")).otherwise(F.lit("auto_good")).alias("action"),
        F.when(F.col("reviewed"), F.col("first_fire")).otherwise(F.col("t") + iv).alias("action_time"))
    if as_of is not None:
        res = res.where(F.col("action_time") <= F.lit(as_of).cast(res.schema["action_time"].dataType))
    return res


@query("order_timeout_review", f"""
with o as (select o_custkey as user_id, o_orderkey as order_id, o_orderdate as created,
                  o_orderkey % 2 = 0 as reviewed from orders),
t as (select user_id, created + interval '{REVIEW_INTERVAL_DAYS} days' as fire from o),
n as (select o.*, (select min(t.fire) from t where t.user_id = o.user_id and t.fire >= o.created) as first_fire
      from o),
a as (select user_id, order_id,
             case when reviewed then 'already_reviewed' else 'auto_good' end as action,
             case when reviewed then first_fire else created + interval '{REVIEW_INTERVAL_DAYS} days' end
               as action_time
      from n)
select * from a where action_time <= timestamp '{REVIEW_AS_OF}'
""")
def order_timeout_review(spark, sf):
    """``orders``; "reviewed" stands in for the review service: even order keys."""
    o = table(spark, sf, "orders").withColumn("reviewed", F.pmod("o_orderkey", F.lit(2)) == 0)
    return timeout_review(o, "o_custkey", "o_orderkey", "o_orderdate", "reviewed",
                          REVIEW_INTERVAL_DAYS * 86400, REVIEW_AS_OF)


# ---------------------------------------------------------------- M3: JSON filtering ETL
INPUT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
])
STATUS_KEPT = "purchase"


def json_filter_etl(frame: DataFrame, schema: T.StructType, status_col: str, keep: str,
                    out_cols: dict[str, str]) -> DataFrame:
    """JSON in -> filter -> JSON out (M3): decode, ``where status = keep``,
    re-encode selected columns. Works on batch frames and Kafka streams alike."""
    rows = records.decode_value(frame, schema).where(F.col(status_col) == F.lit(keep))
    out = rows.select(*[F.col(src).alias(dst) for dst, src in out_cols.items()])
    return out.select(records.row_json(out, sort_keys=False).alias("value"))


@query("etl_json_filter", f"""
select cast(json_object('user_id', user_id, 'page_id', event_id, 'status', event_type) as varchar) as value
from events where event_type = '{STATUS_KEPT}'
""")
def etl_json_filter(spark, sf):
    return json_filter_etl(events_topic(spark, sf), INPUT_SCHEMA, "event_type", STATUS_KEPT,
                           {"user_id": "user_id", "page_id": "event_id", "status": "event_type"})


# ---------------------------------------------------------------- scalar functions
@query("scalar_suite", r"""
select event_id,
       cast(len(string_split(rtrim(props, ' '), ' ')) as bigint) as n_words,
       event_type = 'click' as is_click,
       contains(props, '9') as has_9,
       event_type || ':' || cast(user_id as varchar) as tag,
       printf('%s-%d', event_type, user_id) as formatted,
       cast(regexp_extract(props, '(\d+)', 1) as integer) as k,
       cast(user_id as varchar) as user_text,
       array_to_string(string_split(rtrim(props, ' '), ' '), '|') as joined,
       strftime(ts, '%H:%M:%S') as hms,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp,
       cast(cast(value as decimal(18,2)) * 3 as double) as tripled,
       cast(round(cast(value as decimal(18,2)) * cast(0.5 as decimal(3,1)), 2) as double) as half_rounded,
       event_id % 5 as mod5,
       event_id % 2 = 0 as is_even,
       cast(json_extract(props, '$.k') as integer) as json_k
from events
""")
def scalar_suite(spark, sf):
    ev = table(spark, sf, "events")
    words = java_split("props")
    return ev.select(
        "event_id",
        F.size(words).cast("long").alias("n_words"),
        (F.col("event_type") == "click").alias("is_click"),
        F.col("props").contains("9").alias("has_9"),
        F.concat(F.col("event_type"), F.lit(":"), F.col("user_id").cast("string")).alias("tag"),
        F.format_string("%s-%d", "event_type", "user_id").alias("formatted"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
        F.col("user_id").cast("string").alias("user_text"),
        F.array_join(words, "|").alias("joined"),
        F.date_format("ts", "HH:mm:ss").alias("hms"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        (keyed.exact("value") * 3).cast("double").alias("tripled"),
        F.round(keyed.exact("value") * F.lit(0.5).cast("decimal(3,1)"), 2).cast("double").alias("half_rounded"),
        F.pmod("event_id", F.lit(5)).alias("mod5"),
        (F.pmod("event_id", F.lit(2)) == 0).alias("is_even"),
        F.from_json("props", "k int").k.alias("json_k"))
