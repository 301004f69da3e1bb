"""Changelog and lateness queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import changelog, keyed, lateness, routing, scan
from tidewater.plans.arrival import run_stream
from tidewater.plans.registry import query, table
from tidewater.streaming import late_windows

HAVING_COUNT = 60

_RUNNING_COUNT = """
with r as (select event_id, user_id,
                  count(*) over (partition by user_id order by event_id
                                 rows between unbounded preceding and current row) as c
           from events),
ch as (
  select event_id, 0 as change_seq, false as flag, user_id, c - 1 as cnt from r where c > 1
  union all
  select event_id, 1 as change_seq, true as flag, user_id, c as cnt from r)
"""


def user_count_changes(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id")
    return changelog.count_changelog(ev, "user_id", "event_id", out="cnt", block_size=scan.plan_blocks(ev, "event_id"))


@query("changelog_group_sum", _RUNNING_COUNT + "select * from ch")
def changelog_group_sum(spark, sf):
    return user_count_changes(spark, sf)


@query("changelog_having", _RUNNING_COUNT + f"select * from ch where cnt = {HAVING_COUNT}")
def changelog_having(spark, sf):
    return changelog.having_changelog(user_count_changes(spark, sf), F.col("cnt") == HAVING_COUNT)


@query("changelog_distinct", """
select true as flag, user_id, event_type, min(event_id) as event_id from (
  select user_id, event_type, event_id from events where value > 50
  union all
  select user_id, event_type, event_id from events where value > 20
) group by user_id, event_type
""")
def changelog_distinct(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    both = routing.union_filtered(ev, F.col("value") > 50, F.col("value") > 20).drop("value")
    return changelog.distinct_changelog(both, ["user_id", "event_type"], "event_id")


# Disorder fixture: event time = ts - ((event_id * 7919) % 20) * 6 minutes (FIXTURES 4).
WINDOW_S, DELAY_S, LATENESS_S = 3600, 1800, 1800

JITTER_SQL = """
with j as (
  select event_id, user_id, value,
         ts - to_minutes(cast(((event_id * 7919) % 20) * 6 as bigint)) as event_time
  from events),
m as (
  select *, max(event_time) over (order by event_id rows between unbounded preceding and current row) as mx,
         time_bucket(interval '1 hour', event_time, timestamp '1970-01-01') as window_start
  from j),
c as (
  select *, window_start + interval '1 hour' as window_end,
         case when mx - interval '30 minutes' < window_start + interval '1 hour' then 'on_time'
              when mx - interval '30 minutes' < window_start + interval '90 minutes' then 'late'
              else 'too_late' end as lateness
  from m)
"""


def jittered_events(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    shift = F.make_dt_interval(F.lit(0), F.lit(0), ((F.col("event_id") * 7919) % 20 * 6).cast("int"))
    return ev.withColumn("event_time", F.col("ts") - shift).drop("ts")


def classified(spark, sf, blocks=None):
    ev = jittered_events(spark, sf)
    return lateness.classify(ev, "event_id", "event_time", WINDOW_S, DELAY_S, LATENESS_S,
                             block_size=blocks or scan.plan_blocks(ev, "event_id"))


@query("watermark_audit", """
with j as (
  select event_id, user_id,
         ts - to_minutes(cast(((event_id * 7919) % 20) * 6 as bigint)) as event_time
  from events)
select event_id, user_id, event_time,
       max(event_time) over (order by event_id rows between unbounded preceding and current row)
         - interval '30 minutes' - interval '1 millisecond' as watermark
from j
""")
def watermark_audit(spark, sf):
    ev = jittered_events(spark, sf).drop("value")
    return lateness.with_watermark_audit(ev, "event_id", "event_time", DELAY_S,
                                         block_size=scan.plan_blocks(ev, "event_id"))


@query("late_side_output", JITTER_SQL + """
select event_id, user_id, event_time, value from c where lateness = 'too_late'
""")
def late_side_output(spark, sf):
    side = lateness.late_split(classified(spark, sf))[lateness.TOO_LATE]
    return side.select("event_id", "user_id", "event_time", "value")


_LATE_REFIRE_SQL = JITTER_SQL + """,
ontime as (
  select user_id, window_start, window_end, sum(cast(value as decimal(18,2))) as s
  from c where lateness = 'on_time' group by all),
late as (
  select user_id, window_start, window_end, event_id,
         row_number() over (partition by user_id, window_start order by event_id) as fire_no,
         sum(cast(value as decimal(18,2))) over (partition by user_id, window_start order by event_id
             rows between unbounded preceding and current row) as cs
  from c where lateness = 'late')
select user_id, window_start, window_end, cast(0 as bigint) as fire_no, cast(null as bigint) as trigger_id,
       cast(s as double) as value_sum from ontime
union all
select l.user_id, l.window_start, l.window_end, l.fire_no, l.event_id as trigger_id,
       cast(coalesce(o.s, 0) + l.cs as double) as value_sum
from late l left join ontime o on l.user_id = o.user_id and l.window_start = o.window_start
"""


@query("late_refire", _LATE_REFIRE_SQL)
def late_refire(spark, sf):
    blocks = scan.plan_blocks(table(spark, sf, "events"), "event_id")
    rows = classified(spark, sf, blocks).withColumn("value", keyed.exact("value"))
    return lateness.refire(rows, ["user_id"], "event_id", "value", block_size=blocks)


#: Arrival slices of the late-row streams.
LATE_SLICES = 6


def _late_stream(spark, sf, name: str):
    """The disorder fixture through :class:`LateWindows`, to the end of the input: the tagged output."""
    rows = jittered_events(spark, sf).withColumn("value", keyed.exact("value")).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return run_stream(spark, rows, "event_id",
                      lambda s: late_windows.late_windows(s, ["user_id"], "event_id", "event_time", "value", WINDOW_S, DELAY_S, LATENESS_S),
                      name, min_slices=LATE_SLICES, ends="event_time")


@query("stream_late_refire", _LATE_REFIRE_SQL)
def stream_late_refire(spark, sf):
    """Allowed lateness in a stream: firings and re-firings from keyed state and timers. The
    watermark moves with every row, so the result is the batch query's, however the rows are sliced."""
    return late_windows.firings(_late_stream(spark, sf, "late-windows"), ["user_id"], WINDOW_S)


@query("stream_late_side_output", JITTER_SQL + """
select event_id, user_id, event_time, value from c where lateness = 'too_late'
""")
def stream_late_side_output(spark, sf):
    """Rows too late for any window, from the side output of the same operator."""
    side = late_windows.side_output(_late_stream(spark, sf, "late-side"), ["user_id"], "event_id", "event_time", "value")
    return side.select("event_id", "user_id", "event_time", F.col("value").cast("double").alias("value"))


@query("lateness_classes", JITTER_SQL + """
select lateness, count(*) as n from c group by lateness
""")
def lateness_classes(spark, sf):
    """Class sizes of the disorder fixture (on time / late / too late)."""
    return classified(spark, sf).groupBy("lateness").agg(F.count(F.lit(1)).alias("n"))
