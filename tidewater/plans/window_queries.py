"""Window operators over ``events``.

The reference's seconds become hours here: ``events`` has about one row per
4 minutes, so 5 s -> 5 h, 10 s -> 10 h (SURVEY 2.13).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.timecols import as_event_time, as_ntz
from tidewater.operators import folds, keyed, scan, windows
from tidewater.plans.arrival import run_stream, until_end
from tidewater.plans.registry import query, table

SUM = "cast(sum(cast(value as decimal(18,2))) as double)"
B5 = "time_bucket(interval '5 hours', ts, timestamp '1970-01-01')"


def value_sum(col: str = "value", out: str = "value_sum"):
    return F.sum(keyed.exact(col)).cast("double").alias(out)


def n_rows(out: str = "n"):
    return F.count(F.lit(1)).alias(out)


@query("tumbling_sum", f"""
select {B5} as window_start, {B5} + interval '5 hours' as window_end, event_type,
       {SUM} as value_sum, count(*) as n
from events group by all
""")
def tumbling_sum(spark, sf):
    ev = table(spark, sf, "events")
    return windows.tumbling(ev, "ts", "5 hours", "event_type", [value_sum(), n_rows()])


@query("sliding_sum", f"""
select {B5} - k * interval '5 hours' as window_start,
       {B5} - k * interval '5 hours' + interval '10 hours' as window_end,
       event_type, {SUM} as value_sum, count(*) as n
from events cross join (values (0), (1)) as t(k) group by all
""")
def sliding_sum(spark, sf):
    ev = table(spark, sf, "events")
    return windows.sliding(ev, "ts", "10 hours", "5 hours", "event_type", [value_sum(), n_rows()])


@query("session_sum", f"""
with a as (
  select user_id, ts, value, event_id,
         lag(ts) over (partition by user_id order by ts, event_id) as p from events),
b as (
  select *, sum(case when p is null or ts > p + interval '10 hours' then 1 else 0 end)
            over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as sid
  from a)
select user_id, min(ts) as session_start, max(ts) + interval '10 hours' as session_end,
       {SUM} as value_sum, count(*) as n
from b group by user_id, sid
""")
def session_sum(spark, sf):
    ev = table(spark, sf, "events")
    out = windows.session_merged(ev, "ts", 10 * 3600, "user_id",
                                 {"value_sum": ("sum", keyed.exact("value")), "n": ("count", None)},
                                 block_size=scan.plan_blocks(ev, "ts"))
    return out.withColumn("value_sum", F.col("value_sum").cast("double"))


@query("count_tumbling", """
with r as (select user_id, event_id, value,
                  row_number() over (partition by user_id order by event_id) as rn from events)
select user_id, cast((rn - 1) // 5 as bigint) as window_no,
       cast(sum(cast(value as decimal(18,2))) as double) as value_sum,
       min(event_id) as first_event_id, max(event_id) as last_event_id
from r group by user_id, (rn - 1) // 5 having count(*) = 5
""")
def count_tumbling(spark, sf):
    ev = table(spark, sf, "events")
    return windows.count_tumbling(ev, "user_id", "event_id", 5, [
        value_sum(), F.min("event_id").alias("first_event_id"), F.max("event_id").alias("last_event_id")],
        block_size=scan.plan_blocks(ev, "event_id"))


@query("count_sliding", """
with r as (select user_id, event_id, value,
                  row_number() over (partition by user_id order by event_id) as rn from events),
s as (select user_id, rn,
             cast(sum(cast(value as decimal(18,2))) over (partition by user_id order by rn
                  rows between 4 preceding and current row) as double) as value_sum from r)
select user_id, rn as fire_at, value_sum from s where rn % 3 = 0
""")
def count_sliding(spark, sf):
    ev = table(spark, sf, "events")
    res = windows.count_sliding(ev, "user_id", "event_id", 5, 3, keyed.exact("value"), "value_sum",
                                block_size=scan.plan_blocks(ev, "event_id"))
    return res.withColumn("value_sum", F.col("value_sum").cast("double"))


@query("event_time_tumbling", f"""
select {B5} as window_start, {B5} + interval '5 hours' as window_end, user_id, {SUM} as value_sum
from events group by all
""")
def event_time_tumbling(spark, sf):
    ev = as_event_time(table(spark, sf, "events"), "ts").withWatermark("ts", "3 hours")
    res = windows.tumbling(ev, "ts", "5 hours", "user_id", [value_sum()])
    return as_ntz(res, "window_start", "window_end")


@query("window_contents", f"""
with b as (select {B5} as ws, user_id, ts, event_id from events)
select ws as window_start, ws + interval '5 hours' as window_end, user_id, count(*) as n,
       'key:' || user_id || ',窗口开始结束:[' || strftime(ws, '%H:%M:%S') || '~'
       || strftime(ws + interval '5 hours', '%H:%M:%S') || '),属于该窗口的事件时间:['
       || string_agg(strftime(ts, '%H:%M:%S'), ', ' order by ts, event_id) || ']' as contents
from b group by ws, user_id
""")
def window_contents(spark, sf):
    ev = table(spark, sf, "events")
    return windows.window_contents(ev, "ts", "5 hours", "user_id", "event_id")


def _path(batches):
    """Rows, first and last id and the sum of steps (cents) of a window's values, read batch by batch."""
    n, first, last, before, path = 0, None, None, None, 0
    for batch in batches:
        for event_id, cents in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            n, first, last = n + 1, event_id if first is None else first, event_id
            path += 0 if before is None else abs(cents - before)
            before = cents
    yield n, first, last, path


@query("window_function", """
with b as (select time_bucket(interval '10 days', ts, timestamp '1970-01-01') as ws, event_type, ts, event_id,
                  cast(cast(value as decimal(18,2)) * 100 as bigint) as cents from events),
s as (select *, abs(cents - lag(cents) over (partition by ws, event_type order by ts, event_id)) as step from b)
select event_type, ws as window_start, ws + interval '10 days' as window_end, count(*) as n,
       arg_min(event_id, (ts, event_id)) as first_id, arg_max(event_id, (ts, event_id)) as last_id,
       cast(coalesce(sum(step), 0) as bigint) as path
from s group by ws, event_type
""")
def window_function(spark, sf):
    """A user's window function over whole windows in order (G6): ten days of an event type come as an
    iterator of batches of at most 256 rows, several of them in every window."""
    ev = table(spark, sf, "events").withColumn("cents", (keyed.exact("value") * 100).cast("long"))
    return folds.apply_window(ev, "ts", "10 days", ["event_type"], ["ts", "event_id"], ["event_id", "cents"], _path,
                              "n long, first_id long, last_id long, path long", batch_rows=256)


@query("day_window_offset", f"""
select time_bucket(interval '1 day', ts, timestamp '2024-01-01 16:00:00') as window_start,
       time_bucket(interval '1 day', ts, timestamp '2024-01-01 16:00:00') + interval '1 day' as window_end,
       event_type, {SUM} as value_sum
from events group by all
""")
def day_window_offset(spark, sf):
    ev = table(spark, sf, "events")
    return windows.tumbling(ev, "ts", "1 day", "event_type", [value_sum()], offset="16 hours")


DAY_TO_DATE_SQL = """
with b as (
  select event_type as c,
         time_bucket(interval '1 day', ts, timestamp '2024-01-01 16:00:00') as d,
         time_bucket(interval '1 hour', ts, timestamp '1970-01-01') + interval '1 hour' as h,
         cast(value as decimal(18,2)) as v
  from events),
hourly as (select d, h, c, sum(v) as s from b group by d, h, c),
ticks as (select d, unnest(generate_series(min(h), max(h), interval '1 hour')) as t from hourly group by d),
firsts as (select d, c, min(h) as fh from hourly group by d, c),
grid as (select ticks.d, ticks.t, firsts.c from ticks join firsts on ticks.d = firsts.d and firsts.fh <= ticks.t)
select grid.d as day_start, grid.t as tick, grid.c as category,
       cast(sum(hourly.s) as double) as total
from grid join hourly on hourly.d = grid.d and hourly.c = grid.c and hourly.h <= grid.t
group by grid.d, grid.t, grid.c
"""


def day_to_date(spark, sf):
    ev = table(spark, sf, "events")
    return windows.day_to_date_by_tick(ev, "ts", "event_type", keyed.exact("value"))


@query("day_to_date_by_tick", DAY_TO_DATE_SQL)
def day_to_date_by_tick(spark, sf):
    return day_to_date(spark, sf)


@query("sql_tumble_stats", f"""
select user_id, {B5} as window_start, {B5} + interval '5 hours' as window_end,
       count(*) as n, max(value) as max_value, min(value) as min_value
from events group by all
""")
def sql_tumble_stats(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("tw_events")
    return spark.sql("""
        select user_id, window.start as window_start, window.end as window_end,
               count(*) as n, max(value) as max_value, min(value) as min_value
        from tw_events group by user_id, window(ts, '5 hours')""")


@query("dsl_tumble_stats", f"""
select user_id, {B5} as window_start, {B5} + interval '5 hours' as window_end,
       count(*) as n, max(value) as max_value, min(value) as min_value
from events group by all
""")
def dsl_tumble_stats(spark, sf):
    ev = table(spark, sf, "events")
    return windows.tumbling(ev, "ts", "5 hours", "user_id", [
        n_rows(), F.max("value").alias("max_value"), F.min("value").alias("min_value")])


@query("stream_sessions", f"""
with a as (
  select user_id, ts, value, event_id,
         lag(ts) over (partition by user_id order by ts, event_id) as p from events),
b as (
  select *, sum(case when p is null or ts > p + interval '10 hours' then 1 else 0 end)
            over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as sid
  from a),
s as (
  select user_id, min(ts) as session_start, max(ts) + interval '10 hours' as session_end,
         {SUM} as value_sum, count(*) as n
  from b group by user_id, sid)
select * from s
""")
def stream_sessions(spark, sf):
    """Structured Streaming session windows (W3 in a stream): watermark 1 h,
    ``session_window`` 10 h, append mode. A session comes out once the watermark passes
    its end; the row that ends the input closes those still open."""
    ev = as_event_time(table(spark, sf, "events"), "ts").select("event_id", "ts", "user_id", "value")
    out = run_stream(
        spark, ev, "event_id",
        lambda s: windows.session_stream(until_end(s.withWatermark("ts", "1 hour"), "ts"), "ts", "10 hours", "user_id",
                                         [value_sum(), n_rows()]), "sessions", ends="ts")
    return as_ntz(out, "session_start", "session_end")
