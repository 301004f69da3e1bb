"""Keyed aggregates over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import folds, keyed, partitioning, scan, windows
from tidewater.plans.registry import query, table

DEC = "cast({} as decimal(18,2))"


@query("running_sum", """
select event_id, event_type, value,
       cast(sum(cast(value as decimal(18,2))) over (partition by event_type order by event_id
            rows between unbounded preceding and current row) as double) as running_value
from events
""")
def running_sum(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    return keyed.running_sum(ev, "event_type", "event_id", "value", out="running_value", exact_scale=2,
                             block_size=scan.plan_blocks(ev, "event_id"))


@query("running_max", """
select event_id, event_type, value,
       max(value) over (partition by event_type order by event_id
            rows between unbounded preceding and current row) as max_so_far
from events
""")
def running_max(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    return keyed.running_max(ev, "event_type", "event_id", "value", out="max_so_far",
                             block_size=scan.plan_blocks(ev, "event_id"))


@query("max_by_row", """
select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id order by value desc, event_id) as rn from events
) where rn = 1
""")
def max_by_row(spark, sf):
    return keyed.max_by_row(table(spark, sf, "events"), "user_id", "value", "event_id")


@query("sql_group_sum", """
select event_type, cast(sum(cast(value as decimal(18,2))) as double) as total
from events group by event_type
""")
def sql_group_sum(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("tw_events")
    return spark.sql("""
        select event_type, cast(sum(cast(value as decimal(18,2))) as double) as total
        from tw_events group by event_type""")


@query("having_equals", """
select user_id, count(*) as frequency from events group by user_id having count(*) = 60
""")
def having_equals(spark, sf):
    ev = table(spark, sf, "events")
    return (ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("frequency"))
            .filter(F.col("frequency") == 60))


@query("custom_aggregate", """
select event_type, cast(sum(cast(value as decimal(18,2))) as double) as total
from events group by event_type
""")
def custom_aggregate(spark, sf):
    ev = table(spark, sf, "events")
    return keyed.aggregate(ev, "event_type", keyed.price_sum_accumulator("value", 2), "total")


@query("window_sum_carry_first", """
select time_bucket(interval '5 hours', ts, timestamp '1970-01-01') as window_start,
       time_bucket(interval '5 hours', ts, timestamp '1970-01-01') + interval '5 hours' as window_end,
       user_id,
       cast(sum(cast(value as decimal(18,2))) as double) as value_sum,
       min_by(event_id, event_id) as event_id,
       min_by(event_type, event_id) as event_type
from events group by all
""")
def window_sum_carry_first(spark, sf):
    ev = table(spark, sf, "events").withColumn("value", keyed.exact("value"))
    g = keyed.sum_carry_first(ev, [F.window("ts", "5 hours").alias("window"), "user_id"], "value",
                              "event_id", ["event_id", "event_type"], "value_sum")
    return windows.flatten_window(g)


@query("partition_skew_report", """
select 'before' as phase, count(*) as n, null::boolean as even from events where value > 10
union all
select 'after', count(*), true from events where value > 10
""")
def partition_skew_report(spark, sf):
    """Rows of the tasks after a selective filter, and after a rebalance of what it left: no two
    tasks may then differ by more than one row for each task that sends. How the filter's
    own tasks differ depends on the files, so ``even`` is null before."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = table(spark, sf, "events").where(F.col("value") > 10).select("value")
    phases = [keyed.partition_counts(kept).withColumn("sent", F.lit(True)),
              keyed.partition_counts(partitioning.rebalance(kept, n)).withColumn("sent", F.lit(False))]
    sent, got = F.when(F.col("sent"), F.col("n")), F.when(~F.col("sent"), F.col("n"))
    least = F.when(F.count(got) < n, 0).otherwise(F.min(got))
    facts = phases[0].unionByName(phases[1]).agg(
        F.sum(sent).alias("before"), F.sum(got).alias("after"), (F.max(got) - least <= F.count(sent)).alias("even"))
    return facts.select(F.inline(F.array(
        F.struct(F.lit("before").alias("phase"), F.col("before").alias("n"), F.lit(None).cast("boolean").alias("even")),
        F.struct(F.lit("after").alias("phase"), F.col("after").alias("n"), F.col("even").alias("even")))))


def _streak_add(acc, row):
    """(rows, streak at the start, at the end, longest) with one row more."""
    one = (1, 1, 1, 1) if row[0] else (1, 0, 0, 0)
    return one if acc is None else _streak_merge(acc, one)


def _streak_merge(a, b):
    return (a[0] + b[0], a[1] + b[1] if a[1] == a[0] else a[1], b[2] + a[2] if b[2] == b[0] else b[2], max(a[3], b[3], a[2] + b[1]))


@query("ordered_fold", """
with r as (select event_type, event_id, value > 50 as hit, row_number() over (partition by event_type order by event_id) as n from events),
g as (select *, n - row_number() over (partition by event_type, hit order by event_id) as island from r),
s as (select event_type, island, count(*) as len from g where hit group by event_type, island)
select r.event_type, count(*) as n, coalesce((select max(len) from s where s.event_type = r.event_type), 0) as longest
from r group by r.event_type
""")
def ordered_fold(spark, sf):
    """A fold that no aggregate expresses and that depends on the order: the longest run of values above 50
    of an event type. Five hot keys, each folded in many tasks and merged in order."""
    ev = table(spark, sf, "events").select("event_type", "event_id", (F.col("value") > 50).alias("hit"))
    return folds.ordered_fold(ev, "event_type", ["event_id"], ["hit"], _streak_add, _streak_merge, lambda a: (a[0], a[3]),
                              "n long, head long, tail long, best long", "n long, longest long")
