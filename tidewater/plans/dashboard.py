"""Sales dashboard (M1): day-to-date totals per category at every tick, the
tick's grand total and its top-3 categories (W8 + W9 + T1).

Category = ``event_type``, price = ``value``, tick = 1 hour, days start at
00:00 UTC+8 (window offset 16 h).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import formats
from tidewater.operators import keyed, ranking, windows
from tidewater.plans.arrival import run_stream
from tidewater.plans.registry import query, table
from tidewater.streaming import dashboard_stream
from tidewater.plans.window_queries import DAY_TO_DATE_SQL

TOP_K = 3


def category_totals(ev: DataFrame) -> DataFrame:
    """(day_start, tick, category, total) for every tick of every category seen that day."""
    return windows.day_to_date_by_tick(ev, "ts", "event_type", keyed.exact("value"))


def top3(totals: DataFrame) -> DataFrame:
    return ranking.top_k(totals, "tick", [F.col("total").desc(), F.col("category")], TOP_K)


def grand_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("day_start", "tick").agg(
        ranking.round_half_up(F.sum(F.col("total").cast("decimal(18,2)"))).cast("double").alias("grand_total"),
        F.count(F.lit(1)).alias("n_categories"))


_TOTALS = "with dd as (" + DAY_TO_DATE_SQL + ")"

_TOP_SQL = _TOTALS + """,
ranked as (select day_start, tick, category, total,
                  row_number() over (partition by tick order by total desc, category) as rank from dd)
"""

_GRAND_SQL = _TOTALS + """,
gt as (select day_start, tick,
              cast(round(sum(cast(total as decimal(18,2))), 2) as double) as grand_total,
              count(*) as n_categories
       from dd group by day_start, tick)
"""


@query("topk_per_tick", _TOP_SQL + "select * from ranked where rank <= 3")
def topk_per_tick(spark, sf):
    return top3(category_totals(table(spark, sf, "events")))


@query("grand_total_per_tick", _GRAND_SQL + "select * from gt")
def grand_total_per_tick(spark, sf):
    return grand_totals(category_totals(table(spark, sf, "events")))


@query("dashboard_totals", _GRAND_SQL + """
select tick, grand_total,
       '时间: ' || strftime(tick, '%Y-%m-%d %H:%M:%S') || ' 总金额 :' || cast(grand_total as varchar) as line
from gt
""")
def dashboard_totals(spark, sf):
    g = grand_totals(category_totals(table(spark, sf, "events")))
    line = F.format_string(formats.DASHBOARD_TOTAL_FORMAT, F.date_format("tick", formats.DATETIME_FORMAT),
                           F.col("grand_total").cast("string"))
    return g.select("tick", "grand_total", line.alias("line"))


@query("dashboard_top3", _TOP_SQL + """
select tick, 'top3: ' || chr(10) || string_agg('分类:' || category || ' 金额:' || cast(total as varchar), chr(10) order by rank) as top3
from ranked where rank <= 3 group by tick
""")
def dashboard_top3(spark, sf):
    t = top3(category_totals(table(spark, sf, "events")))
    text = F.format_string(formats.DASHBOARD_TOP_FORMAT, F.col("category"), F.col("total").cast("string"))
    told = ranking.ranked_text(t, "tick", "rank", text, "top3")
    return told.withColumn("top3", F.concat(F.lit(formats.DASHBOARD_TOP_HEADER), "top3"))


def _live(spark, sf, name: str, summary: bool) -> DataFrame:
    """The chained operators over ``events`` as they arrive, to the end of the input."""
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", keyed.exact("value").alias("value"))

    def make(stream):
        totals = dashboard_stream.day_totals(stream, "ts", "event_type", "value")
        return dashboard_stream.tick_summary(totals, TOP_K) if summary else totals
    out = run_stream(spark, ev, "event_id", make, name, ends="ts")
    times = {c: F.timestamp_millis(c).cast("timestamp_ntz") for c in ("day", "tick")}
    return out.withColumns(times).withColumnRenamed("day", "day_start")


@query("stream_dashboard", DAY_TO_DATE_SQL)
def stream_dashboard(spark, sf):
    """The live dashboard: day-to-date totals of every category at every hourly tick of every day, as the
    batch grid has them, from windowed sums feeding keyed state."""
    out = _live(spark, sf, "dashboard", summary=False)
    return out.select("day_start", "tick", "category", F.col("total").cast("double").alias("total"))


@query("stream_dashboard_summary", _GRAND_SQL + """,
r as (select day_start, tick, category, total,
             row_number() over (partition by tick order by total desc, category) as rank from dd)
select day_start, tick, cast(rank as integer) as rank, category, total from r where rank <= 3
union all
select day_start, tick, cast(0 as integer), null, grand_total from gt
""")
def stream_dashboard_summary(spark, sf):
    """Top-3 categories (ranks 1 to 3) and grand total (rank 0) of every tick, from a third
    stateful operator behind the day totals."""
    return _live(spark, sf, "dashboard-summary", summary=True).select("day_start", "tick", "rank", "category", "total")
