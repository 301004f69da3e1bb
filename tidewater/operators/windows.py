"""Window operators: time (tumbling, sliding, session, day-with-offset) and count windows.

Time windows group on ``(window, key)`` so a hot key is split by its windows;
Spark aggregates them map-side first. Session and count windows need order
within a key and use the blocked scan instead of one window task per key.
Processing-time windows of the reference are event-time windows over an
ingestion-time column here (Spark SQL windows are event time only).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import formats
from tidewater.functions.timecols import bucket_end, bucket_start, seconds
from tidewater.operators import scan


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def flatten_window(df: DataFrame, col: str = "window") -> DataFrame:
    """``window`` struct -> ``window_start``, ``window_end`` (first two columns)."""
    rest = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").alias("window_start"),
                     F.col(f"{col}.end").alias("window_end"), *rest)


def tumbling(df: DataFrame, ts: str, size: str, keys, aggs: Sequence[Column],
             offset: str | None = None) -> DataFrame:
    """Tumbling window aggregate (W1, W6, W10, W11). ``offset`` shifts the grid,
    e.g. ``"16 hours"`` gives days that start at 00:00 UTC+8 (W8)."""
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    return flatten_window(df.groupBy(w.alias("window"), *_keys(keys)).agg(*aggs))


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys, aggs: Sequence[Column]) -> DataFrame:
    """Sliding window aggregate (W2): each row lands in size/slide windows."""
    return flatten_window(df.groupBy(F.window(ts, size, slide).alias("window"), *_keys(keys)).agg(*aggs))


def session(df: DataFrame, ts: str, gap_seconds: int, keys, aggs: Sequence[Column],
            seq: str | None = None, block_size: int | scan.Blocks = 24 * scan.HOUR_MICROS) -> DataFrame:
    """Session windows per key (W3): a row more than ``gap`` after the previous
    row of its key opens a new session; rows exactly ``gap`` apart merge.

    Output: keys, ``session_start`` (first ts), ``session_end`` (last ts + gap)
    and ``aggs``. Built from two blocked scans so one busy key never sits in a
    single task (``session_window`` would cluster each key into one task);
    :func:`session_merged` needs one shuffle of the rows where the aggregates merge.
    For streams use :func:`session_stream`.
    """
    keys = _keys(keys)
    order = [ts] + ([seq] if seq else [])
    gap = seconds(gap_seconds)
    prev = scan.running(df, keys, order, F.col(ts), how="max", out="_prev",
                        inclusive=False, block_size=block_size)
    starts = prev.withColumn(
        "_new", F.when(F.col("_prev").isNull() | (F.col(ts) > F.col("_prev") + gap), 1).otherwise(0))
    sid = scan.running(starts, keys, order, F.col("_new"), how="sum", out="_sid", block_size=block_size)
    res = (sid.groupBy(*keys, "_sid")
           .agg(F.min(ts).alias("session_start"), (F.max(ts) + gap).alias("session_end"), *aggs))
    return res.drop("_sid")


def session_merged(df: DataFrame, ts: str, gap_seconds: int, keys, parts: Mapping[str, tuple[str, Column | str | None]],
                   block_size: int | scan.Blocks = 24 * scan.HOUR_MICROS) -> DataFrame:
    """Session windows as :func:`session`, in one shuffle of the rows, for aggregates that merge.

    ``parts`` maps an output name to ``(how, column)`` with ``how`` one of sum, count, max, min.
    Every (key, block of time) is cut into sessions and aggregated in place. A session that is
    neither the first nor the last of its block is whole; the two at the edges, a few rows for
    each block, are merged with those of the neighbouring blocks. Rows of a null time are in
    no session.
    """
    keys, gap = _keys(keys), seconds(gap_seconds)
    merge = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
    values = [F.lit(1).cast("long") if how == "count" else F.col(c) if isinstance(c, str) else c
              for how, c in parts.values()]
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("_t"), scan.block_of(df, ts, block_size).alias("_blk"),
        *[v.alias(f"_v{i}") for i, v in enumerate(values)])
    aggs = [merge[how](f"_v{i}").alias(f"_v{i}") for i, (how, _) in enumerate(parts.values())]

    def opens(time: str, before: str, w) -> Column:
        prev = F.lag(before).over(w)
        return F.when(prev.isNull() | (F.col(time) > prev + gap), 1).otherwise(0)

    in_block = Window.partitionBy(*keys, "_blk")
    by_time = in_block.orderBy("_t")
    local = (rows.withColumn("_new", opens("_t", "_t", by_time))
             .withColumn("_no", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*keys, "_blk", "_no").agg(F.min("_t").alias("_from"), F.max("_t").alias("_to"), *aggs)
             .withColumn("_edge", (F.col("_no") == 1) | F.lead("_no").over(in_block.orderBy("_no")).isNull()))
    by_block = Window.partitionBy(*keys).orderBy("_blk", "_no")
    joined = (local.where("_edge").withColumn("_new", opens("_from", "_to", by_block))
              .withColumn("_sid", F.sum("_new").over(by_block.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*keys, "_sid").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), *aggs))
    return local.where(~F.col("_edge")).drop("_blk", "_no", "_edge").unionByName(joined.drop("_sid")).select(
        *keys, F.col("_from").alias("session_start"), (F.col("_to") + gap).alias("session_end"),
        *[F.col(f"_v{i}").alias(name) for i, name in enumerate(parts)])


def session_stream(df: DataFrame, ts: str, gap: str, keys, aggs: Sequence[Column]) -> DataFrame:
    """Streaming session windows: Spark's ``session_window`` (append mode only)."""
    sw = F.session_window(ts, gap).alias("session")
    out = df.groupBy(sw, *_keys(keys)).agg(*aggs)
    rest = [c for c in out.columns if c != "session"]
    return out.select(F.col("session.start").alias("session_start"),
                      F.col("session.end").alias("session_end"), *rest)


def count_tumbling(df: DataFrame, keys, seq: str, size: int, aggs: Sequence[Column],
                   block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """``countWindow(size)``: consecutive groups of ``size`` rows per key in
    arrival order; an incomplete tail never fires (W4)."""
    keys = _keys(keys)
    rn = scan.row_number(df, keys, [seq], out="_rn", block_size=block_size)
    grouped = (rn.withColumn("window_no", F.floor((F.col("_rn") - 1) / size).cast("long"))
               .groupBy(*keys, "window_no")
               .agg(F.count(F.lit(1)).alias("_n"), *aggs))
    return grouped.where(F.col("_n") == size).drop("_n")


def count_sliding(df: DataFrame, keys, seq: str, size: int, slide: int, value: Column,
                  out: str, block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """``countWindow(size, slide)``: on every ``slide``-th row of a key, aggregate
    the last *up to* ``size`` rows (W5).

    Each row is sent to the (at most ceil(size/slide)) firings that include it,
    then a plain keyed ``groupBy`` sums them: no frame spans tasks.
    Output: keys, ``fire_at`` (row number of the firing row), ``out``.
    """
    keys = _keys(keys)
    rn = scan.row_number(df, keys, [seq], out="_rn", block_size=block_size)
    first = (F.ceil(F.col("_rn") / slide) * slide).cast("long")
    last = F.col("_rn") + (size - 1)
    fires = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long"))) \
             .otherwise(F.array().cast("array<long>"))
    exploded = rn.select(*keys, "_rn", value.alias("_val"), F.explode(fires).alias("fire_at"))
    agg = (exploded.groupBy(*keys, "fire_at")
           .agg(F.sum("_val").alias(out), F.max("_rn").alias("_last")))
    # the firing row itself must exist
    return agg.where(F.col("_last") == F.col("fire_at")).drop("_last")


def window_contents(df: DataFrame, ts: str, size: str, key: str, seq: str,
                    time_fmt: str = formats.TIME_FORMAT) -> DataFrame:
    """``window.apply``: whole window contents per key and window.

    ``contents`` follows the reference's printout
    (:data:`tidewater.functions.formats.WINDOW_CONTENTS_FORMAT`) with the
    times sorted by (ts, seq) so the list is deterministic.
    """
    items = F.sort_array(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"))))
    g = flatten_window(df.groupBy(F.window(ts, size).alias("window"), key)
                       .agg(items.alias("_items")))
    times = F.transform("_items", lambda x: F.date_format(x["t"], time_fmt))
    as_list = F.concat(F.lit("["), F.array_join(times, ", "), F.lit("]"))  # Java List.toString
    text = F.format_string(formats.WINDOW_CONTENTS_FORMAT, F.col(key).cast("string"),
                           F.date_format("window_start", time_fmt), F.date_format("window_end", time_fmt),
                           as_list)
    return g.select("window_start", "window_end", key, F.size("_items").cast("long").alias("n"),
                    text.alias("contents"))


def day_to_date_by_tick(df: DataFrame, ts: str, category: str, value: Column,
                        day_offset_seconds: int = 16 * 3600, tick_seconds: int = 3600) -> DataFrame:
    """Day-to-date total per category at every tick (W8 with a continuous trigger).

    The reference fires every tick for every category already seen that day,
    even without new rows. Ticks of a day run from its first to its last tick
    with data. One scan: rows are aggregated to (day, tick, category); then, on
    that small table only, a running total per (day, category), the next tick
    with data (``lead``) and the day's last tick give the span each total holds
    for, and ``explode(sequence(...))`` fills the ticks in between.
    Output: ``day_start``, ``tick`` (tick end), ``category``, ``total`` (double).
    """
    per_tick = (df.groupBy(bucket_start(ts, 86400, day_offset_seconds).alias("day_start"),
                           bucket_end(ts, tick_seconds).alias("tick"),
                           F.col(category).alias("category"))
                .agg(F.sum(value).alias("_s")))
    step = seconds(tick_seconds)
    by_cat = Window.partitionBy("day_start", "category").orderBy("tick")
    spans = per_tick.select(
        "day_start", "category", "tick",
        F.sum("_s").over(by_cat.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_total"),
        F.lead("tick").over(by_cat).alias("_next"),
        F.max("tick").over(Window.partitionBy("day_start")).alias("_last"))
    until = F.coalesce(F.col("_next") - step, F.col("_last"))
    return spans.select("day_start", F.explode(F.sequence("tick", until, step)).alias("tick"),
                        "category", F.col("_total").cast("double").alias("total"))
