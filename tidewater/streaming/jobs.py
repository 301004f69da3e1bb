"""Streaming forms of the jobs (M1, M4, M7, M8) and of the stateless operators.

The batch operators that are plain projections, filters, unions, static
joins and time-window aggregates run unchanged on streaming frames; these
helpers add what a stream needs on top (watermarks, output modes, sinks).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import java_split, pair_text
from tidewater.operators import joins, windows


def word_counts_stream(lines: DataFrame, col: str = "value") -> DataFrame:
    """Running word count (A2 in update mode): one row per changed word per batch."""
    words = lines.select(F.explode(java_split(col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_lines(counts: DataFrame, sep: str = ":::") -> DataFrame:
    """``word:::count`` records (P10) for the output topic or files."""
    return counts.select("word", "n", pair_text("word", "n", sep).alias("line"))


def windowed_sum_stream(events: DataFrame, ts: str, size: str, delay: str, keys, value: str,
                        slide: str | None = None, keep: Callable[[DataFrame], DataFrame] = lambda w: w) -> DataFrame:
    """Event-time tumbling/sliding sums with a watermark (W1, W2, W6); append mode
    emits each window once the watermark passes its end. ``keep`` filters the rows the
    watermark has seen."""
    wm = keep(events.withWatermark(ts, delay))
    agg = [F.sum(value).cast("double").alias("value_sum")]
    if slide:
        return windows.sliding(wm, ts, size, slide, keys, agg)
    return windows.tumbling(wm, ts, size, keys, agg)


def day_totals_stream(sales: DataFrame, ts: str, category: str, price: str, delay: str = "1 hour") -> DataFrame:
    """Day window with the UTC+8 offset, updated every trigger (W8 + E11):
    run with ``outputMode("update")`` and ``trigger(processingTime="1 second")``."""
    wm = sales.withWatermark(ts, delay)
    day = F.window(ts, "1 day", "1 day", "16 hours")
    return windows.flatten_window(
        wm.groupBy(day.alias("window"), category)
        .agg(F.sum(price).cast("double").alias("total")))


def enrich_each_batch(load_dim: Callable[[SparkSession], DataFrame], on, how: str,
                      sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Broadcast-state enrichment for streams (J3, E9): the dimension is read
    afresh inside every micro-batch (a static side of a stream join is listed
    only once), size-checked, and joined; ``sink`` writes the result."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        dim = load_dim(batch.sparkSession)
        sink(joins.enrich(batch, dim, on, how), batch_id)
    return handle


def with_ingestion_time(df: DataFrame, out: str = "ingest_ts", delay: str = "0 seconds") -> DataFrame:
    """Wall-clock timestamps with a zero-delay watermark (E3): the reference's
    processing-time windows and joins, expressed as event time over arrival time."""
    return df.withColumn(out, F.current_timestamp()).withWatermark(out, delay)


def window_join_stream(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                       size_seconds: int, delay: str) -> DataFrame:
    """Stream-stream window join (J1): watermark both sides, join on
    ``(key, window_start)``; the redundant ``|l.ts - r.ts| < size`` bound lets
    Spark evict join state once the watermark passes."""
    from tidewater.functions.timecols import seconds
    j = joins.window_join(left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay),
                          on, left_ts, right_ts, size_seconds)
    lt, rt = F.col(f"l.{left_ts}"), F.col(f"r.{right_ts}")
    return j.where((rt > lt - seconds(size_seconds)) & (rt < lt + seconds(size_seconds)))


def interval_join_stream(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                         lower_seconds: int, upper_seconds: int, delay: str) -> DataFrame:
    """Stream-stream interval join (J2), state bounded by both watermarks."""
    return joins.interval_join(left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay),
                               on, left_ts, right_ts, lower_seconds, upper_seconds)


def union_distinct_stream(*streams: DataFrame, ts: str, delay: str, keys=None) -> DataFrame:
    """SQL ``UNION`` on streams (U2) with bounded state.

    Whole rows (event time included) are de-duplicated: copies of one event
    reaching the union through several inputs are always within the delay of
    each other, so this is exact for them and the state is evicted by the
    watermark. ``keys`` de-duplicates on a subset instead (a repeat after the
    delay then passes again); a global distinct needs unbounded state
    (``dropDuplicates`` without a watermark)."""
    from tidewater.operators.routing import union_all
    merged = union_all(*[s.withWatermark(ts, delay) for s in streams])
    return merged.dropDuplicatesWithinWatermark(list(keys) if keys else merged.columns)


class RowWriter:
    """``RichSinkFunction`` (open / invoke / close) for ``writeStream.foreach``.

    ``open_fn(partition_id, epoch_id)`` returns a connection-like object,
    ``invoke_fn(conn, row)`` writes one row, ``close_fn(conn, error)`` releases it.
    Prefer ``foreachBatch`` with a bulk writer; this is for clients without one.
    """

    def __init__(self, open_fn, invoke_fn, close_fn=None):
        self.open_fn, self.invoke_fn, self.close_fn = open_fn, invoke_fn, close_fn
        self.conn = None

    def open(self, partition_id, epoch_id):
        self.conn = self.open_fn(partition_id, epoch_id)
        return True

    def process(self, row):
        self.invoke_fn(self.conn, row)

    def close(self, error):
        if self.close_fn is not None:
            self.close_fn(self.conn, error)
