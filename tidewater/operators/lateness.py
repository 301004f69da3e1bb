"""Watermarks, allowed lateness and the late-row side output.

Rule (the deterministic form of a bounded-out-of-orderness watermark): with
``m`` the running maximum event time in arrival order and ``we`` the end of
the row's window,

* ``m - delay <  we``                 -> on time (window not fired yet)
* ``we <= m - delay < we + lateness`` -> late: accepted, the window re-fires
* ``m - delay >= we + lateness``      -> too late: side output

``m`` is one global running max (the watermark is per source, not per key);
it is computed with the blocked scan, so no task sees more than one block.
Spark's own ``withWatermark`` drops late rows silently and one batch late, so
the classification is ours, for batch and (via ``foreachBatch``) streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timecols import bucket_start, seconds
from tidewater.operators import scan

ON_TIME, LATE, TOO_LATE = "on_time", "late", "too_late"


def with_watermark_audit(df: DataFrame, seq: str, event_time: str, delay_seconds: int,
                         out: str = "watermark", block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """Per row, the watermark after it arrives: ``max event time so far - delay - 1 ms``."""
    m = scan.running(df, [], [seq], F.col(event_time), how="max", out="_max", block_size=block_size)
    wm = F.col("_max") - seconds(delay_seconds) - F.expr("INTERVAL '0.001' SECOND")
    return m.withColumn(out, wm).drop("_max")


def classify(df: DataFrame, seq: str, event_time: str, window_seconds: int, delay_seconds: int,
             lateness_seconds: int, out: str = "lateness", prior_max=None,
             block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """Add ``window_start``, ``window_end`` and the lateness class ``out``.

    ``prior_max`` carries the running max of earlier micro-batches in.
    """
    m = scan.running(df, [], [seq], F.col(event_time), how="max", out="_max", block_size=block_size)
    if prior_max is not None:
        m = m.withColumn("_max", F.greatest(F.col("_max"), F.lit(prior_max).cast(df.schema[event_time].dataType)))
    ws = bucket_start(event_time, window_seconds)
    we = ws + seconds(window_seconds)
    mark = F.col("_max") - seconds(delay_seconds)
    cls = (F.when(mark < F.col("window_end"), F.lit(ON_TIME))
           .when(mark < F.col("window_end") + seconds(lateness_seconds), F.lit(LATE))
           .otherwise(F.lit(TOO_LATE)))
    return (m.withColumn("window_start", ws).withColumn("window_end", we)
            .withColumn(out, cls).drop("_max"))


def late_split(classified: DataFrame, col: str = "lateness") -> dict[str, DataFrame]:
    """``{"on_time", "late", "too_late"}`` views of one classified frame."""
    return {c: classified.where(F.col(col) == F.lit(c)) for c in (ON_TIME, LATE, TOO_LATE)}


def refire(classified: DataFrame, keys: Sequence[str], seq: str, value: str, out: str = "value_sum",
           col: str = "lateness", block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """Window results with allowed lateness.

    One row per on-time firing (``fire_no`` 0: sum of on-time rows), then one
    re-firing per accepted late row (``fire_no`` 1, 2, ...) carrying the
    updated window sum and the id of the row that triggered it. A window whose
    rows were all late first fires on its first late row.

    All on-time rows of a window arrive before its late ones (the watermark
    only grows), so one running sum over the accepted rows, per (key, window)
    in arrival order, is the re-firing value at a late row and the on-time
    total at the window's last on-time row: a single scan, one pass of input. Values are
    summed as they are: give decimals for sums exact to the cent.
    """
    keys = list(keys)
    wkeys = [*keys, "window_start", "window_end"]
    is_late = F.col(col) == LATE
    accepted = classified.where(F.col(col) != TOO_LATE).withColumn("_v", F.col(value))
    run = scan.running_many(accepted, [*keys, "window_start"], [seq],
                            [("_v", "sum", "_cum"), (F.when(is_late, 1).otherwise(0), "sum", "_late_no")],
                            block_size=block_size)
    # one aggregate, one pass over the scan output: each late row is its own group
    # (its re-firing); a window's on-time rows form one group whose value is the
    # running sum at its last on-time row (max_by combines map-side).
    trigger = F.when(is_late, F.col(seq)).cast("long")
    out_rows = (run.groupBy(*wkeys, trigger.alias("trigger_id"))
                .agg(F.max_by(F.col("_cum"), F.col(seq)).alias("_val"), F.max("_late_no").alias("_n")))
    return out_rows.select(*wkeys, F.col("_n").cast("long").alias("fire_no"), "trigger_id",
                           F.col("_val").cast("double").alias(out))
