"""Joins: window join, interval join, broadcast and lookup enrichment.

Interval joins are turned into equi-joins on ``(key, time bucket)`` plus a
range filter, so a busy key is split by time instead of pairing all its rows
in one task. No side is hinted for broadcast: Spark picks by its own statistics, and
adaptive execution again by the sizes it has measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import formats
from tidewater.functions.timecols import MICROS, bucket_start, micros_of, seconds

MISSING_NAME = formats.MISSING_NAME  # fallback name of a failed lookup


def window_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, left_ts: str,
                right_ts: str, size_seconds: int) -> DataFrame:
    """Inner join of rows sharing the key *and* the tumbling window.

    Adds ``window_start``/``window_end`` and joins on ``(key..., window_start)``.
    Returns the joined frame; callers select the output (``JoinFunction``).
    """
    on = [on] if isinstance(on, str) else list(on)
    lw = left.withColumn("window_start", bucket_start(left_ts, size_seconds))
    rw = right.withColumn("window_start", bucket_start(right_ts, size_seconds))
    joined = lw.alias("l").join(rw.alias("r"), [*on, "window_start"], "inner")
    return joined.withColumn(
        "window_end", F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                 F.lit(size_seconds)))


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, left_ts: str,
                  right_ts: str, lower_seconds: int, upper_seconds: int) -> DataFrame:
    """``left.intervalJoin(right).between(lower, upper)`` (J2): pairs with equal
    keys and ``l.ts + lower <= r.ts <= l.ts + upper`` (bounds inclusive).

    Left rows sit in one bucket of width ``upper - lower``; each right row is
    copied to the (at most two) left buckets it can match. The equi-join on
    ``(key, bucket)`` keeps every task bounded by a time slice of one key.
    Columns are reachable as ``l.*`` and ``r.*``.
    """
    on = [on] if isinstance(on, str) else list(on)
    width = max(upper_seconds - lower_seconds, 1) * MICROS
    lo, hi = lower_seconds * MICROS, upper_seconds * MICROS
    lb = left.withColumn("_bucket", F.floor(micros_of(left_ts) / F.lit(width)).cast("long"))
    rm = micros_of(right_ts)
    first = F.floor((rm - F.lit(hi)) / F.lit(width)).cast("long")
    last = F.floor((rm - F.lit(lo)) / F.lit(width)).cast("long")
    rb = right.withColumn("_bucket", F.explode(F.sequence(first, last)))
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on] + [F.col("l._bucket") == F.col("r._bucket")]
    # range on the time columns themselves, so a stream-stream join can derive
    # state eviction from the watermarks of both sides
    lt, rt = F.col(f"l.{left_ts}"), F.col(f"r.{right_ts}")
    cond += [rt >= lt + seconds(lower_seconds), rt <= lt + seconds(upper_seconds)]
    return lb.alias("l").join(rb.alias("r"), cond, "inner")


def enrich(facts: DataFrame, dim: DataFrame, on: Sequence[str] | str | Column, how: str = "inner") -> DataFrame:
    """Broadcast-state enrichment (J3): each fact row joined to the current dim.

    ``how="inner"`` drops unknown keys (the reference cannot look them up);
    ``"left"`` keeps them with nulls.
    """
    return facts.join(dim, on, how)


def lookup_enrich(facts: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str,
                  out: str, on_missing: str = "default", default: str = MISSING_NAME) -> DataFrame:
    """Async lookup enrichment as a join (J4): every fact row is kept; a missing
    id gets ``default`` (client A's timeout value) or null (client B)."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(name).alias("_lname"))
    joined = facts.join(d, F.col(key) == F.col("_lk"), "left")
    value = F.coalesce(F.col("_lname"), F.lit(default)) if on_missing == "default" else F.col("_lname")
    return joined.withColumn(out, value).drop("_lk", "_lname")
