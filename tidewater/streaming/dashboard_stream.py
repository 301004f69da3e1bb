"""Live sales dashboard (M1 in a stream: W8 + E11 + W9 + T1) as chained stateful operators.

1. Sums per (category, tick) in Spark's own windowed aggregation: append mode gives each once, when
   the watermark passes the tick. However many sales a day has, what follows sees a row for
   each tick and category.
2. ``DayTotals``, keyed by day: day-to-date totals of all categories seen that day, told at every tick,
   also those in which nothing was sold. Its state goes when the watermark passes the day's end.
3. ``TickSummary``, keyed by (day, tick): the top categories and the grand total, rounded half-up.

All state, timers and offsets are in the query's checkpoint. The clock is event time; for
wall-clock ticks give rows their ingestion time (``jobs.with_ingestion_time``).
"""

from __future__ import annotations

import decimal
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidewater.functions.timecols import bucket_start
from tidewater.streaming.late_windows import END_OF_INPUT
from tidewater.streaming.processors import sum_type, type_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_K = 3
DAY_MS = 86_400_000


class DayTotals(StatefulProcessor):
    """Input rows: ``day, tick`` (end, both in ms)``, category, s``. All rows of a tick come in one batch, since the
    watermark closes them together. Output: ``day, tick, category, total`` for every category so far, at each tick
    from the day's first to its last with sales."""

    def __init__(self, tick_ms: int, total_type: str):
        self.tick, self.total_type = tick_ms, total_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", f"tick bigint, totals array<struct<category:string,total:{self.total_type}>>")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        known = self.day.get()
        last, totals = (None, {}) if known is None else (known[0], {c: t for c, t in known[1]})
        if known is None:
            self.handle.registerTimer(key[0] + DAY_MS)
        for r in sorted(rows, key=lambda r: r["tick"]):
            if last is not None:
                for tick in range(last, r["tick"], self.tick):
                    yield from self._tell(key[0], tick, totals)
            last, s, old = r["tick"], r["s"], totals.get(r["category"])
            totals[r["category"]] = s if old is None else old if s is None else old + s
        yield from self._tell(key[0], last, totals)
        # this tick has been told; what the next batch tells begins after it
        self.day.update((last + self.tick, list(totals.items())))

    @staticmethod
    def _tell(day: int, tick: int, totals: dict) -> Iterator[Row]:
        return (Row(day=day, tick=tick, category=c, total=t) for c, t in totals.items())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.day.clear()
        return iter([])

    def close(self) -> None:
        pass


class TickSummary(StatefulProcessor):
    """The categories of one tick, all in one batch. Output: ``day, tick, rank, category, total``; rank 0 is the
    grand total (its category is null), ranks from 1 the ``k`` largest, ties by category."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        told = sorted(((r["category"], r["total"]) for r in rows if r["total"] is not None), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
        grand = sum((decimal.Decimal(str(t)) for _, t in told), decimal.Decimal(0)).quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP)
        yield Row(day=key[0], tick=key[1], rank=0, category=None, total=float(grand))
        for rank, (category, total) in enumerate(told[:self.k], 1):
            yield Row(day=key[0], tick=key[1], rank=rank, category=category, total=float(total))

    def close(self) -> None:
        pass


def day_totals(stream: DataFrame, ts: str, category: str, price: str, delay: str = "1 hour", day_offset_seconds: int = 16 * 3600,
               tick_seconds: int = 3600) -> DataFrame:
    """``day, tick`` (ms)``, category, total`` at every tick, from a stream with a ``timestamp`` column ``ts``.
    Sums have the widest type of ``price``: give decimals for totals exact to the cent."""
    rows = stream.withWatermark(ts, delay).where(F.col(ts) < F.lit(END_OF_INPUT).cast("timestamp"))
    sums = (rows.groupBy(F.window(ts, f"{tick_seconds} seconds").alias("w"), F.col(category).cast("string").alias("category"))
            .agg(F.sum(price).alias("s")))
    kind = sum_type(type_of(stream, price))
    ticks = sums.select(F.unix_millis(bucket_start(F.col("w.start"), 86400, day_offset_seconds, ntz=False)).alias("day"),
                        F.unix_millis("w.end").alias("tick"), "category", F.col("s").cast(kind).alias("s"))
    return ticks.groupBy("day").transformWithState(DayTotals(tick_seconds * 1000, kind), f"day bigint, tick bigint, category string, total {kind}",
                                                   "Append", "EventTime")


def tick_summary(totals: DataFrame, k: int = TOP_K) -> DataFrame:
    """Second operator over :func:`day_totals`: top ``k`` and grand total of each tick."""
    return totals.groupBy("day", "tick").transformWithState(
        TickSummary(k), "day bigint, tick bigint, rank int, category string, total double", "Append", "None")
