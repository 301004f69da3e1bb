"""Keyed tumbling event-time sums with allowed lateness and a late side output.

The watermark moves with every row: the newest event time among all rows up to it, less the delay.
:func:`tidewater.streaming.processors.running_over_all` puts it beside each row. Then one
``transformWithState`` keeps the open windows. A window

* fires when the watermark passes its end, with the sum of its rows so far (``fire_no`` 0);
* fires again for each row that comes after that, with the updated sum (``fire_no`` 1, 2, ...),
  until the watermark is ``lateness`` past its end, when its state goes;
* sends rows that come later still to the side output, as they are, and rows without event time with them.

What the rows themselves don't close is closed by event-time timers: Spark's watermark follows the rows' own, a
micro-batch behind, so it never passes a window that can still take rows in time.

``withWatermark`` alone would drop late rows before the processor sees them: Spark filters
rows whose *event-time column* lies behind the watermark. The rows go in with their event
time as a plain number, so nothing is filtered and the watermark still drives the timers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidewater.functions.timecols import MICROS
from tidewater.streaming import processors
from tidewater.streaming.processors import arrow_schema, as_table, pack, packed_by, sum_type, tuples, type_of, unpack, unpacked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIRE, SIDE = "fire", "late_side"
#: A row of this event time or later tells the end of a bounded input: it only moves the watermark.
END_OF_INPUT = "9000-01-01"


#: Buckets of windows, by keys and window end: the windows of a bucket share one state value and one visit a batch.
BUCKETS = 512


class LateWindows(StatefulProcessor):
    """The open windows of a bucket: keys, end, sum, rows on time, late rows, fired already.

    Input: the rows of a micro-batch, packed: sequence number, event time and watermark in microseconds, window end in
    milliseconds, value and keys. They are taken in the order of the sequence. Output, packed: ``tag, keys...,
    window_end_ms, fire_no, trigger, total`` for firings and ``seq, value, at`` (event time in microseconds) for the
    side output; the other part is null. Null values add nothing.

    State: the windows that neither the rows nor Spark's watermark have left ``lateness`` behind, one value,
    with one timer at the time the next of them is due.
    """

    def __init__(self, lateness_ms: int, windows: pa.Schema, out: pa.Schema):
        self.lateness, self.windows, self.out = lateness_ms, windows, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "due bigint, windows binary")

    def _load(self) -> tuple[int | None, dict[tuple, list]]:
        known = self.open.get()
        return (None, {}) if known is None else (known[0], {(*k, end): w for end, *w, k in _windows(unpack(known[1]))})

    def _store(self, due: int | None, windows: dict[tuple, list]) -> None:
        if not windows:
            return self.open.clear()
        # a timer fires once the watermark is past it; a window's last millisecond is ``end - 1``
        soonest = min((at[-1] if w[1] and not w[3] else at[-1] + self.lateness) - 1 for at, w in windows.items())
        if due is None or soonest < due:
            self.handle.registerTimer(soonest)
            due = soonest
        self.open.update((due, pack(as_table([(at[-1], *w, *at[:-1]) for at, w in windows.items()], self.windows))))

    def _fire(self, at: tuple, w: list, trigger: int | None = None) -> tuple:
        return FIRE, *at, w[2] if trigger is not None else 0, trigger, w[0], None, None, None

    def _settle(self, windows: dict[tuple, list], mark: int) -> Iterator[tuple]:
        """Fire and drop what the watermark ``mark`` (milliseconds) has passed."""
        for at in [at for at in windows if at[-1] <= mark]:
            w = windows[at]
            if w[1] and not w[3]:
                yield self._fire(at, w)
                w[3] = True
            if at[-1] + self.lateness <= mark:
                del windows[at]

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        due, windows = self._load()
        out, clock = [], timerValues.getCurrentWatermarkInMs()
        for seq, at, mark, end, v, *k in sorted((r for p in rows for r in tuples(unpack(p["_rows"]))), key=lambda r: (r[0] is not None, r[0])):
            if end is None or (end + self.lateness) * 1000 <= mark:
                out.append((SIDE, *k, end, None, None, None, seq, v, at))
                continue
            clock = max(clock, mark // 1000)
            w = windows.setdefault((*k, end), [None, 0, 0, False])
            late = end * 1000 <= mark
            if late and w[1] and not w[3]:
                out.append(self._fire((*k, end), w))
                w[3] = True
            w[0] = v if w[0] is None else w[0] if v is None else w[0] + v
            if late:
                w[2] += 1
                out.append(self._fire((*k, end), w, seq))
            else:
                w[1] += 1
        out += self._settle(windows, clock)  # rows to come have a watermark no older
        self._store(due, windows)
        if out:
            yield Row(_rows=pack(as_table(out, self.out)))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        due, windows = self._load()
        if due is None or due > expiredTimerInfo.getExpiryTimeInMs():
            return  # served by another timer of this batch
        out = list(self._settle(windows, timerValues.getCurrentWatermarkInMs()))
        self._store(None, windows)
        if out:
            yield Row(_rows=pack(as_table(out, self.out)))

    def close(self) -> None:
        pass


def _windows(table: pa.Table) -> Iterator[tuple]:
    """``end, total, n_on, n_late, fired, keys`` of the windows in the state."""
    for end, total, n_on, n_late, fired, *keys in tuples(table):
        yield end, total, n_on, n_late, fired, keys


def late_windows(stream: DataFrame, keys: Sequence[str], seq: str, event_time: str, value: str, window_seconds: int,
                 delay_seconds: int, lateness_seconds: int, buckets: int = BUCKETS) -> DataFrame:
    """The tagged output of :class:`LateWindows` over ``stream`` (output mode ``append``).

    ``event_time`` is a ``timestamp``. Sums have the input's type, decimals the widest: give
    decimals for sums exact to the cent. A row at :data:`END_OF_INPUT` closes all windows.
    """
    size, at = window_seconds * MICROS, F.col(event_time)
    named = [f"_k{i}" for i in range(len(keys))]
    # The filter names the event time, so Spark can't move it below the watermark: the row that ends the input counts there.
    rows = (stream.withWatermark(event_time, f"{delay_seconds} seconds").where(at.isNull() | (at < F.lit(END_OF_INPUT).cast("timestamp")))
            .select(F.col(seq).cast("long").alias("_s"), F.unix_micros(at).alias("_at"), F.col(value).alias("_v"),
                    *(F.col(k).alias(n) for k, n in zip(keys, named, strict=True))))
    marked = processors.running_over_all(rows, "_s", "_at", "max", "_newest", ["_v", *named])
    rows = marked.select("_s", "_at", (F.col("_newest") - delay_seconds * MICROS).alias("_mark"),
                         ((F.col("_at") - F.pmod("_at", F.lit(size)) + size) / F.lit(1000)).cast("long").alias("_end"), "_v", *named)
    v, total = type_of(stream, value), sum_type(type_of(stream, value))
    key_types = [type_of(stream, k) for k in keys]
    windows = ", ".join([f"end bigint, total {total}, n_on bigint, n_late bigint, fired boolean", *(f"{n} {t}" for n, t in zip(named, key_types, strict=True))])
    schema = ("tag string, " + ", ".join(f"{k} {t}" for k, t in zip(keys, key_types, strict=True))
              + f", window_end_ms bigint, fire_no bigint, trigger bigint, total {total}, seq bigint, value {v}, at bigint")
    out = packed_by(rows, buckets, [*named, "_end"]).groupBy("_bucket").transformWithState(
        LateWindows(lateness_seconds * 1000, arrow_schema(windows), arrow_schema(schema)), "_rows binary", "Append", "EventTime")
    return unpacked(out, schema)


def firings(out: DataFrame, keys: Sequence[str], window_seconds: int) -> DataFrame:
    """``keys, window_start, window_end, fire_no, trigger_id, value_sum`` of all firings."""
    end = F.timestamp_millis("window_end_ms")
    start = F.timestamp_millis(F.col("window_end_ms") - window_seconds * 1000)
    return out.where(F.col("tag") == FIRE).select(
        *keys, start.cast("timestamp_ntz").alias("window_start"), end.cast("timestamp_ntz").alias("window_end"), "fire_no",
        F.col("trigger").alias("trigger_id"), F.col("total").cast("double").alias("value_sum"))


def side_output(out: DataFrame, keys: Sequence[str], seq: str, event_time: str, value: str) -> DataFrame:
    """Rows that came too late for their window, under their own names."""
    return out.where(F.col("tag") == SIDE).select(
        *keys, F.col("seq").alias(seq), F.timestamp_micros("at").cast("timestamp_ntz").alias(event_time), F.col("value").alias(value))
