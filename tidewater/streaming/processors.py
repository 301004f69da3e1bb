"""Keyed state and timers for streams (E6, E7, E10; A2, A5, C1, W4, W5, M2).

``transformWithState`` processors, one instance per key group. Rows of one
micro-batch reach a key in no fixed order; where order matters they are sorted by the
sequence column first. State lives in the session's state store (RocksDB
provider, set in :mod:`tidewater.session`) and is checkpointed with the query.
"""

from __future__ import annotations

import bisect
import itertools
import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import _parse_datatype_string

# Workers need no copy of this module: the processors travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _names(schema: str) -> tuple[str, ...]:
    """Column names of a schema text; commas inside a type's brackets do not part columns."""
    return tuple(f.strip().split(" ")[0] for f in re.split(r",(?![^(<]*[)>])", schema))


def _row(names: tuple[str, ...], *values) -> Row:
    return Row(**dict(zip(names, values, strict=True)))


def sum_type(value_type: str) -> str:
    """Type a running sum of ``value_type`` is kept in: decimals get the widest precision."""
    scale = re.fullmatch(r"decimal\(\d+,\s*(\d+)\)", value_type)
    if scale:
        return f"decimal(38,{scale[1]})"
    return "bigint" if value_type in ("tinyint", "smallint", "int", "bigint") else "double"


def type_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


#: Values of the sequence column in one block: a key's rows of a micro-batch are dealt to tasks by block.
BLOCK = 1 << 18
#: Buckets of keys. A call to the state costs far more than a row, so the keys of a bucket share one state value, one
#: visit a batch and one packed row in and out. Fixed for the life of a checkpoint.
BUCKETS = 128


def bucket(n: int, *cols: Column | str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def pack(table: pa.Table) -> bytes:
    """Rows as one binary value (an Arrow stream)."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def tuples(table: pa.Table) -> Iterator[tuple]:
    return zip(*[c.to_pylist() for c in table.columns], strict=True)


def as_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(ddl))


def packed_by(df: DataFrame, buckets: int, by: Sequence[Column | str]) -> DataFrame:
    """``_bucket, _rows``: the rows of each bucket of a micro-batch, packed. ``by`` are the columns that deal them."""
    def one(key: tuple, table: pa.Table) -> pa.Table:
        rows = pack(table.drop_columns(["_bucket"]))
        return pa.table({"_bucket": pa.array([key[0].as_py()], pa.int64()), "_rows": pa.array([rows], pa.binary())})
    return df.withColumn("_bucket", bucket(buckets, *by)).groupBy("_bucket").applyInArrow(one, "_bucket bigint, _rows binary")


def unpacked(df: DataFrame, schema: str) -> DataFrame:
    """The rows packed in ``_rows``, of the columns ``schema``."""
    def rows(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield from unpack(data).cast(arrow).to_batches(max_chunksize=MAX_ROWS)
    arrow = arrow_schema(schema)
    return df.select("_rows").mapInArrow(rows, schema)


#: Rows in one Arrow batch of what was packed.
MAX_ROWS = 1 << 14


def _merge(how: str, a, b):
    """Two parts of an aggregate; null is neutral, as in the batch form."""
    if a is None or b is None:
        return b if a is None else a
    return max(a, b) if how == "max" else min(a, b) if how == "min" else a + b


def _nulls_first(v) -> tuple:
    return v is not None, v


class KeyCarry(StatefulProcessor):
    """The small second level: what each key of a bucket has before each of its blocks.

    Input: for every block of the batch one row with what each key has in it, packed: its number of rows, their aggregate
    and its last ``keep`` rows. Output: for each of these blocks the same over all rows before it. State: these for
    the bucket's keys so far, packed, read and written once a batch.
    """

    def __init__(self, how: str, keep: int, parts: pa.Schema):
        self.how, self.keep, self.parts = how, keep, parts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.before = handle.getValueState("before", "keys binary")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        known = self.before.get()
        before = {} if known is None else {k: (n, acc, tail) for k, n, acc, tail in tuples(unpack(known[0]))}
        for block, parts in sorted(((r["_block"], r["_carry"]) for r in rows), key=lambda r: _nulls_first(r[0])):
            carry = []
            for k, more, part, last in tuples(unpack(parts)):
                n, acc, tail = before.get(k, (0, None, []))
                carry.append((k, n, acc, tail))
                # rows of earlier batches come first, whatever their sequence numbers
                before[k] = n + more, _merge(self.how, acc, part), [*tail, *last][-self.keep:] if self.keep else []
            yield Row(_bucket=key[0], _block=block, _carry=pack(as_table(carry, self.parts)))
        self.before.update((pack(as_table([(k, *b) for k, b in before.items()], self.parts)),))

    def close(self) -> None:
        pass


def _two_level(df: DataFrame, key: str | None, seq: str, value: str | None, how: str, keep: int, block: int, fold, out: str,
               also: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``df`` through ``fold``, in the order of ``seq`` within a key (None: all rows), without a hot task.

    1. Rows meet by (block of the sequence, bucket of the key) and are added up by key.
    2. :class:`KeyCarry`, keyed state, turns these few parts into what each block begins with.
    3. Rows and carries meet by (block, bucket): ``fold(key, carry, rows)`` takes rows ``seq, value, *also`` and
       yields output tuples of the schema ``out``. A task holds the rows of one block and bucket at a time.
    """
    value_type = "bigint" if value is None else type_of(df, value)
    acc_type = {"count": "bigint", "sum": sum_type(value_type)}.get(how, value_type)
    base = df.select((F.lit(0) if key is None else F.col(key)).alias("_key"), F.floor(F.col(seq) / F.lit(block)).cast("long").alias("_block"),
                     F.col(seq).alias("_seq"), (F.lit(1).cast("long") if value is None else F.col(value)).alias("_value"), *also)
    base = base.withColumn("_bucket", bucket(buckets, "_key"))
    parts = (f"key {type_of(base, '_key')}, n bigint, acc {acc_type}, "
             f"tail array<struct<seq:{type_of(base, '_seq')},value:{value_type}>>")
    packed = "_bucket bigint, _block bigint, _carry binary"

    def in_order(table: pa.Table) -> pa.Table:
        return table.take(pc.sort_indices(table, [("_seq", "ascending")], null_placement="at_start"))

    def partial(at: tuple, table: pa.Table) -> pa.Table:
        found: dict = {}
        for k, s, v in tuples(in_order(table).select(["_key", "_seq", "_value"])):
            p = found.get(k)
            if p is None:
                p = found[k] = [0, None, []]
            p[0] += 1
            p[1] = _merge(how, p[1], v)
            if keep:
                p[2].append((s, v))
        rows = [(k, n, acc, [{"seq": s, "value": v} for s, v in tail[-keep:]] if keep else []) for k, (n, acc, tail) in found.items()]
        return as_table([(at[1].as_py(), at[0].as_py(), pack(as_table(rows, arrow_parts)))], arrow_packed)

    def finish(table: pa.Table) -> pa.Table:
        carries, groups = table.filter(pc.is_valid(table["_carry"])), {}
        for data in carries["_carry"].to_pylist():
            for k, n, acc, tail in tuples(unpack(data)):
                groups[k] = (n, acc, [(t["seq"], t["value"]) for t in tail]), []
        rows = in_order(table.filter(pc.is_null(table["_carry"])))
        for k, *row in tuples(rows.select(["_key", "_seq", "_value", *also])):
            groups[k][1].append(row)
        return as_table([r for k, (carry, mine) in groups.items() for r in fold(k, carry, mine)], arrow_out)
    arrow_parts, arrow_packed, arrow_out = (arrow_schema(x) for x in (parts, packed, out))
    sums = base.drop(*also).groupBy("_block", "_bucket").applyInArrow(partial, packed)
    carries = sums.groupBy("_bucket").transformWithState(KeyCarry(how, keep, arrow_parts), packed, "Append", "None")
    both = base.withColumn("_carry", F.lit(None).cast("binary")).unionByName(carries, allowMissingColumns=True)
    return both.groupBy("_block", "_bucket").applyInArrow(finish, out)


def running_stream(df: DataFrame, key: str, seq: str, value: str | None, how: str = "sum",
                   changelog: bool = False, block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """Per-record running ``sum``/``max``/``min``/``count`` of a key (A2, A5), or its retract changelog
    (C1): ``(false, old)`` then ``(true, new)`` per record; output mode ``append``.

    Null values change nothing. Types follow the input's: cast ``value`` to a decimal beforehand for sums exact to
    the cent. Output rows: ``key, seq, value, result``, or with ``changelog=True`` ``seq, change_seq, flag, key, result``.
    """
    value_type = "bigint" if value is None else type_of(df, value)
    result = {"count": "bigint", "sum": sum_type(value_type)}.get(how, value_type)
    k, s = f"{key} {type_of(df, key)}", f"{seq} {type_of(df, seq)}"

    def fold(at, carry, rows):
        cur = carry[1]
        for n, v in rows:
            old, cur = cur, _merge(how, cur, v)
            if not changelog:
                yield at, n, None if value is None else v, cur
                continue
            if old is not None:
                yield n, 0, False, at, old
            yield n, 1, True, at, cur
    out = f"{s}, change_seq int, flag boolean, {k}, result {result}" if changelog else f"{k}, {s}, value {value_type}, result {result}"
    return _two_level(df, key, seq, value, how, 0, block, fold, out, buckets=buckets)


def running_over_all(df: DataFrame, seq: str, value: str, how: str, out: str, also: Sequence[str] = (), block: int = BLOCK // 4) -> DataFrame:
    """The running aggregate over all rows of the stream: ``seq, value, out`` and the columns ``also``."""
    def fold(_, carry, rows):
        cur = carry[1]
        for n, v, *rest in rows:
            cur = _merge(how, cur, v)
            yield n, v, cur, *rest
    value_type = type_of(df, value)
    result = sum_type(value_type) if how == "sum" else value_type
    schema = ", ".join([f"{seq} {type_of(df, seq)}", f"{value} {value_type}", f"{out} {result}", *(f"{c} {type_of(df, c)}" for c in also)])
    return _two_level(df.select(seq, value, *also), None, seq, value, how, 0, block, fold, schema, also, buckets=1)


def count_window_stream(df: DataFrame, key: str, seq: str, value: str, size: int, slide: int | None = None,
                        block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """``countWindow(size)`` and ``countWindow(size, slide)`` per key.

    Tumbling (``slide is None``): a row for every full ``size`` rows. Sliding: on every ``slide``-th row the sum of
    the last up-to-``size`` rows. Null values count as rows and add nothing; a window of nulls alone sums to null.
    Output: ``key, fire_at`` (row number)``, value_sum``.
    """
    every = slide or size

    def fold(at, carry, rows):
        n, last = carry[0], [v for _, v in carry[2]]
        for _, v in rows:
            n += 1
            last = [*last, v][-size:]
            if n % every == 0:
                known = [x for x in last if x is not None]
                yield at, n, sum(known[1:], known[0]) if known else None
    out = f"{key} {type_of(df, key)}, fire_at bigint, value_sum {sum_type(type_of(df, value))}"
    return _two_level(df, key, seq, value, "sum", size - 1, block, fold, out, buckets=buckets)


#: Pending orders kept in one state value; a key with more keeps the rest in runs of this length.
RUN_ORDERS = 512
#: Buckets of users: their pending orders share one timer, one head and one visit a batch.
USER_BUCKETS = 1024


class OrderTimeout(StatefulProcessor):
    """Auto positive review (M2): every order has a deadline at ``created + interval``.

    At a deadline of a user, that user's reviewed orders placed by then are cleared
    (``already_reviewed``) and unreviewed ones whose deadline it is get ``auto_good``. The
    deadline of a cleared order still counts as one. In event-time mode the watermark is the clock.
    Output: ``user_id, order_id, action, action_ms`` (the deadline).

    A key is one user, or with ``user`` a bucket of users, whose rows name theirs in that column.
    State: one value with the next deadline, up to ``RUN_ORDERS`` pending orders, and an index of the runs;
    the runs are map state, each sorted by deadline. One timer stands at the next deadline, and
    what is due is served by whichever timer of a batch comes first. A run is read when
    its first deadline has come, or a reviewed order in it may be cleared: each order of a user
    is read a bounded number of times, however many the user has, and in a bucket once for each of its timers at most.
    """

    def __init__(self, order: str, created_ms: str, reviewed: str, interval_ms: int, order_type: str = "string", event_time: bool = True,
                 user: str | None = None, user_type: str = "string"):
        self.user, self.user_type = user, user_type
        self.order, self.created, self.reviewed, self.interval = order, created_ms, reviewed, interval_ms
        self.order_type, self.event_time = order_type, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # an order: (id, created, reviewed, cleared, user); a run: (number, first deadline, first reviewed order's creation)
        orders = f"array<struct<id:{self.order_type},created:bigint,reviewed:boolean,cleared:boolean,user:{self.user_type}>>"
        self.head = handle.getValueState("head", (
            f"due bigint, orders {orders}, runs array<struct<run:bigint,first:bigint,reviewed:bigint>>, next bigint"))
        self.runs = handle.getMapState("runs", "run bigint", f"orders {orders}")

    def _load(self) -> list:
        known = self.head.get()
        return [None, [], [], 0] if known is None else [known[0], [tuple(o) for o in known[1]], [tuple(r) for r in known[2]], known[3]]

    def _run(self, number: int, orders: list[tuple]) -> tuple:
        self.runs.updateValue((number,), (orders,))
        return number, orders[0][1] + self.interval, min((o[1] for o in orders if o[2] and not o[3]), default=None)

    def _store(self, head: list) -> None:
        due, orders, runs, number = head
        if len(orders) > RUN_ORDERS:
            orders.sort(key=lambda o: o[1])
            for lo in range(0, len(orders), RUN_ORDERS):
                runs.append(self._run(number, orders[lo:lo + RUN_ORDERS]))
                number += 1
            orders = []
        soonest = min([o[1] + self.interval for o in orders] + [r[1] for r in runs], default=None)
        if soonest is None:
            return self.head.clear()
        if due is None or soonest < due:
            self.handle.registerTimer(soonest)
            due = soonest
        self.head.update((due, orders, runs, number))

    def _now(self, timerValues: TimerValues) -> int:
        return timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        head, now = self._load(), self._now(timerValues)
        head[1] += [(r[self.order], r[self.created], bool(r[self.reviewed]), False, None if self.user is None else r[self.user]) for r in rows]
        if head[0] is not None and head[0] <= now:  # serve the timer of this batch here: one visit fewer
            self.handle.deleteTimer(head[0])
            yield from self._advance(key, head, now)
        self._store(head)

    def _serve(self, orders: list[tuple], times: dict, now: int) -> tuple[list[tuple], list[tuple]]:
        """(orders that stay, actions) at the users' deadlines ``times``, all of them up to ``now``."""
        stay, done = [], []
        for o in orders:
            order_id, created, reviewed, cleared, user = o
            deadline = created + self.interval
            if reviewed and not cleared:
                due = times.get(user, ())
                at = bisect.bisect_left(due, created)  # placed by then
                if at < len(due):
                    done.append((order_id, "already_reviewed", due[at], user))
                    o = (order_id, created, True, True, user)
            if deadline > now:
                stay.append(o)
            elif not reviewed:
                done.append((order_id, "auto_good", deadline, user))
        return stay, done

    def _advance(self, key, head: list, now: int) -> list[Row]:
        """Serve all deadlines up to ``now``; ``head`` then has no timer."""
        _, orders, runs, _ = head
        read = {r[0]: [tuple(o) for o in self.runs.getValue((r[0],))[0]] for r in runs if r[1] <= now}
        times: dict = {}
        for o in itertools.chain(orders, *read.values()):
            if o[1] + self.interval <= now:
                times.setdefault(o[4], []).append(o[1] + self.interval)
        for due in times.values():
            due.sort()
        newest = max((due[-1] for due in times.values()), default=None)
        head[1], done = self._serve(orders, times, now)
        kept = []
        for r in runs:
            if r[0] not in read and (r[2] is None or newest is None or r[2] > newest):
                kept.append(r)
                continue
            whole = read.get(r[0]) or [tuple(o) for o in self.runs.getValue((r[0],))[0]]
            stay, more = self._serve(whole, times, now)
            done += more
            if not more and len(stay) == len(whole):
                kept.append(r)
            elif stay:
                kept.append(self._run(r[0], stay))
            else:
                self.runs.removeKey((r[0],))
        head[0], head[2] = None, kept
        return [Row(user_id=key[0] if self.user is None else user, order_id=order_id, action=action, action_ms=at)
                for order_id, action, at, user in sorted(done, key=lambda d: d[2])]

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        head, expiry = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        if head[0] is None or head[0] > expiry:
            return  # served already
        yield from self._advance(key, head, max(expiry, self._now(timerValues)))
        self._store(head)

    def close(self) -> None:
        pass


class PackedOrderTimeout(OrderTimeout):
    """:class:`OrderTimeout` over buckets of users: packed rows in, packed actions out."""

    def __init__(self, out: pa.Schema, *args, **named):
        super().__init__(*args, **named)
        self.out = out

    def _packed(self, actions: Iterator[Row]) -> Iterator[Row]:
        done = [tuple(a) for a in actions]
        if done:
            yield Row(_rows=pack(as_table(done, self.out)))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        orders = (dict(zip(t.column_names, r, strict=True)) for t in (unpack(p["_rows"]) for p in rows) for r in tuples(t))
        yield from self._packed(super().handleInputRows(key, orders, timerValues))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        yield from self._packed(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))


def order_timeout_stream(df: DataFrame, user: str, order: str, created_ms: str, reviewed: str,
                         interval_ms: int, event_time: bool = True, buckets: int = USER_BUCKETS) -> DataFrame:
    """Event-time timers (input must carry ``withWatermark``), else processing time."""
    order_type, user_type = type_of(df, order), type_of(df, user)
    schema = f"user_id {user_type}, order_id {order_type}, action string, action_ms bigint"
    proc = PackedOrderTimeout(arrow_schema(schema), order, created_ms, reviewed, interval_ms, order_type, event_time, user, user_type)
    mode = "EventTime" if event_time else "ProcessingTime"
    rows = packed_by(df.select(user, order, created_ms, reviewed), buckets, [user])
    return unpacked(rows.groupBy("_bucket").transformWithState(proc, "_rows binary", "Append", mode), schema)
