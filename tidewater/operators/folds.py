"""User functions over ordered groups in bounded memory: window contents and folds.

Rows are sorted by key and order within a task and read as they come: a group is an iterator of
Arrow batches, never one value, and a group that is done leaves nothing behind.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_ROWS = 4096
#: Accumulators a task holds before it sends them on.
FLUSH_KEYS = 1 << 16
#: Partial accumulators of a key that one merge step takes at once.
FAN = 64


def runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches of ``batch`` with equal first ``n_keys`` columns."""
    ends = {batch.num_rows}
    for column in batch.columns[:n_keys]:
        ends.update(pc.run_end_encode(column).run_ends.to_pylist())
    at = 0
    for end in sorted(ends):
        if end > at:
            yield at, end
            at = end


def groups(batches: Iterator[pa.RecordBatch], n_keys: int, batch_rows: int = BATCH_ROWS) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """(key, its batches of at most ``batch_rows`` rows) from batches sorted by their first ``n_keys`` columns.
    The batches of a key must be read before the next key is asked for; what is left of them is skipped."""
    def pieces():
        for batch in batches:
            for lo, hi in runs(batch, n_keys):
                key = tuple(c[lo].as_py() for c in batch.columns[:n_keys])
                for a in range(lo, hi, batch_rows):
                    yield key, batch.slice(a, min(batch_rows, hi - a))
    source = pieces()
    ahead = next(source, None)

    def of(key):
        nonlocal ahead
        while ahead is not None and ahead[0] == key:
            piece = ahead[1]
            ahead = next(source, None)
            yield piece
    while ahead is not None:
        key = ahead[0]
        mine = of(key)
        yield key, mine
        for _ in mine:
            pass


def _send(rows: Iterator[tuple], schema: pa.Schema, at_most: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= at_most:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def apply_window(df: DataFrame, ts: str, size: str, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                 fn: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], out: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``window.apply`` / ``ProcessWindowFunction`` (G6, W7): ``fn`` reads the contents of one (keys, window), the
    ``columns`` in the given order, batch by batch, and yields tuples of the schema ``out``.

    Result: ``keys, window_start, window_end`` and ``out``. Any window size fits: a task holds one batch. A
    window is one function call, so it is one task's work; combine what can be combined with
    an aggregate instead."""
    w = F.window(ts, size)
    rows = df.select(*keys, w["start"].alias("window_start"), w["end"].alias("window_end"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                     *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    by = [*keys, "window_start", "window_end"]
    rows = rows.repartition(*by).sortWithinPartitions(*by, *[f"_o{i}" for i in range(len(order))])
    rows = rows.select(*by, *[f"_c{i}" for i in range(len(columns))])
    named, n, names = rows.select(*by).schema, len(by), list(columns)
    full = _parse_datatype_string(out)
    for f in reversed(named.fields):
        full.fields.insert(0, f)
        full.names.insert(0, f.name)

    schema = to_arrow_schema(full)

    def run(batches):
        def results():
            for key, mine in groups(batches, n, batch_rows):
                contents = (pa.RecordBatch.from_arrays(b.columns[n:], names=names) for b in mine)
                yield from ((*key, *row) for row in fn(contents))
        return _send(results(), schema)
    return rows.mapInArrow(run, full)


def ordered_fold(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], add: Callable[[tuple | None, tuple], tuple],
                 merge: Callable[[tuple, tuple], tuple], result: Callable[[tuple], tuple], acc: str, out: str, fan: int = FAN) -> DataFrame:
    """A fold over the rows of a key in order (A3, G4), for any associative ``merge``; it need not commute.

    ``add(accumulator or None, row)`` takes a row (its ``columns``) in, ``merge(earlier, later)`` joins two accumulators
    (tuples of the schema ``acc``), ``result`` turns the last one into a tuple of ``out``.

    Rows are sorted by range of (key, order), so a hot key lies in many tasks; each task folds its
    stretch of a key to one accumulator. These are merged in order, ``fan`` tasks' worth at a time,
    level by level, so no step takes more than ``fan`` of a key. ``order`` must be total within a key.
    """
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                     *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    by = ["_k", *[f"_o{i}" for i in range(len(order))]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("_k", *[f"_c{i}" for i in range(len(columns))])
    partial = f"_k {key_type}, _part bigint, {acc}"
    schema = to_arrow_schema(_parse_datatype_string(partial))

    def first(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()

        def results():
            for k, mine in groups(batches, 1):
                state = None
                for batch in mine:
                    for row in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
                        state = add(state, row)
                yield (*k, part, *state)
        return _send(results(), schema)

    def step(batches):
        def results():
            for (k, part), mine in groups(batches, 2):
                state = None
                for batch in mine:
                    for row in zip(*[c.to_pylist() for c in batch.columns[3:]], strict=True):
                        state = row if state is None else merge(state, row)
                yield (k, part, *state)
        return _send(results(), schema)
    accs = rows.mapInArrow(first, partial)
    names = accs.columns[2:]
    for _ in range(max(1, math.ceil(math.log(max(2, parts), fan)))):
        # parts of a level: the number of its group of ``fan``, then its own, in order
        grouped = accs.select("_k", F.floor(F.col("_part") / F.lit(fan)).cast("long").alias("_group"), "_part", *names)
        accs = grouped.repartition("_k", "_group").sortWithinPartitions("_k", "_group", "_part").mapInArrow(step, partial)
    final = f"{key} {key_type}, {out}"
    final_schema = to_arrow_schema(_parse_datatype_string(final))

    def last(batches):
        return _send(((row[0], *result(row[2:])) for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True)), final_schema)
    return accs.mapInArrow(last, final)


def keyed_fold(df: DataFrame, key: str, create: Callable[[], tuple], add: Callable[[tuple, dict], tuple], merge: Callable[[tuple, tuple], tuple],
               result: Callable[[object, tuple], tuple], acc: str, out: str, flush: int = FLUSH_KEYS) -> DataFrame:
    """``AggregateFunction`` per key in any order (G5): ``merge`` associative and commutative.

    A task combines its rows in at most ``flush`` accumulators and sends all of them on when it would
    need more, so its memory doesn't grow with its keys. The second step reads the accumulators
    sorted by key and merges them one by one."""
    names, key_type = df.columns, df.schema[key].dataType.simpleString()
    at = names.index(key)
    partial, final = f"_k {key_type}, {acc}", out
    schema, final_schema = (to_arrow_schema(_parse_datatype_string(x)) for x in (partial, final))

    def first(batches):
        def results():
            held: dict = {}
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    k = row[at]
                    if k not in held and len(held) >= flush:
                        yield from ((k2, *a) for k2, a in held.items())
                        held = {}
                    held[k] = add(held[k] if k in held else create(), dict(zip(names, row, strict=True)))
            yield from ((k2, *a) for k2, a in held.items())
        return _send(results(), schema)

    def last(batches):
        def results():
            for (k,), mine in groups(batches, 1):
                state = None
                for batch in mine:
                    for row in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
                        state = row if state is None else merge(state, row)
                yield result(k, state)
        return _send(results(), final_schema)
    return df.mapInArrow(first, partial).repartition("_k").sortWithinPartitions("_k").mapInArrow(last, final)
