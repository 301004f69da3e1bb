"""User functions for logic the built-ins cannot express.

The slow path, Arrow-batched: rows reach Python through ``mapInPandas`` /
``applyInPandas``, never one row per call. Prefer built-in expressions and
:mod:`tidewater.operators.keyed` whenever a fold is a sum/min/max/count.

Keyed folds run in two phases (:mod:`tidewater.operators.folds`): tasks combine their rows in a
bounded number of accumulators, which are then merged in the order of their keys, one at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidewater.operators import folds


def _names(schema: StructType | str, df: DataFrame) -> list[str]:
    if isinstance(schema, StructType):
        return schema.fieldNames()
    return df.sparkSession.createDataFrame([], schema).columns


def flat_map(df: DataFrame, fn: Callable[[dict], Iterable], schema: StructType | str) -> DataFrame:
    """``FlatMapFunction``: ``fn(row) -> iterable of tuples`` (0..n rows per input)."""
    names = _names(schema, df)

    def run(batches):
        for pdf in batches:
            out = [tuple(o) for rec in pdf.to_dict("records") for o in fn(rec)]
            yield pd.DataFrame.from_records(out, columns=names)
    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable[[dict], tuple], schema: StructType | str) -> DataFrame:
    """``MapFunction``: exactly one output row per input row."""
    return flat_map(df, lambda r: [fn(r)], schema)


def filter_rows(df: DataFrame, pred: Callable[[dict], bool]) -> DataFrame:
    """``FilterFunction`` on whole rows."""
    def run(batches):
        for pdf in batches:
            keep = [bool(pred(rec)) for rec in pdf.to_dict("records")]
            yield pdf[keep]
    return df.mapInPandas(run, df.schema)


def reduce_by_key(df: DataFrame, key: str, fn: Callable[[dict, dict], dict]) -> DataFrame:
    """``keyBy(key).reduce(fn)`` for an associative and commutative ``fn(a, b) -> row``; one row per key.
    Output schema = input schema. A task holds a bounded number of keys (see :func:`folds.keyed_fold`)."""
    cols = df.columns
    fields = ", ".join(f"_v{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema))

    def join(a: tuple, b: tuple) -> tuple:
        out = fn(dict(zip(cols, a, strict=True)), dict(zip(cols, b, strict=True)))
        return tuple(out[c] for c in cols)

    def add(state: tuple, rec: dict) -> tuple:
        row = tuple(rec[c] for c in cols)
        return join(state, row) if state else row
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return folds.keyed_fold(df, key, tuple, add, join, lambda k, state: state, fields, out)


def aggregate_by_key(df: DataFrame, key: str, create: Callable[[], tuple], add: Callable[[tuple, dict], tuple],
                     merge: Callable[[tuple, tuple], tuple], result: Callable[[object, tuple], tuple],
                     acc_schema: str, out_schema: str) -> DataFrame:
    """``AggregateFunction`` (createAccumulator / add / merge / getResult) per key.

    ``acc_schema`` types the accumulator tuple that travels between the phases;
    ``result(key, acc)`` returns the output tuple typed by ``out_schema``.
    """
    return folds.keyed_fold(df, key, create, add, merge, result, acc_schema, out_schema)
