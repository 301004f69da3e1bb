"""Keyed aggregates: final (batch) and running (per input record).

Final aggregates are plain ``groupBy().agg()`` so Spark does map-side partial
aggregation; a hot key costs one partial row per task, not one task.
Running aggregates go through :mod:`tidewater.operators.scan`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import scan


def exact(c: Column | str, scale: int = 2) -> Column:
    """Money-like doubles summed exactly: to decimal first, back to double after."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal(18,{scale})")


def keyed_count(df: DataFrame, keys: Sequence[str] | str, out: str = "n") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def running_sum(df: DataFrame, key: Sequence[str] | str, seq: str, value: str, out: str = "running",
                exact_scale: int | None = None, block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """Running total per input record in arrival order (A2, STREAMING ``keyBy.sum``).
    ``exact_scale`` sums decimals of that scale instead of the values as they are."""
    keys = [key] if isinstance(key, str) else list(key)
    v = exact(value, exact_scale) if exact_scale is not None else F.col(value)
    res = scan.running(df, keys, [seq], v, how="sum", out=out, block_size=block_size)
    return res.withColumn(out, F.col(out).cast("double")) if exact_scale is not None else res


def running_max(df: DataFrame, key: Sequence[str] | str, seq: str, value: str, out: str = "max_so_far",
                block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """(key, current, max so far) per record (A5, ValueState running max)."""
    keys = [key] if isinstance(key, str) else list(key)
    return scan.running(df, keys, [seq], F.col(value), how="max", out=out, block_size=block_size)


def max_by_row(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """Whole row holding the maximum ``value`` per key; ties go to first arrival (A4).

    ``seq`` must be unique within a key. The best value per key, then the first ``seq`` that
    has it, are plain numbers that combine map-side in fixed-width buffers; only then are
    the winning rows fetched. Rows of a null key form their own group, rows of a null value
    win only where a key has no other.
    """
    k, best = F.col(key), F.col("_best")
    top = df.groupBy(k.alias("_k")).agg(F.max(value).alias("_best"))
    ties = df.select(k, F.col(value), F.col(seq)).join(
        top, k.eqNullSafe(F.col("_k")) & F.col(value).eqNullSafe(best), "left_semi")
    first = ties.groupBy(k.alias("_k")).agg(F.min(seq).alias("_seq"))
    return df.join(first, k.eqNullSafe(F.col("_k")) & (F.col(seq) == F.col("_seq")), "left_semi")


def reduce_sum(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``reduce((a, b) -> (a.k, a.n + b.n))`` (A3). Associative folds map to
    built-in aggregates so Spark can combine map-side."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


@dataclass
class Accumulator:
    """A user aggregate in the shape ``createAccumulator/add/merge/getResult``.

    ``parts`` are built-in aggregate columns (each is its own add + merge, so
    Spark runs them partially on the map side); ``result`` turns the merged
    parts into the output. Example, an average::

        Accumulator({"s": F.sum("v"), "n": F.count("v")}, lambda p: p["s"] / p["n"])
    """
    parts: Mapping[str, Column]
    result: Callable[[Mapping[str, Column]], Column]


def aggregate(df: DataFrame, keys: Sequence[str] | str, acc: Accumulator, out: str) -> DataFrame:
    """Apply a custom :class:`Accumulator` per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = df.groupBy(*keys).agg(*[c.alias(f"_p_{n}") for n, c in acc.parts.items()])
    merged = {n: F.col(f"_p_{n}") for n in acc.parts}
    return parts.select(*keys, acc.result(merged).alias(out))


def price_sum_accumulator(price: str, exact_scale: int | None = None) -> Accumulator:
    """The dashboard's incremental price sum; ``exact_scale``: decimal places summed exactly."""
    v = F.col(price) if exact_scale is None else exact(price, exact_scale)
    return Accumulator({"total": F.sum(v)}, lambda p: p["total"].cast("double"))


def sum_carry_first(df: DataFrame, keys: Sequence[str], value: str, seq: str,
                    carried: Sequence[str], out: str) -> DataFrame:
    """POJO field sum: ``value`` summed, other fields keep the first element's values (A10)."""
    aggs = [F.sum(value).cast("double").alias(out)]
    aggs += [F.min_by(F.col(c), F.col(seq)).alias(c) for c in carried]
    return df.groupBy(*keys).agg(*aggs)


def partition_counts(df: DataFrame, out: str = "n") -> DataFrame:
    """Rows per task: the reference's per-subtask counter, used as a skew report."""
    return (df.groupBy(F.spark_partition_id().alias("partition"))
            .agg(F.count(F.lit(1)).alias(out)))
