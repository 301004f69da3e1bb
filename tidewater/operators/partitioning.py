"""Physical partitioning choices of the reference.

Spark has no per-edge partitioner, so each becomes the repartitioning that
moves rows the same way before the next stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_global(df: DataFrame) -> DataFrame:
    """``global()``: every row to one task (X1). Only for small, bounded data."""
    return df.repartition(1)


def replicate(df: DataFrame, n: int) -> DataFrame:
    """``broadcast()`` partitioning (X2): every row copied to each of ``n`` tasks.
    ``replica`` says which task got the copy."""
    copies = df.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col("replica"))


def forward(df: DataFrame) -> DataFrame:
    """``forward()`` (X3): stay in the same task -- no exchange at all."""
    return df


def shuffle(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``shuffle()`` (X4): uniformly random task."""
    return df.repartition(n, F.rand(seed))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """``rebalance()`` (X5): round robin, evens out skew after a filter."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """``rescale()`` (X6): merge neighbouring tasks without a full shuffle."""
    return df.coalesce(n)


def custom(df: DataFrame, n: int, partition_of: Column) -> DataFrame:
    """``partitionCustom(partitioner, key)`` (X7): ``partition_of`` gives the task
    number (taken modulo ``n``) for each row."""
    return df.repartitionById(n, F.pmod(partition_of, F.lit(n)).cast("int"))


def key_by(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``keyBy`` (X8): hash partitioning on the key."""
    return df.repartition(n, *keys)


def with_task_id(df: DataFrame, out: str = "partition") -> DataFrame:
    """Subtask index of each row."""
    return df.withColumn(out, F.spark_partition_id())
