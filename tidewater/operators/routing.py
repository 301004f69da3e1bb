"""Routing: side outputs, connect/co-map, unions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_by_tag(df: DataFrame, tag: Column, tags: Mapping[str, object] | None = None,
                 main: Column | None = None) -> dict[str, DataFrame]:
    """``ProcessFunction`` with side outputs: returns ``{"main": ..., tag: ...}``.

    ``tag`` computes the side-output name per row (null = main output). The
    reference's parity split sends every row to a side output, so ``main`` is
    empty there. Downstream, each entry is an independent filter of one scan;
    in a stream, fan out inside one ``foreachBatch`` over a persisted batch.
    """
    tagged = df.withColumn("_tag", tag)
    out = {"main": tagged.where(F.col("_tag").isNull() if main is None else main).drop("_tag")}
    for name in (tags or {}):
        out[name] = tagged.where(F.col("_tag") == F.lit(name)).drop("_tag")
    return out


def tag_rows(df: DataFrame, tag: Column, out: str = "tag") -> DataFrame:
    """All side outputs in one frame with a ``tag`` column."""
    return df.withColumn(out, tag).where(F.col(out).isNotNull())


def parity_tag(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.pmod(c, F.lit(2)) == 0, F.lit("even")).otherwise(F.lit("odd"))


def connect_map(first: DataFrame, second: DataFrame, map1: Callable[[DataFrame], Column],
                map2: Callable[[DataFrame], Column], out: str = "value") -> DataFrame:
    """``connect`` + ``CoMapFunction``: two differently typed inputs mapped to one type."""
    return first.select(map1(first).alias(out)).unionByName(second.select(map2(second).alias(out)))


def union_all(*dfs: DataFrame) -> DataFrame:
    """``DataStream.union``: same schema, duplicates kept."""
    res = dfs[0]
    for d in dfs[1:]:
        res = res.unionByName(d)
    return res


def union_filtered(df: DataFrame, *conds: Column) -> DataFrame:
    """``UNION ALL`` of several filtered views of *one* input, in one read: each
    row is emitted once per condition it satisfies (same result as unioning
    ``df.where(c)`` for every ``c``, without scanning ``df`` once per branch)."""
    hits = F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conds)])
    some = reduce(lambda a, b: a | b, conds)  # reaches the scan, which the array does not
    return (df.where(some).select("*", F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("_branch"))
            .drop("_branch"))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION``: duplicates removed (U2). Spark de-duplicates map-side first."""
    return union_all(*dfs).distinct()
