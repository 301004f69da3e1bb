"""Per-group top-k and totals.

``row_number() <= k`` over a window lets Spark push the limit into the
window's input sort (window group limit), so each task keeps k rows per group
instead of materialising whole groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: Sequence[str] | str, order: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` (ties broken by the later order columns)."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("long"))


def round_half_up(c: Column, scale: int = 2) -> Column:
    """``setScale(scale, HALF_UP)`` on an exact decimal value."""
    return F.round(c.cast("decimal(38,6)"), scale)


def group_total(df: DataFrame, group: Sequence[str] | str, value: str, out: str,
                scale: int = 2) -> DataFrame:
    """Sum per group, rounded half-up to ``scale`` places, as a double."""
    group = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*group).agg(
        round_half_up(F.sum(value), scale).cast("double").alias(out))


def ranked_text(df: DataFrame, group: Sequence[str] | str, rank_col: str, text: Column,
                out: str, sep: str = "\n") -> DataFrame:
    """Join the (already top-k limited) rows of a group into one string in rank order."""
    group = [group] if isinstance(group, str) else list(group)
    items = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"), text.alias("t"))))
    return df.groupBy(*group).agg(F.array_join(F.transform(items, lambda x: x["t"]), sep).alias(out))
