"""Versioned broadcast state (J3, E9, M7): each event meets the version in force when it happened."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import scan


def enrich_as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, version_at: str, columns: Mapping[str, str],
                 how: str = "inner", block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """``facts`` with ``columns`` (new name -> column of ``versions``) of the newest version at or
    before ``at``, of the same ``keys``; with no keys, of all versions.

    A running last-value scan over the union of versions and facts: neither side is broadcast
    or joined, and no task holds more than a block of one key. Of versions of one time the
    largest by ``columns`` counts. Facts before the first version, or without a time, are dropped
    (``how="left"``: kept with nulls). Versions without a time or a key are never in force.
    """
    keys = list(keys)
    version = F.struct(F.col(version_at).alias("_since"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns.values())])
    known = F.col(version_at).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    news = versions.where(known).select(*keys, F.col(version_at).alias(at), version.alias("_version"), F.lit(0).alias("_fact"))
    rows = news.unionByName(facts.withColumn("_fact", F.lit(1)), allowMissingColumns=True)
    seen = scan.running(rows, keys, [at, "_fact"], "_version", how="max", out="_now", block_size=block_size).where("_fact = 1")
    if how == "inner":
        seen = seen.where(F.col("_now").isNotNull())
    return seen.select(*facts.columns, *[F.col("_now")[f"_{i}"].alias(name) for i, name in enumerate(columns)])
