"""Retract changelogs ``(flag, row)`` of continuous queries.

For every input row of a keyed aggregate, a retracting sink receives
``(false, old)`` when the key already had a result and then ``(true, new)``.
Batch form: the running aggregate (blocked scan, no hot task) and its
previous value, exploded into the two change rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import scan


def _change(seq: str, n: int, flag: bool, keys: Sequence[str], value: Column, out: str) -> Column:
    fields = [F.col(seq).alias(seq), F.lit(n).alias("change_seq"), F.lit(flag).alias("flag")]
    fields += [F.col(k).alias(k) for k in keys]
    return F.struct(*fields, value.alias(out))


def aggregate_changelog(df: DataFrame, keys: Sequence[str] | str, seq: str, value: str | None,
                        how: str = "count", out: str = "value",
                        block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """Changelog of ``groupBy(keys).agg(how(value))`` fed in ``seq`` order.

    Output columns: ``seq``, ``change_seq`` (0 retract, 1 add within one input),
    ``flag``, keys, ``out``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how == "count":
        cur = scan.running(df, keys, [seq], None, how="count", out="_new", block_size=block_size)
        old = F.when(F.col("_new") > 1, F.col("_new") - 1)
    elif how == "sum":
        # previous result = current minus this row's contribution; none for a key's first row
        cur = scan.running_many(df, keys, [seq], [(value, "sum", "_new"), (None, "count", "_pos")],
                                block_size=block_size)
        old = F.when(F.col("_pos") > 1, F.col("_new") - F.col(value))
    else:
        cur = scan.running(df, keys, [seq], value, how=how, out="_new", block_size=block_size)
        cur = scan.running(cur, keys, [seq], value, how=how, out="_old", inclusive=False,
                           block_size=block_size)
        old = F.col("_old")
    pairs = F.array(_change(seq, 0, False, keys, old, out), _change(seq, 1, True, keys, F.col("_new"), out))
    return (cur.select(F.explode(pairs).alias("_c")).select("_c.*")
            .where(F.col("flag") | F.col(out).isNotNull()))


def count_changelog(df: DataFrame, keys: Sequence[str] | str, seq: str, out: str = "cnt",
                    block_size: int | scan.Blocks | None = scan.DEFAULT_BLOCK) -> DataFrame:
    """Changelog of a running count per key: old = new - 1, none for the first row."""
    return aggregate_changelog(df, keys, seq, None, "count", out, block_size)


def having_changelog(changes: DataFrame, predicate: Column) -> DataFrame:
    """Changelog through a HAVING filter (C2): a row enters with ``true`` and
    leaves with ``false``; changes of rows outside the predicate vanish."""
    return changes.where(predicate)


def distinct_changelog(df: DataFrame, cols: Sequence[str], seq: str) -> DataFrame:
    """Changelog of ``SELECT DISTINCT`` (C3): ``(true, row)`` at first occurrence only.

    ``groupBy(cols).min(seq)`` finds the first occurrence with a map-side
    partial aggregate, so a frequent row costs nothing extra.
    """
    return (df.groupBy(*cols).agg(F.min(seq).alias(seq))
            .select(F.lit(True).alias("flag"), *cols, seq))


def append_only(df: DataFrame) -> DataFrame:
    """Append-only plans (windowed aggregates, filters): every change adds (C4)."""
    return df.select(F.lit(True).alias("flag"), "*")
