"""Running (prefix) aggregates within a key, in arrival order, without hot tasks.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one
task. With a handful of keys (five event types, one global watermark) that is a
third of the data in one task. The scan here splits each key into *blocks* of
the ordering column and works in three steps:

1. ``groupBy(key, block)`` totals -- partial aggregation, a small shuffle;
2. an exclusive prefix over those totals per key: a window over the key's
   block totals (range / width rows, not input rows). The same scan can be
   applied to the totals recursively (``MAX_DEPTH``, blocks of ``FANOUT``
   blocks) when an ordering range is extreme;
3. the prefix is unioned back as one *carry* row per (key, block) that sorts
   before the real rows, and a window over ``(key, block)`` finishes the scan.

Every window task holds at most one block of one key, whatever the skew. Blocks have a
fixed width of the ordering column, or, from :func:`plan_blocks`, a bounded number of rows.
Step 3 is the only full-size shuffle; the input is read twice (totals, rows),
the price of any two-pass distributed scan, still cheaper than materialising.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Block width in units of the first ordering column (None = pick by type):
# dense ids -> 4M ids; timestamps -> 1 hour; dates -> 7 days.
DEFAULT_BLOCK = None
ID_BLOCK = 1 << 22
HOUR_MICROS = 3_600_000_000
FANOUT = 4096
# Row budget of a planned block (over all keys), and bins of the histogram it is planned from.
ROWS_PER_BLOCK = 1 << 22
BINS = 1 << 16
# Levels of blocking applied to the block totals themselves. 0: one window per
# key over its block totals (#blocks = range / width rows, independent of the
# row count); raise it only for extreme ranges -- each level re-reads the input.
MAX_DEPTH = 0

_COMBINE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
_MERGE = {"sum": "sum", "count": "sum", "max": "max", "min": "min"}


def _as_long(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType.typeName()
    if dt in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if dt == "date":
        return F.unix_date(F.col(c)).cast("long")
    return F.col(c).cast("long")


def default_block(df: DataFrame, c: str) -> int:
    dt = df.schema[c].dataType.typeName()
    if dt in ("timestamp", "timestamp_ntz"):
        return HOUR_MICROS
    if dt == "date":
        return 7
    return ID_BLOCK


def _at(values: Sequence[int | None], i: Column) -> Column:
    """``values[i]``. Folded to one array literal: the cost doesn't depend on its length."""
    text = ",".join("-1" if v is None else str(v) for v in values)
    return F.nullif(F.element_at(F.split(F.lit(text), ",").cast("array<bigint>"), (i + 1).cast("int")), F.lit(-1).cast("long"))


@dataclass(frozen=True)
class Blocks:
    """Edges of blocks with a bounded number of rows, see :func:`plan_blocks`.

    ``levels`` holds ``(width, block, child)``: bins of equal width, from ``lo`` at the first
    level. A bin names its block, or the place of its own first bin at the next level.
    """
    lo: int = 0
    levels: tuple[tuple[int, tuple[int | None, ...], tuple[int | None, ...]], ...] = ()

    def _bins(self, x: Column) -> list[Column]:
        """The bin of ``x`` at every level, null below its last."""
        if not self.levels:
            return []
        width, block, _ = self.levels[0]
        known = F.least(F.greatest(x, F.lit(self.lo)), F.lit(self.lo + width * len(block) - 1))
        rest = F.when(x.isNotNull(), known - F.lit(self.lo).cast("long"))
        start, out = F.lit(0).cast("long"), []
        for width, _, child in self.levels:
            w = F.lit(width).cast("long")
            out.append(start + F.call_function("div", rest, w))
            rest, start = rest % w, _at(child, out[-1])
        return out

    def of(self, x: Column) -> Column:
        """Block of the value ``x``; null for null. Never falls as ``x`` grows."""
        if not self.levels:
            return F.when(x.isNotNull(), F.lit(0).cast("long"))
        return F.coalesce(*[_at(block, i) for (_, block, _), i in zip(self.levels, self._bins(x))])


def plan_blocks(df: DataFrame, order_col: str, rows: int | None = None, bins: int = BINS) -> Blocks:
    """Blocks of the ordering column with at most ``rows`` rows over all keys, whether its
    values are dense, sparse or come in bursts. Only rows that share one value stay together
    beyond that.

    Narrow jobs read the column: its range, a histogram of ``bins`` bins, and, while bins
    above the budget are left, a finer one of those. What reaches the driver of each is at
    most ``2 * bins`` numbers.
    """
    rows = rows or ROWS_PER_BLOCK
    x = _as_long(df, order_col)
    lo, hi, n = df.agg(F.min(x), F.max(x), F.count(x)).first()
    if n <= rows:
        return Blocks()
    width, size = (hi - lo) // bins + 1, bins
    levels: list[tuple[int, int, list[int], list[int | None]]] = []  # width, bins of a parent, counts, child
    while True:
        known = Blocks(lo, tuple((w, (None,) * len(c), tuple(ch)) for w, _, c, ch in levels)
                       + ((width, (None,) * size, (None,) * size),))
        hist = df.groupBy(known._bins(x)[-1].alias("b")).agg(F.count(F.lit(1)).alias("n")).where("b is not null").collect()
        parents = 1 if not levels else sum(c is not None for c in levels[-1][3])
        counts = [0] * (size * parents)
        for r in hist:
            counts[r["b"]] = r["n"]
        hot = [i for i, c in enumerate(counts) if c > rows and width > 1]
        fine = min(max(2, bins // max(1, len(hot))), width)
        child: list[int | None] = [None] * len(counts)
        for j, i in enumerate(hot):
            child[i] = j * fine
        levels.append((width, size, counts, child))
        if not hot:
            break
        width, size = -(-width // fine), fine

    blocks: list[list[int | None]] = [[None] * len(c) for _, _, c, _ in levels]
    block = fill = 0
    todo = [(0, i) for i in reversed(range(len(levels[0][2])))]
    while todo:  # bins in the order of their values
        level, i = todo.pop()
        down = levels[level][3][i]
        if down is not None:
            todo += [(level + 1, down + j) for j in reversed(range(levels[level + 1][1]))]
            continue
        c = levels[level][2][i]
        if fill and fill + c > rows:
            block, fill = block + 1, 0
        blocks[level][i] = block
        fill += c
    return Blocks(lo, tuple((w, tuple(bl), tuple(ch)) for (w, _, _, ch), bl in zip(levels, blocks)))


def block_of(df: DataFrame, order_col: str, block_size: int | Blocks | None) -> Column:
    if isinstance(block_size, Blocks):
        return block_size.of(_as_long(df, order_col))
    size = block_size or default_block(df, order_col)
    return F.floor(_as_long(df, order_col) / F.lit(size)).cast("long")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | str | None,
            how: str = "sum", out: str = "running", inclusive: bool = True,
            block_size: int | Blocks | None = DEFAULT_BLOCK) -> DataFrame:
    """Add ``out`` = aggregate ``how`` of ``value`` over the rows of the same key
    up to (``inclusive``) or before the current row in ``order``.

    ``how`` is one of sum, count, max, min. ``order`` must be a total order
    within a key (append a unique id when the first column has ties). Null
    keys form their own group, as in ``groupBy``.
    """
    return running_many(df, keys, order, [(value, how, out)], inclusive, block_size)


def running_many(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 specs: Sequence[tuple[Column | str | None, str, str]], inclusive: bool = True,
                 block_size: int | Blocks | None = DEFAULT_BLOCK, _depth: int = 0) -> DataFrame:
    """Several running aggregates ``(value, how, out)`` over one shuffle."""
    keys, order = list(keys), list(order)
    blk, mk = f"_blk{_depth}", f"_mk{_depth}"
    vals, aggs = [], []
    for i, (value, how, out) in enumerate(specs):
        if how not in _COMBINE:
            raise ValueError(f"unsupported running aggregate: {how}")
        if how == "count":
            v = F.lit(1).cast("long")
        else:
            v = F.col(value) if isinstance(value, str) else value
        name = f"_v{_depth}_{i}"
        vals.append(v.alias(name))
        aggs.append((how, name, out))

    base = df.withColumn(blk, block_of(df, order[0], block_size)).select("*", *vals)

    # 1. per-block totals (map-side partial aggregate)
    totals = base.groupBy(*keys, blk).agg(*[_COMBINE[h](v).alias(v) for h, v, _ in aggs])
    # 2. exclusive prefix of the totals over earlier blocks of the same key
    if _depth < MAX_DEPTH:
        sub = [(v, _MERGE[h], f"_p{_depth}_{i}") for i, (h, v, _) in enumerate(aggs)]
        pref = running_many(totals, keys, [blk], sub, inclusive=False, block_size=FANOUT, _depth=_depth + 1)
        prefix_cols = [F.col(f"_p{_depth}_{i}").alias(v) for i, (_, v, _) in enumerate(aggs)]
        carry = pref.select(*keys, blk, *prefix_cols)
    else:
        wk = Window.partitionBy(*keys).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(*keys, blk, *[_COMBINE[_MERGE[h]](v).over(wk).alias(v) for h, v, _ in aggs])
    present = [F.col(v).isNotNull() for _, v, _ in aggs]
    carry = carry.where(F.greatest(*present) if len(present) > 1 else present[0]).withColumn(mk, F.lit(0))
    # 3. carry row first, then the block's own rows
    rows = base.withColumn(mk, F.lit(1))
    both = rows.unionByName(carry, allowMissingColumns=True)
    end = Window.currentRow if inclusive else -1
    wb = (Window.partitionBy(*keys, blk).orderBy(mk, *order)
          .rowsBetween(Window.unboundedPreceding, end))
    res = both.select("*", *[_COMBINE[h](v).over(wb).alias(o) for h, v, o in aggs]).where(F.col(mk) == 1)
    return res.drop(blk, mk, *[v for _, v, _ in aggs])


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn",
               block_size: int | Blocks | None = DEFAULT_BLOCK) -> DataFrame:
    """1-based position of each row within its key (a running count)."""
    return running(df, keys, order, None, how="count", out=out, block_size=block_size)
