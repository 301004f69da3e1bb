"""Source divergence audit: how far the word use of a language's sources is apart.

A group is a (lang, source). The indicator matrix of a language has a row for each kept term
and a column for each (group, count level); its product with its own transpose holds, for
every two groups, the joint table of their levels: how many terms have level a in one and
level b in the other. A term's price in a group depends on the level alone, so the distance
of two groups is the sum over the joint table of entries times price differences.

The product is taken block by block: terms are dealt to blocks of about ``BLOCK_TERMS`` by
hash, groups to blocks of about ``BLOCK_GROUPS``, and a task multiplies the two group blocks
of one term block. The entries are counts of at most a block's terms, so single precision
is exact; prices and sums are whole numbers. Blocks are priced where they are made, and
their sums added up: what is shuffled is one row for each block and pair of groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialise, small_batches

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BLOCK_TERMS = 512
BLOCK_GROUPS = 64
#: Columns of one dense product: sources are put together up to this many.
COLUMNS = 1024
#: Entries (group, term) a scanning task gathers before it sends them on.
FLUSH = 200_000
CHUNK = 1 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _words(text: str) -> Iterator[list[bytes]]:
    """Terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, A-Z lower-cased, about ``CHUNK`` bytes at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    lo = 0
    while lo < len(data):
        hi = len(data) if len(data) - lo <= CHUNK else data.find(b" ", lo + CHUNK)
        hi = len(data) if hi < 0 else hi
        yield data[lo:hi].split()
        lo = hi


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: partial counts from one scan, to be summed by key. A
    row with a null term stands for every group that occurs, terms or not. Nulls in text, lang and source are ''."""
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def out(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in found.items():
            terms = [None, *(t.decode("utf-8", "surrogatepass") for t in n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.string()),
                 pa.array([0, *n.values()], pa.int64()), pa.array([0, *(d[t] for t in n)], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n, d = found.setdefault((lang, source), (Counter(), Counter()))
                own: Counter = Counter()
                for words in _words(text):
                    own.update(words)
                before = len(n)
                for t, k in own.items():
                    n[t] += k
                d.update(own.keys())
                size += len(n) - before
                if size > FLUSH:
                    yield from out(found)
                    found, size = {}, 0
        yield from out(found)

    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def price(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms))``, exactly."""
    top = F.lit(SCALE).cast("decimal(12,0)") * (n + SMOOTH).cast("decimal(20,0)")
    return (F.call_function("div", top, (total + SMOOTH * terms).cast("decimal(20,0)")) + 1).cast("long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, **columns: str) -> DataFrame:
    """``lang, source, term, n, lang_n, first``: counts of the terms in at least ``min_docs``
    rows of their language; ``first`` marks one row of each (lang, term). Group rows have a
    null term. One shuffle, by (lang, term); written, since everything later reads it."""
    term = Window.partitionBy("lang", "term")
    sums = (term_counts(docs, **columns).repartition("lang", "term").groupBy("lang", "term", "source")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = (sums.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term),
                              "first": F.col("source") == F.min("source").over(term)})
            .where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)))
    return materialise(docs.sparkSession, kept.select("lang", "source", "term", "n", "lang_n", "first"), "kept-terms")


def group_totals(kept: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, terms, groups, p0`` for every group: occurrences of kept
    terms in the group and in the language, kept terms and groups of the language, the
    price of a term that the group lacks (null where no term is kept)."""
    by_source = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("term").isNotNull() & F.col("first"), 1).otherwise(0)).alias("terms"))
    # a language's row is a sum over its groups, not over its rows
    by_lang = by_source.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("terms").alias("terms"),
                                            F.count(F.lit(1)).alias("groups"))
    out = by_source.drop("terms").join(by_lang, "lang")
    p0 = F.when(F.col("terms") > 0, price(F.lit(0), F.col("total"), F.col("terms")))
    return materialise(kept.sparkSession, out.withColumn("p0", p0), "group-totals")


def priced(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept counts above 0 with ``p`` of the group and ``q`` of the language."""
    rows = kept.where("term IS NOT NULL AND n > 0").join(groups, ["lang", "source"])
    return rows.withColumns({"p": price(F.col("n"), F.col("total"), F.col("terms")),
                             "q": price(F.col("lang_n"), F.col("lang_total"), F.col("terms"))})


def _blocks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the indicator matrix by (lang, term block, two group blocks): a count above 0
    with its term, and for every group a row without term that tells its price at level 0 and
    how many terms the block has."""
    n_terms = F.greatest(F.ceil(F.col("terms") / BLOCK_TERMS), F.lit(1)).cast("int")
    n_groups = F.ceil(F.col("groups") / BLOCK_GROUPS).cast("int")
    block = F.pmod(F.xxhash64("term", F.lit("block")), n_terms).cast("int").alias("block")
    rows = priced(kept, groups).select("lang", "source", "term", "n", "p", n_groups.alias("gs"), block, "first")
    sizes = rows.where("first").groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
    counts = rows.select("lang", "source", "term", "n", "p", "gs", "block", F.lit(None).cast("long").alias("size"))
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
                          F.coalesce("p0", F.lit(0)).alias("p"), n_groups.alias("gs"),
                          F.explode(F.sequence(F.lit(0), n_terms - 1)).alias("block"))
    heads = heads.join(sizes, ["lang", "block"], "left").withColumn("size", F.coalesce("size", F.lit(0)))
    own = F.pmod(F.xxhash64("source"), F.col("gs")).cast("int")
    rows = counts.unionByName(heads).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("gs") - 1)))
    return rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "gs")


def _indicators(rows, n_terms: int) -> tuple[list[str], list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For each source of ``rows``, in order: name, its levels, their prices, the level of every term."""
    names, levels, prices, at = [], [], [], []
    for name, part in sorted(rows.groupby("source"), key=lambda g: g[0]):
        level, index = np.unique(part["n"].to_numpy(), return_inverse=True)  # the head row is level 0
        cost = np.zeros(len(level), np.int64)
        cost[index] = part["p"].to_numpy()
        where = np.zeros(n_terms, np.int64)
        code = part["code"].to_numpy()  # the head row's is -1
        where[code[code >= 0]] = index[code >= 0]
        names.append(name)
        levels.append(level)
        prices.append(cost)
        at.append(where)
    return names, levels, prices, at


def _chunks(levels: Sequence[np.ndarray]) -> Iterator[range]:
    """Runs of sources with at most ``COLUMNS`` levels together (one source at least)."""
    lo = used = 0
    for i, x in enumerate(levels):
        if used and used + len(x) > COLUMNS:
            yield range(lo, i)
            lo, used = i, 0
        used += len(x)
    if lo < len(levels):
        yield range(lo, len(levels))


def _one_hot(levels, at, run: range) -> tuple[np.ndarray, np.ndarray]:
    """Indicator columns of the sources in ``run``, and where each source's columns start."""
    starts = np.concatenate([[0], np.cumsum([len(levels[i]) for i in run])])
    x = np.zeros((len(at[run[0]]), starts[-1]), np.float32)
    for k, i in enumerate(run):
        x[np.arange(len(at[i])), starts[k] + at[i]] = 1
    return x, starts[:-1]


def products(rows, same: bool):
    """Joint tables of one block: (sources a, sources b, level starts a, b, entries, sides).

    ``rows`` is a pandas frame of :func:`_blocks` for one key. The entries of one dense
    product cover several sources on either side; ``same`` says that both sides are one group block.
    """
    codes, terms = rows["term"].factorize()
    rows = rows.assign(code=codes)
    sides = [_indicators(rows[rows["own"] == k], len(terms)) for k in ([rows["lo"].iloc[0]] if same else [rows["lo"].iloc[0], rows["hi"].iloc[0]])]
    left, right = sides[0], sides[-1]
    absent = int(rows["size"].max()) - len(terms)  # terms of the block that only other groups have
    for a in _chunks(left[1]):
        xa, sa = _one_hot(left[1], left[3], a)
        for b in _chunks(right[1]):
            if same and b[-1] < a[0]:
                continue  # the transpose was taken already
            xb, sb = _one_hot(right[1], right[3], b)
            joint = xa.T @ xb
            joint[np.ix_(sa, sb)] += absent
            yield left, right, a, b, sa, sb, joint


def pair_distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for every two sources of a language, once each; 0 without kept terms."""
    def run(key, rows):
        import pandas as pd
        same = key[2] == key[3]
        out = []
        for left, right, a, b, sa, sb, joint in products(rows, same):
            cost = np.abs(np.concatenate([left[2][i] for i in a])[:, None] - np.concatenate([right[2][j] for j in b])[None, :])
            value = np.add.reduceat(np.add.reduceat(joint.astype(np.int64) * cost, sa, axis=0), sb, axis=1)
            out.extend((key[0], left[0][i], right[0][j], int(value[x, y])) for x, i in enumerate(a) for y, j in enumerate(b)
                       if not same or i < j)
        return pd.DataFrame(out, columns=["lang", "a", "b", "value"])
    parts = _blocks(kept, groups).groupBy("lang", "block", "lo", "hi").applyInPandas(run, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def joint_tables(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, level_a, b, level_b, terms``: the joint tables themselves, entries above 0."""
    def run(key, rows):
        import pandas as pd
        same = key[2] == key[3]
        out = []
        for left, right, a, b, sa, sb, joint in products(rows, same):
            of_a, of_b = ([(k, v) for k in r for v in side[1][k]] for side, r in ((left, a), (right, b)))
            out.extend((key[0], left[0][of_a[x][0]], of_a[x][1], right[0][of_b[y][0]], of_b[y][1], int(joint[x, y]))
                       for x, y in zip(*np.nonzero(joint), strict=True) if not same or of_a[x][0] < of_b[y][0])
        return pd.DataFrame(out, columns=["lang", "a", "level_a", "b", "level_b", "terms"])
    parts = _blocks(kept, groups).groupBy("lang", "block", "lo", "hi").applyInPandas(
        run, "lang string, a string, level_a long, b string, level_b long, terms long")
    return parts.groupBy("lang", "a", "level_a", "b", "level_b").agg(F.sum("terms").alias("terms"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, **columns: str) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: every other source of the language with the summed price difference over
    all kept terms. Part ``term``: the ``top_terms`` kept terms of the group whose price is
    furthest above the language's. Ranks run by value descending, then item. Nulls in text,
    lang and source read as ''; every row counts as a document, repeated ones too; a
    language without kept terms has pairs of value 0; an empty table gives no rows; other
    columns are ignored.
    """
    kept = kept_terms(docs, min_docs, **columns)
    groups = group_totals(kept)
    pairs = pair_distances(kept, groups)
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pair = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    above = priced(kept, groups).where("p > q")
    term = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
        return rows.withColumn("rank", F.row_number().over(order))
    return ranked(pair).unionByName(ranked(term).where(F.col("rank") <= top_terms))
