"""Min-max hashing near-duplicate detection.

A document is the set of its word shingles. Every hash function yields two signature
values, the minimum and the maximum over the set, so ``PERMUTATIONS`` functions give twice
as many values for half the hashing. Bands of ``ROWS`` values propose candidates:

1. equal sets are one class; only classes go on;
2. every class is compared with the smallest class of each of its buckets;
3. the links make components, and a bucket whose classes all share one is done;
4. buckets that still hold several components are compared throughout, in chunks of
   bounded size, and give a spanning forest of links only.

Every link is confirmed on the full shingle sets, by integers. Only what the bands miss is
lost: at similarity 0.85 a pair shares none of 26 bands of 5 with chance below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import U64, HashBits, map_texts, materialise, signed, space_words, word_hashes
from tidewater.llm.components import connected_components

PERMUTATIONS = 65
ROWS = 5
SHINGLE = 3
#: A link needs 100 * intersection >= SIMILARITY * union.
SIMILARITY = 85
CHUNK_CLASSES = 512
CHUNK_SHINGLES = 400_000
_A, _B, _C = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles; with fewer words
    the whole sequence is one, without words there is none."""
    words = space_words(text)
    if not words:
        return np.empty(0, U64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=k)], U64)
    h = word_hashes(words)
    n = len(h) - k + 1
    s = h[:n].copy()
    for i in range(1, k):
        s = (s * _A ^ (s >> U64(29))) + h[i:n + i]
    s = (s ^ (s >> U64(32))) * _B
    return np.unique(s ^ (s >> U64(29)))


def min_max_bands(sets: np.ndarray, seed: int = 7) -> np.ndarray:
    """Band keys of one set: interleaved minima and maxima, ``ROWS`` values a band."""
    rng = np.random.default_rng(seed)
    mask = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None]
    odd = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None] * U64(2) + U64(1)
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, U64)
    high = np.zeros(PERMUTATIONS, U64)
    for i in range(0, len(sets), 2048):
        y = (sets[None, i:i + 2048] ^ mask) * odd
        np.minimum(low, y.min(axis=1), out=low)
        np.maximum(high, y.max(axis=1), out=high)
    values = np.stack([low, high], axis=1).ravel()
    bands = values[:len(values) // ROWS * ROWS].reshape(-1, ROWS)
    key = np.arange(len(bands), dtype=U64) * _C
    for j in range(ROWS):
        key = (key ^ bands[:, j]) * _A
        key ^= key >> U64(31)
    return key


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands``; (d1, d2) is the digest of the set."""
    def make():
        def fn(doc_id, text) -> Iterator[tuple]:
            s = shingles(text)
            d = xxhash.xxh3_128_intdigest(s.tobytes())
            bands = signed(min_max_bands(s)).tolist() if len(s) else []
            yield doc_id, len(s), (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63), bands
        return fn

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"{id_col} {kind}, n_shingles long, d1 long, d2 long, bands array<long>", make)


def _sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, set`` of the documents in ``ids``. A bitmap sized by them drops most others
    before anything is shuffled, the join drops the rest."""
    h = ids.select("id", F.xxhash64("id").alias("h"))
    keep = HashBits.of(h, "h")

    def make():
        def fn(doc_id, h, text) -> Iterator[tuple]:
            if h is not None and doc_id is not None and keep.test(np.array([h]).view(U64))[0]:
                s = shingles(text)
                if len(s):
                    yield doc_id, signed(s).tolist()
        return fn

    hashed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col).cast("long")).alias("h"), F.col(text_col).alias("text"))
    return map_texts(hashed, ["id", "h"], "text", "id long, set array<long>", make).join(ids, "id", "left_semi")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that are links by their full sets."""
    a = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    inter = F.size(F.array_intersect("sa", "sb")).cast("long")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", inter.alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("n"))
    return both.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * SIMILARITY).select("a", "b")


def forest(sets: list[np.ndarray], comp: list[int], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` members of different components, as few as
    connect what is connected. Intersections of one set with all others are counted at once."""
    parent = {c: c for c in comp}

    def find(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    others = right.nonzero()[0]
    if not len(others):
        return []
    every, at = np.unique(np.concatenate([sets[j] for j in others]), return_inverse=True)
    sizes = np.array([len(sets[j]) for j in others])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(len(every), np.int64)
    out = []
    for i in left.nonzero()[0]:
        roots = np.array([find(comp[j]) for j in others])
        if (roots == find(comp[i])).all():
            continue
        where = np.searchsorted(every, sets[i])
        where = where[(where < len(every)) & (every[np.minimum(where, len(every) - 1)] == sets[i])]
        mark[where] = 1
        inter = np.add.reduceat(mark[at], starts)
        mark[where] = 0
        near = 100 * inter >= SIMILARITY * (len(sets[i]) + sizes - inter)
        for j in (near & (roots != find(comp[i]))).nonzero()[0]:
            a, b = find(comp[i]), find(comp[others[j]])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((comp[i], comp[others[j]]))
    return out


def _compare_open_buckets(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components inside buckets that hold several.

    A bucket is dealt into chunks of at most about ``CHUNK_CLASSES`` classes and
    ``CHUNK_SHINGLES`` shingles; two chunks meet in one task."""
    named = members.join(labels.select(F.col("node").alias("id"), "component"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    buckets = (named.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                                F.count("*").alias("m"), F.sum("n").alias("w"))
               .where("m > 2 AND low < high")
               .select("band", "key", F.greatest(F.ceil(F.col("m") / CHUNK_CLASSES), F.ceil(F.col("w") / CHUNK_SHINGLES)).cast("int").alias("chunks")))
    open_ = named.join(buckets, ["band", "key"]).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int"))
    met = open_.select("band", "key", "id", "component", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    met = met.select("band", "key", "id", "component", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))

    def links(key, frame):
        import pandas as pd
        frame = frame.sort_values("id")
        all_sets = [np.sort(np.asarray(s, dtype=np.int64)) for s in frame["set"]]
        chunk = frame["chunk"].to_numpy()
        pairs = forest(all_sets, frame["component"].tolist(), chunk == key[2], chunk == key[3])
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    return met.join(sets, "id").groupBy("band", "key", "lo", "hi").applyInPandas(links, "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links reach; ``kept`` says it is the
    document's own. Null texts, empty ones and those without words have no shingles and
    stand alone. Exact copies (equal sets) share a component. Rows that share an id are one
    document: what links one of them links all. Rows with a null id get a null component
    and are kept. An empty table gives no rows. Other columns are ignored. ``id_col`` is integer.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    feats = materialise(spark, features(docs, "id", "text"), "features")
    digest = ["n_shingles", "d1", "d2"]
    classes = (feats.where("n_shingles > 0 AND id IS NOT NULL").groupBy(*digest)
               .agg(F.min("id").alias("rep"), F.first("bands").alias("bands")))
    classes = materialise(spark, classes, "classes")

    rows = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("m")).where("m > 1")
    # A table of its own, so that Spark may split the side of a bucket with many classes.
    buckets = materialise(spark, buckets.drop("m"), "first-of-bucket")
    members = materialise(spark, rows.join(buckets, ["band", "key"]), "buckets")
    fits = 100 * F.least("n", "first.n") >= SIMILARITY * F.greatest("n", "first.n")
    pairs = members.where((F.col("id") != F.col("first.id")) & fits).select(F.col("id").alias("a"), F.col("first.id").alias("b")).distinct()

    sets = materialise(spark, _sets_of(docs, members.select("id").distinct(), "id", "text"), "sets")
    again = feats.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    shared = feats.join(again, "id", "left_semi").join(classes.select(*digest, "rep"), digest).select(
        F.col("id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    links = materialise(spark, _confirmed(pairs, sets).unionAll(shared), "links")
    labels = connected_components(links)
    more = materialise(spark, _compare_open_buckets(members, labels, sets), "more-links")
    merged = connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    labels = merged.select(F.col("node").alias("rep"), F.col("component").alias("component_id"))

    known = classes.select(*digest, "rep").join(labels, "rep", "left").select(
        *digest, F.coalesce("component_id", "rep").alias("component_id"))
    out = feats.select("id", *digest).join(known, digest, "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
