"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Every vector is projected on ``PROJECTIONS`` random lines. Two unit vectors at cosine
``t`` are at most ``r = sqrt(2 - 2t)`` apart, so on each line their difference is a normal
variable of deviation ``r``; on a line they collide if the difference is at most ``WIDTH * r``.
Pairs with at least as many collisions as a binomial tail allows for the wanted recall
are verified by their exact cosine.

The first line is the sorted one: it is cut into cells, a vector is stored in its cell and
queries the cells that its window of ``LEAD * r`` reaches to the right, so each pair meets
once. Cells are dealt in chunks; a task counts the collisions of one chunk of queries
with one chunk of stored vectors as matrices, and returns link counts and a spanning
forest, never the pairs. Equal vectors are one class before any of this.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import materialise
from tidewater.llm.components import connected_components

COSINE = 0.98
PROJECTIONS = 24
WIDTH = 2.0
LEAD = 5.0
CELLS_PER_WINDOW = 4
RECALL = 0.99999
CHUNK = 1024


def lines(dim: int, n: int = PROJECTIONS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed + dim).standard_normal((dim, n))


def needed_count(n: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with chance ``recall``."""
    p = math.erf(width / math.sqrt(2))
    tail = 0.0
    for k in range(n + 1):
        tail += math.comb(n, k) * p ** k * (1 - p) ** (n - k)
        if tail > 1 - recall:
            return k
    return n


def _usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, cosine: float) -> DataFrame:
    """``id, label, dim, d1, d2, unit, cell`` of vectors that can be linked."""
    kind = vectors.schema[label_col].dataType.simpleString()
    schema = T._parse_datatype_string(f"id long, label {kind}, dim int, d1 long, d2 long, vec array<double>, cell int")
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    step = LEAD * math.sqrt(2 - 2 * cosine) / CELLS_PER_WINDOW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = []
            for i, label, v in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if i is None or label is None or not v or any(x is None for x in v):
                    continue
                x = np.array(v, dtype=np.float64)
                norm = float(np.sqrt(x @ x))
                if not np.isfinite(x).all() or norm == 0 or not math.isfinite(norm):
                    continue
                if len(x) not in axes:
                    axes[len(x)] = lines(len(x))[:, 0]
                d = xxhash.xxh3_128_intdigest((x + 0.0).tobytes())
                rows.append((i, label, len(x), (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63), x.tolist(),
                             math.floor(float(x @ axes[len(x)]) / norm / step)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return vectors.select(F.col(id_col).cast("long"), F.col(label_col), F.col(vec_col)).mapInArrow(run, schema)


def _tasks(classes: DataFrame) -> DataFrame:
    """Rows of ``classes`` dealt to tasks (label, dim, target, part_d, part_q), as stored
    vector (``query`` false) or as query."""
    where = ["label", "dim"]
    reach = F.sequence(F.col("cell"), F.col("cell") + CELLS_PER_WINDOW)
    queries = classes.withColumn("target", F.explode(reach))
    stored = classes.withColumn("target", F.col("cell"))
    n_d = stored.groupBy(*where, "target").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n_d"))
    n_q = queries.groupBy(*where, "target").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n_q"))
    parts = n_d.join(n_q, [*where, "target"])

    def dealt(rows: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        rows = rows.join(parts, [*where, "target"])
        rows = rows.withColumn(own, F.pmod(F.xxhash64("rep"), F.col(f"n_{own[-1]}")).cast("int"))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other[-1]}") - 1)))
        return rows.select(*where, "target", "part_d", "part_q", F.lit(query).alias("query"), "rep", "n", "cell", "vec")

    return dealt(stored, "part_d", "part_q", False).unionAll(dealt(queries, "part_q", "part_d", True))


def count_collisions(q: np.ndarray, d: np.ndarray, width: float) -> np.ndarray:
    """How many of the projections of each query and each stored vector are within ``width``."""
    out = np.zeros((len(q), len(d)), np.uint8)
    for j in range(q.shape[1]):
        out += np.abs(q[:, j, None] - d[None, :, j]) <= width
    return out


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """``a, b, n``: rows with a null ``b`` say that class ``a`` has ``n`` more links; others are links of a forest."""
    width, need = WIDTH * math.sqrt(2 - 2 * cosine), needed_count()

    def compare(key, frame):
        import pandas as pd
        d, q = frame[~frame["query"]], frame[frame["query"]]
        if d.empty or q.empty:
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
        d, q = d.sort_values("rep"), q.sort_values("rep")
        x, y = np.array(q["vec"].tolist()), np.array(d["vec"].tolist())
        nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
        axes = lines(x.shape[1])
        px, py = (x @ axes / nx[:, None]).astype(np.float32), (y @ axes / ny[:, None]).astype(np.float32)
        i, j = (count_collisions(px, py, np.float32(width * 1.0001)) >= need).nonzero()
        qa, da = q["rep"].to_numpy(), d["rep"].to_numpy()
        cq, cd = q["cell"].to_numpy(), d["cell"].to_numpy()
        once = (cq[i] < cd[j]) | (qa[i] < da[j])
        i, j = i[once], j[once]
        good = np.empty(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            good[s] = np.einsum("ij,ij->i", x[i[s]], y[j[s]]) / (nx[i[s]] * ny[j[s]]) >= cosine
        i, j = i[good], j[good]
        more_q = np.bincount(i, weights=d["n"].to_numpy()[j], minlength=len(q)).astype(np.int64)
        more_d = np.bincount(j, weights=q["n"].to_numpy()[i], minlength=len(d)).astype(np.int64)
        parent: dict[int, int] = {}

        def find(v):
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        kept = []
        for a, b in zip(qa[i].tolist(), da[j].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                kept.append((a, b))
        a = np.concatenate([qa[more_q > 0], da[more_d > 0], np.array([k[0] for k in kept], np.int64)])
        n = np.concatenate([more_q[more_q > 0], more_d[more_d > 0], np.zeros(len(kept), np.int64)])
        b = pd.array([None] * (len(a) - len(kept)) + [k[1] for k in kept], dtype="Int64")
        return pd.DataFrame({"a": a.astype("int64"), "b": b, "n": n})

    return _tasks(classes).groupBy("label", "dim", "target", "part_d", "part_q").applyInPandas(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors are compared if their labels are equal and not null and they have the same number
    of components; a link is a cosine of at least ``cosine`` in double precision.
    ``n_links`` counts other vectors linked directly (equal vectors link each other),
    ``component_id`` is the smallest id that links reach, ``kept`` says it is the own.
    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. Rows with a null id link with nothing, have a null component and are kept.
    Ids are unique; rows that repeat one are vectors of their own that share a component
    and the links of both where they lead their classes. An empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    usable = materialise(spark, _usable(vectors, id_col, vec_col, label_col, cosine), "vectors")
    key = ["label", "dim", "d1", "d2"]
    classes = materialise(spark, usable.groupBy(*key, "cell").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")), "vector-classes")
    found = materialise(spark, _links(classes.drop("d1", "d2"), cosine), "collisions")
    more = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    labels = connected_components(found.where("b IS NOT NULL")).select(F.col("node").alias("rep"), F.col("component"))
    known = classes.select(*key, "rep", "n").join(more, "rep", "left").join(labels, "rep", "left").select(
        *key, (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    each = usable.select("id", *key).join(known, key).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    out = vectors.select(F.col(id_col).cast("long").alias("vec_id")).join(each, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
