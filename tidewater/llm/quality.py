"""Compression classifier: how well two zstandard dictionaries compress a text.

One dictionary is trained on text labelled good, one on text labelled bad. A text is cut
into blocks of ``BLOCK`` bytes (all of it, so that a dictionary matters as much at a long
text's end as at its start), every block is compressed with both, and the difference of
the total sizes divided by their sum is the raw score. A logistic curve over it and over
the log of the compressed share (text that says one thing again and again compresses far
too well with either dictionary), fitted on labelled rows that trained no dictionary,
turns it into a probability of label 1. Both labels weigh the same in the curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_texts

BLOCK = 1024
LEVEL = 3
DICT_MAGIC = (0xEC30A437).to_bytes(4, "little")
DICT_BYTES = 64 * 1024
#: Bounds of what fitting takes to the driver: rows for each label, characters of a row.
#: Longer labelled rows train nothing (they are still scored whole).
FIT_ROWS = 1500
FIT_CHARS = 20_000


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the curve over (difference, log of the compressed share)."""

    good: bytes
    bad: bytes
    mean: tuple[float, float] = (0.0, 0.0)
    scale: tuple[float, float] = (1.0, 1.0)
    weight: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def measurer(self):
        """Function from a text to (difference, log share); made once per task."""
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        packers = []
        for d in (self.good, self.bad):
            kind = zstandard.DICT_TYPE_FULLDICT if d[:4] == DICT_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
            zd = zstandard.ZstdCompressionDict(d, dict_type=kind)
            zd.precompute_compress(compression_params=params)
            packers.append(zstandard.ZstdCompressor(dict_data=zd, compression_params=params))
        good, bad = packers

        def measure(text: str | None) -> tuple[float, float]:
            data = (text or "").encode("utf-8", "surrogatepass")
            if not data:
                return 0.0, 0.0
            g = b = 0
            for i in range(0, len(data), BLOCK):
                block = data[i:i + BLOCK]
                g += len(good.compress(block))
                b += len(bad.compress(block))
            return (b - g) / (b + g), math.log((b + g) / 2 / len(data))
        return measure

    def probability(self, measured: tuple[float, float]) -> float:
        z = self.weight[2] + sum(w * (x - m) / s for w, x, m, s in zip(self.weight, measured, self.mean, self.scale, strict=False))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; too little text to train one serves as raw content itself."""
    samples = [t.encode("utf-8", "surrogatepass")[i:i + BLOCK]
               for t in texts for i in range(0, len(t.encode("utf-8", "surrogatepass")), BLOCK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICT_BYTES:] or b"\n"


def _logistic(x: np.ndarray, y: np.ndarray, weight: float = 1e-3) -> np.ndarray:
    """Coefficients and offset by Newton's method; rows weigh so that both labels count
    the same, and a light penalty keeps separable data finite."""
    X = np.column_stack([x, np.ones(len(x))])
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, penalty = np.zeros(X.shape[1]), weight * np.array([1.0] * x.shape[1] + [1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        step = np.linalg.solve((X * (share * p * (1 - p))[:, None]).T @ X + np.diag(penalty), X.T @ (share * (p - y)) + penalty * w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(doc_id, parts: int, rest: int):
    """Boolean column: crc32 of the id as text leaves ``rest`` modulo ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        train=None) -> Model:
    """Fit on labelled rows where ``train`` (a condition on the id column of ``labels``) holds.

    At most ``FIT_ROWS`` rows for each label, the first by a hash of the id, are taken;
    each has at most ``FIT_CHARS`` characters. Rows with a null label, id or text, or
    whose label isn't 0 or 1, train nothing; one label alone or none gives a model that
    answers the share of label 1 for every text. Of the texts of a repeated id the least counts.
    """
    marked = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
              .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()))
    if train is not None:
        marked = marked.where(train(F.col("_id")))
    marked = marked.groupBy("_id").agg(F.max("_y").alias("_y"))
    # Ids only, at most FIT_ROWS of each label: small enough to send to every task.
    few = [marked.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(
        F.length("_text").between(1, FIT_CHARS))
    # Bounded by 2 * FIT_ROWS * FIT_CHARS: one text of each id, the same one in every run.
    rows = (texts.join(F.broadcast(few[0].unionAll(few[1])), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
            .select("_id", "_y", "_text").collect())
    rows.sort(key=lambda r: r["_id"])
    bad, good = ([r["_text"] for r in rows if r["_y"] == y] for y in (0, 1))
    share = (len(good) + 1) / (len(good) + len(bad) + 2)
    if not good or not bad:
        return Model(b"\n", b"\n", weight=(0.0, 0.0, math.log(share / (1 - share))))
    # Two of three rows train the dictionaries, the third fits the curve.
    first = Model(_dictionary([t for i, t in enumerate(good) if i % 3 != 2]),
                  _dictionary([t for i, t in enumerate(bad) if i % 3 != 2]))
    measure, cal_good, cal_bad = first.measurer(), good[2::3] or good, bad[2::3] or bad
    x = np.array([measure(t) for t in cal_good + cal_bad])
    y = np.array([1.0] * len(cal_good) + [0.0] * len(cal_bad))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return replace(first, mean=tuple(mean), scale=tuple(scale), weight=tuple(_logistic((x - mean) / scale, y)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, difference`` for every row, each scored by its whole text.

    Null and empty texts measure (0, 0). Null or repeated ids and repeated rows keep their own
    results; an empty table gives no rows; other columns are ignored. One scan, no
    shuffle; the model (two dictionaries of ``DICT_BYTES``) goes with the tasks.
    """
    def make():
        measure = model.measurer()

        def fn(doc_id, text) -> Iterator[tuple]:
            measured = measure(text)
            yield doc_id, model.probability(measured), measured[0]
        return fn

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"{id_col} {kind}, score double, difference double", make)
