"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words are runs of digits, ASCII letters and non-ASCII characters. On UTF-8 bytes every
#: byte of a non-ASCII character is above 0x7F, so all else can become a space and split.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
SEPARATORS_SQL = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
U64 = np.uint64
BATCH_ROWS = 512


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` with A-Z lower-cased; null is empty."""
    return [] if text is None else text.encode().translate(_ALNUM).split()


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D), A-Z lower-cased; null is empty."""
    return [] if text is None else text.encode().translate(_LOWER).split()


def ascii_lower_col(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class HashBits:
    """A bitmap over hashes, a filter that may go to every task. It lets all members through
    and, at ``PER_MEMBER`` bits for each, few of the others; a join afterwards decides.

    Its size follows from the number of members: 2^20 bits (128 KB) at least, 2^27 (16 MB)
    at most. Beyond that, 8 million members, it lets more of the others through: results
    stay right, and what passes grows towards everything.
    """

    MIN_LOG2, MAX_LOG2, PER_MEMBER = 20, 27, 16

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, U64(len(bits) * 8 - 1)

    @classmethod
    def of(cls, df: DataFrame, col: str) -> HashBits:
        members = df.where(F.col(col).isNotNull())
        need = max(1, members.count() * cls.PER_MEMBER - 1).bit_length()
        log2 = min(cls.MAX_LOG2, max(cls.MIN_LOG2, need))
        # Buckets count from 1 and hold 32,768 positions each: at most 4,096 rows of 4 KB come back.
        at = F.pmod(F.col(col), F.lit(1 << log2)) + 1
        rows = (members.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect())
        bits = np.zeros(1 << log2 >> 3, dtype=np.uint8)
        for r in rows:
            lo = (r["b"] - 1) << 12
            bits[lo:lo + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
        return cls(bits)

    def test(self, h: np.ndarray) -> np.ndarray:
        at = (h & self.mask).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send at most ``rows`` rows at a time to Python. Spark's 10,000 suit numbers; as many
    whole texts, in the JVM and twice in the worker, are hundreds of megabytes a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def map_texts(df: DataFrame, keep: list[str], text: str, schema: str | T.StructType,
              make: Callable[[], Callable[..., Iterator[tuple]]], slice_rows: int = 256) -> DataFrame:
    """``mapInArrow`` over ``keep + [text]``: ``make()`` is called once per task and
    returns ``fn(*kept, text)`` that yields output tuples of ``schema``.

    Output leaves the worker after every ``slice_rows`` inputs, so a task holds one
    Arrow batch and the output of one slice, whatever the partition's size.
    """
    small_batches(df.sparkSession)
    df = df.select(*[F.col(c) for c in [*keep, text]])
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, slice_rows):
                part = batch.slice(lo, slice_rows)
                rows = [r for args in zip(*[c.to_pylist() for c in part.columns], strict=True) for r in fn(*args)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, out)


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, survives lost executors, and later readers prune columns."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
