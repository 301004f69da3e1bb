"""Record formats: CSV lines, JSON rows, Kafka-shaped frames.

The Kafka connector jar is not on this classpath; these helpers build and read
the exact frame Spark's Kafka source produces (``key``/``value`` binary plus
``topic``, ``partition``, ``offset``, ``timestamp``), so the same decode runs
on ``readStream.format("kafka")`` output unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


# Timestamps keep microseconds through JSON (Spark's default pattern stops at millis).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json(c: Column) -> Column:
    return F.to_json(c, JSON_OPTIONS)


def from_json(c: Column, schema) -> Column:
    return F.from_json(c, schema, JSON_OPTIONS)


def parse_csv(line: Column | str, fields: Sequence[tuple[str, str]], sep: str = ",",
              strict: bool = True) -> list[Column]:
    """Split a delimited line into typed columns.

    ``strict`` casts with ANSI semantics, so a bad number fails the job as in
    the reference; ``strict=False`` yields null instead (``try_cast``).
    """
    line = F.col(line) if isinstance(line, str) else line
    parts = F.split(line, sep)
    out = []
    for i, (name, typ) in enumerate(fields):
        raw = F.get(parts, i)
        out.append((raw.cast(typ) if strict else raw.try_cast(typ)).alias(name))
    return out


def row_json(df: DataFrame, cols: Sequence[str] | None = None, sort_keys: bool = True) -> Column:
    """Row -> JSON text. The reference's serializer orders fields by name and
    omits nulls; ``to_json`` omits nulls, so sorting the struct is enough (P14)."""
    cols = list(cols or df.columns)
    if sort_keys:
        cols = sorted(cols)
    return to_json(F.struct(*[F.col(c) for c in cols]))


def kafka_frame(df: DataFrame, key: Column | None, value: Column, topic: str) -> DataFrame:
    """Producer side (K7): the ``(topic, key, value)`` frame a Kafka writer takes."""
    k = key.cast("string").cast("binary") if key is not None else F.lit(None).cast("binary")
    return df.select(F.lit(topic).alias("topic"), k.alias("key"), value.cast("binary").alias("value"))


def as_consumed(frame: DataFrame) -> DataFrame:
    """Give a produced frame the consumer-side columns (partition, offset, timestamp).

    Stands in for the broker in tests: partition = Spark task, offset =
    position inside it (``monotonically_increasing_id`` is increasing per task).
    """
    return frame.select(
        "key", "value", "topic",
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"))


def decode_value(frame: DataFrame, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Consumer side (S5/S6): ``value`` bytes -> string -> JSON columns."""
    parsed = from_json(F.col("value").cast("string"), schema)
    return frame.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


def kafka_writer_options(bootstrap: str, topic: str) -> dict:
    """Options for ``df.write.format("kafka")`` / ``writeStream.format("kafka")``.

    Spark's writer delivers at least once and opens no transactions; for exactly once,
    write keyed records that the consumer upserts."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def kafka_reader_options(bootstrap: str, topic: str, starting: str = "latest",
                         group: str | None = None) -> dict:
    """Options for ``readStream.format("kafka")``: topic, start position
    (``latest``/``earliest``), partition discovery is built in."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if group:
        opts["kafka.group.id"] = group
    return opts
