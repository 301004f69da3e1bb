"""Sinks (K1-K7, K9-K11): text, rolling bucketed files, JDBC, keyed upsert,
Kafka frames, catalog inserts.

Writers never funnel the upstream stage into a few tasks: a fixed number of
output files is reached with ``repartition(n)`` (an exchange of the output),
not ``coalesce(n)`` (which would shrink the parallelism of the whole stage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import formats
from tidewater.functions.text import tuple_text


def print_rows(df: DataFrame, label: str | None = None, n: int = 20) -> None:
    """``print(label)`` on a bounded frame (K1); streams use ``console_stream``."""
    (df.select(F.lit(label).alias("label"), "*") if label else df).show(n, truncate=False)


def console_stream(df: DataFrame, label: str | None = None, mode: str = "append"):
    w = (df.select(F.lit(label).alias("label"), "*") if label else df).writeStream
    return w.format("console").option("truncate", "false").outputMode(mode)


def write_tuples(df: DataFrame, cols: Sequence[str], path: str, files: int = 1) -> None:
    """``writeAsText(path).setParallelism(n)`` (K2): ``(a,b)`` lines in ``files`` files."""
    df.select(tuple_text(*cols).alias("value")).repartition(files).write.mode("overwrite").text(path)


def bucket_hourly(ts: Column | str) -> Column:
    """Default bucket of the older streaming file sink: ``yyyy-MM-dd--HH`` (K4)."""
    return F.date_format(ts, formats.HOUR_BUCKET_FORMAT)


def bucket_daily(ts: Column | str) -> Column:
    """Bucket assigner ``yyyy-MM-dd`` (K3)."""
    return F.date_format(ts, formats.DAY_BUCKET_FORMAT)


def write_rolling(df: DataFrame, line: Column, bucket: Column, path: str,
                  max_records_per_file: int = 1_000_000, fmt: str = "text",
                  time_col: str | None = None, tasks: int | None = None) -> None:
    """Rolling, bucketed row-format files (K3/K4) for a bounded frame: one folder
    per bucket (``dt=...``), files rolled by size via ``maxRecordsPerFile``.

    With ``time_col`` the rows are first range-partitioned on it: every task
    writes a contiguous run of buckets (few open files per task, all tasks in
    parallel), and a busy bucket is still split over several tasks.
    """
    if time_col is not None:
        n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, time_col)
    out = df.select(line.alias("value"), bucket.alias("dt"))
    (out.write.mode("append").partitionBy("dt").option("maxRecordsPerFile", max_records_per_file)
     .format(fmt).save(path))


def rolling_stream(df: DataFrame, line: Column, bucket: Column, path: str, checkpoint: str,
                   roll_interval: str = "15 minutes", max_records_per_file: int = 1_000_000):
    """Streaming rolling file sink (K3/K4): a new file per bucket each trigger
    (trigger interval = roll interval), exactly once through the sink's commit log."""
    out = df.select(line.alias("value"), bucket.alias("dt"))
    return (out.writeStream.format("text").partitionBy("dt").option("path", path)
            .option("checkpointLocation", checkpoint).option("maxRecordsPerFile", max_records_per_file)
            .trigger(processingTime=roll_interval))


def read_rolling(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("dt", T.StringType())])
    return spark.read.schema(schema).format("text").load(path)


def jdbc_append(df: DataFrame, url: str, table: str, props: dict | None = None, batch_size: int = 1000) -> None:
    """JDBC insert (K5): batched inserts from every task; keys generated by the DB."""
    opts = {"batchsize": str(batch_size), **(props or {})}
    df.write.mode("append").jdbc(url, table, properties=opts)


def create_table(df: DataFrame, name: str, path: str) -> None:
    """Catalog table with an explicit location in the shared folder."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def insert_select(spark: SparkSession, target: str, select_sql: str) -> None:
    """``INSERT INTO target SELECT ...`` (K10); appending a table to itself doubles it."""
    spark.sql(f"INSERT INTO {target} {select_sql}")
