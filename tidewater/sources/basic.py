"""Sources (S1-S4, S7, S8, S10, S11). Explicit schemas everywhere: no inference."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("money", T.IntegerType()),
    T.StructField("create_time", T.TimestampType()),
])


def inline(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """``fromElements`` / ``fromCollection`` (S1): small literal rows."""
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, first: int, last: int, num_partitions: int | None = None) -> DataFrame:
    """``fromSequence(a, b)`` (S2): inclusive longs, generated in parallel."""
    return spark.range(first, last + 1, numPartitions=num_partitions).withColumnRenamed("id", "value")


def text(spark: SparkSession, path: str) -> DataFrame:
    """``readTextFile`` (S3): a file, a directory or ``.gz``; one row per line."""
    return spark.read.text(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded lines (S4). Files dropped into ``path`` play the socket's role;
    ``socket_stream`` is the literal counterpart for interactive use."""
    r = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``socketTextStream`` (S4) -- needs a listening server; not used in tests."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def generated_orders(ids: DataFrame, id_col: str = "id", ts: Column | None = None,
                     users: int = 3, money_mod: int = 101) -> DataFrame:
    """Order generator (S7) as a pure function of a row id, so runs repeat:
    ``order_id`` from the id, user ``id % users``, money ``(id * 37) % money_mod``."""
    i = F.col(id_col)
    return ids.select(
        F.concat(F.lit("order-"), i.cast("string")).alias("order_id"),
        F.pmod(i, F.lit(users)).cast("int").alias("user_id"),
        F.pmod(i * 37, F.lit(money_mod)).cast("int").alias("money"),
        (ts if ts is not None else F.current_timestamp()).alias("create_time"))


def random_orders(ids: DataFrame, seed: int = 42, ts: Column | None = None, users: int = 3,
                  money_mod: int = 101) -> DataFrame:
    """The generator as the reference writes it (S7): UUID order id, uniform
    user in ``[0, users)`` and money in ``[0, money_mod)``. Seeded ``rand`` is
    reproducible for a fixed partitioning; ``uuid()`` is not."""
    return ids.select(
        F.expr("uuid()").alias("order_id"),
        F.floor(F.rand(seed) * users).cast("int").alias("user_id"),
        F.floor(F.rand(seed + 1) * money_mod).cast("int").alias("money"),
        (ts if ts is not None else F.current_timestamp()).alias("create_time"))


def rate_orders(spark: SparkSession, rows_per_second: int = 2, partitions: int = 2) -> DataFrame:
    """Unbounded order stream: the rate source (S7 at 1 row/s per subtask, 2 subtasks)."""
    rate = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
            .option("numPartitions", partitions).load())
    return generated_orders(rate, "value", F.col("timestamp"))


def jdbc_table(spark: SparkSession, url: str, query: str, props: dict | None = None,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               num_partitions: int = 8) -> DataFrame:
    """One snapshot of a JDBC query (S8). With ``partition_column`` and bounds
    the read is split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("query" if partition_column is None else "dbtable",
                                                            query if partition_column is None else f"({query}) q")
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        lo, hi = bounds
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lo)
             .option("upperBound", hi).option("numPartitions", num_partitions))
    return r.load()


def jdbc_snapshots(spark: SparkSession, url: str, query: str, props: dict | None = None,
                   partition_column: str | None = None, num_partitions: int = 8):
    """Polling JDBC source (S8): the whole table re-read on every trigger.

    Returns ``(ticks, snapshot)``: a rate stream to trigger on
    and a function to call inside ``foreachBatch`` that reads the full table. With a numeric
    ``partition_column`` every poll asks for its range and reads in ``num_partitions`` tasks.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def snapshot(_batch: DataFrame, batch_id: int) -> DataFrame:
        bounds = None
        if partition_column is not None:
            ends = f"select min({partition_column}) as lo, max({partition_column}) as hi from ({query}) b"
            bounds = tuple(jdbc_table(spark, url, ends, props).first())
        split = {} if not bounds or bounds[0] is None else {
            "partition_column": partition_column, "bounds": bounds, "num_partitions": num_partitions}
        return jdbc_table(spark, url, query, props, **split).withColumn("poll", F.lit(batch_id))
    return ticks, snapshot


def poll_jdbc(spark: SparkSession, url: str, query: str, sink, checkpoint: str, interval: str = "5 seconds",
              props: dict | None = None, partition_column: str | None = None, num_partitions: int = 8):
    """Start the polling JDBC source (S8): every ``interval`` the whole result of
    ``query`` is read and handed to ``sink(snapshot, batch_id)``. Returns the
    running query."""
    ticks, snapshot = jdbc_snapshots(spark, url, query, props, partition_column, num_partitions)

    def each(batch: DataFrame, batch_id: int) -> None:
        sink(snapshot(batch, batch_id), batch_id)
    return (ticks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """External-catalog table scan."""
    return spark.table(name)


def view(df: DataFrame, name: str, columns: Sequence[str | Column] | None = None) -> DataFrame:
    """Stream/frame -> named view with selected columns (S11); returns the view."""
    src = df.select(*columns) if columns else df
    src.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
