"""Tables as streams: rows written as they would arrive, then read back by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.streaming.late_windows import END_OF_INPUT
from tidewater.streaming.recovery import IdempotentBatchSink

#: A stream has at least this many slices, so that state is carried between micro-batches.
MIN_SLICES = 4
ROWS_PER_SLICE = 1_000_000_000
ROWS_PER_FILE = 250_000

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_slices(df: DataFrame, path: str, seq: str, rows_per_slice: int = ROWS_PER_SLICE,
                 rows_per_file: int = ROWS_PER_FILE, min_slices: int = MIN_SLICES) -> int:
    """Write ``df`` as it would arrive: consecutive ranges of ``seq``, one after the other.

    The number of slices (``min_slices`` at least) and of files in a slice follow from the number of rows. Returns the
    files of a slice, the same for all: read with ``maxFilesPerTrigger`` at that, a micro-batch is one slice.
    """
    lo, hi, n = df.agg(F.min(seq), F.max(seq), F.count(F.lit(1))).first()
    if n == 0:
        df.write.mode("overwrite").parquet(f"{path}/slice=000000")
        return 1
    slices = max(min_slices, -(-n // rows_per_slice))
    files = max(1, -(-n // (slices * rows_per_file)))
    step = (hi - lo) // slices + 1
    for i in range(slices):
        part = df.where((F.col(seq) >= lo + i * step) & (F.col(seq) < lo + (i + 1) * step))
        to = f"{path}/slice={i:06d}"
        part.repartition(files).write.mode("overwrite").parquet(to)
        # a slice with few rows has fewer files: empty ones keep a micro-batch within one slice
        for _ in range(files - len(df.sparkSession.read.schema(df.schema).parquet(to).inputFiles())):
            part.limit(0).write.mode("append").parquet(to)
    return files


def arriving(spark: SparkSession, rows: DataFrame, seq: str, name: str, min_slices: int = MIN_SLICES,
             ends: str | None = None, rows_per_file: int = ROWS_PER_FILE) -> Callable[[], DataFrame]:
    """``rows`` staged in order of ``seq``; every call gives a stream over all of them.

    ``ends`` names the event-time column of a bounded input: after the last slice comes one
    row with :data:`END_OF_INPUT` there and nulls elsewhere, which moves the watermark past all windows."""
    path = scratch_path(spark, f"{name}-in")
    files = write_slices(rows, path, seq, rows_per_file=rows_per_file, min_slices=min_slices)
    if ends is not None:
        last = spark.range(1).select(*[(F.lit(END_OF_INPUT) if f.name == ends else F.lit(None)).cast(f.dataType).alias(f.name)
                                       for f in rows.schema])
        last.write.mode("overwrite").parquet(f"{path}/slice=end")
    return lambda: (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
                    .parquet(f"{path}/*"))


def until_end(watermarked: DataFrame, event_time: str) -> DataFrame:
    """The rows before :data:`END_OF_INPUT`. The condition names the event time, so Spark keeps it
    above the watermark, where the last row has counted already."""
    return watermarked.where(F.col(event_time) < F.lit(END_OF_INPUT).cast("timestamp"))


def run_batches(spark: SparkSession, stream: DataFrame, handler: Callable[[DataFrame, int], None],
                name: str, mode: str = "append") -> None:
    """Drive ``stream`` into ``handler`` until all that has arrived is read."""
    # Read when the query starts: keyed state needs RocksDB, and every partition keeps a
    # state store that commits once a batch, so one for each core is enough.
    parts = min(int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism)
    before = {k: spark.conf.get(k) for k in (STATE_PROVIDER, PARTITIONS)}
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    spark.conf.set(PARTITIONS, str(parts))
    try:
        q = (stream.writeStream.outputMode(mode).foreachBatch(handler)
             .option("checkpointLocation", scratch_path(spark, f"{name}-ckpt")).trigger(availableNow=True).start())
    finally:  # the query has its own copy of the settings from its start on
        for k, v in before.items():
            spark.conf.set(k, v)
    q.awaitTermination()


def run_stream(spark: SparkSession, rows: DataFrame, seq: str, make: Callable[[DataFrame], DataFrame],
               name: str, **staging) -> DataFrame:
    """What ``make(stream)`` puts out over ``rows`` arriving in order of ``seq`` (see :func:`arriving`)."""
    sink = IdempotentBatchSink(scratch_path(spark, f"{name}-out"))
    run_batches(spark, make(arriving(spark, rows, seq, name, **staging)()), sink, name)
    return sink.read(spark).drop("batch")
