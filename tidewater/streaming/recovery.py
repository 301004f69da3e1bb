"""Checkpointing, restart policies and exactly-once output.

A query restarted from the same ``checkpointLocation`` resumes from the last
committed offsets and state; with an idempotent sink that is exactly once.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


@dataclass
class JobConfig:
    """Checkpoint settings of a streaming job.

    How the reference's settings map onto Structured Streaming:

    * checkpoint every N ms -> ``interval``: each micro-batch commits its
      offsets and state, so the trigger interval is the checkpoint interval;
    * minimum pause between checkpoints, one concurrent checkpoint -> implied:
      micro-batches run one after another, never overlapping;
    * tolerated checkpoint failures / restart strategy -> :class:`RestartPolicy`
      with :func:`run_with_restart`;
    * retain on cancel -> the checkpoint folder (shared storage) survives
      ``stop()``; a restart with the same folder resumes;
    * exactly once -> replayable source + idempotent sink (:class:`IdempotentBatchSink`);
    * bounded input (BATCH mode) -> ``available_now=True``.
    """
    checkpoint_location: str
    interval: str = "1 second"
    available_now: bool = False
    options: dict = field(default_factory=dict)

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        w = writer.option("checkpointLocation", self.checkpoint_location)
        for k, v in self.options.items():
            w = w.option(k, v)
        return w.trigger(availableNow=True) if self.available_now else w.trigger(processingTime=self.interval)


@dataclass
class RestartPolicy:
    """``fixed_delay`` (attempts, delay), ``failure_rate`` (max failures per
    interval, delay) or ``none`` (E14)."""
    kind: str = "fixed_delay"
    attempts: int = 3
    delay_seconds: float = 5.0
    max_failures: int = 3
    interval_seconds: float = 60.0

    @staticmethod
    def none() -> "RestartPolicy":
        return RestartPolicy(kind="none", attempts=0)

    @staticmethod
    def fixed_delay(attempts: int, delay_seconds: float) -> "RestartPolicy":
        return RestartPolicy(kind="fixed_delay", attempts=attempts, delay_seconds=delay_seconds)

    @staticmethod
    def failure_rate(max_failures: int, interval_seconds: float, delay_seconds: float) -> "RestartPolicy":
        return RestartPolicy(kind="failure_rate", max_failures=max_failures,
                             interval_seconds=interval_seconds, delay_seconds=delay_seconds)


def run_with_restart(start: Callable[[], StreamingQuery], policy: RestartPolicy,
                     timeout: float | None = None, sleep=time.sleep, clock=time.monotonic) -> tuple[StreamingQuery, int]:
    """Run ``start()`` (which must restart the *same* query from its checkpoint)
    until it ends cleanly; on failure restart per ``policy``. A query that still runs
    after ``timeout`` seconds is stopped and ``TimeoutError`` is raised.
    Returns the last query and the number of restarts."""
    restarts = 0
    failures: deque[float] = deque()
    while True:
        q = start()
        try:
            if timeout is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout):
                q.stop()
                raise TimeoutError(f"the query still ran after {timeout} s")
            return q, restarts
        except StreamingQueryException:
            now = clock()
            failures.append(now)
            if policy.kind == "none":
                raise
            if policy.kind == "fixed_delay" and restarts >= policy.attempts:
                raise
            if policy.kind == "failure_rate":
                while failures and now - failures[0] > policy.interval_seconds:
                    failures.popleft()
                if len(failures) > policy.max_failures:
                    raise
            restarts += 1
            sleep(policy.delay_seconds)


def first_read(read):
    """``read()``, or None if nothing was ever written there. Any other error is raised:
    state that can't be read must not pass for a fresh start."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class IdempotentBatchSink:
    """Exactly-once output for ``foreachBatch`` (K8).

    Each micro-batch is written to ``path/batch=<id>`` with overwrite, so a
    batch replayed after a failure replaces its earlier partial output instead
    of duplicating it. A batch counts once ``path.commits`` names it, which is written
    after its rows: a reader never sees a half-written batch. A replay takes the name
    back first.

    ``key`` names columns that identify a record within a batch; the column ``record_key``
    is then a digest of the batch id and these columns. It doesn't depend on how a replay
    orders or splits its rows, so an external system can upsert on it.
    """

    def __init__(self, path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                 key: Sequence[str] | None = None, partition_by: Sequence[str] = ()):
        self.path = path.rstrip("/")
        self.transform = transform
        self.key = list(key) if key else None
        self.partition_by = list(partition_by)

    def _mark(self, batch_id: int | None = None) -> str:
        return f"{self.path}.commits" + ("" if batch_id is None else f"/batch={batch_id}")

    def _commit(self, spark: SparkSession, batch_id: int, done: bool) -> None:
        spark.range(1).select(F.lit(done).alias("done")).write.mode("overwrite").parquet(self._mark(batch_id))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        out = self.transform(batch) if self.transform else batch
        if self.key:
            parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in self.key]
            out = out.withColumn("record_key", F.sha2(F.to_json(F.array(F.lit(str(batch_id)), *parts)), 256))
        if first_read(lambda: spark.read.parquet(self._mark(batch_id))) is not None:
            self._commit(spark, batch_id, False)
        out.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/batch={batch_id}")
        self._commit(spark, batch_id, True)

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows of the committed batches, with their ``batch``."""
        rows = spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        marks = first_read(lambda: spark.read.parquet(self._mark()))
        return rows.limit(0) if marks is None else rows.join(marks.where("done"), "batch", "left_semi")


def latest_per_key(updates: DataFrame, key: str, value: str, order=("batch",)) -> DataFrame:
    """Final value per key of an update log (last write wins)."""
    return updates.groupBy(key).agg(F.max_by(F.col(value), F.struct(*order)).alias(value))
