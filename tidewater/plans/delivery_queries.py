"""Streams with sources and sinks of their own: offsets over a table's files (S9, E8, G18), exactly-once
delivery (K8, M4) and rolling files (K3, K4). Each is stopped by a failure on its way and run on."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater import files
from tidewater.functions.text import java_split, pair_text
from tidewater.plans.arrival import arriving
from tidewater.plans.registry import query, table
from tidewater.session import scratch_path
from tidewater.sinks import basic, transactional
from tidewater.sources import offset_source
from tidewater.streaming import jobs
from tidewater.streaming.recovery import RestartPolicy, run_with_restart

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _CrashingTransaction(transactional.FileTransaction):
    """Fails twice, as a job would that dies there: once when all tasks of batch 1 are done and
    nothing is committed, once when batch 2 is committed and its files are not in place."""

    def _once(self, what: str) -> None:
        mark = f"{self.root}/{transactional.COMMITS}/{what}.json"
        if not files.exists(self.fs, mark):
            files.write_json(self.fs, mark, {})
            raise RuntimeError(what)

    def commit(self, messages, batch: int, tag: str | None = None) -> None:
        if batch == 1:
            self._once("died before the commit")
        super().commit(messages, batch, tag)

    def recover(self) -> None:
        if (files.read_json(self.fs, self.pending) or {}).get("batch") == 2:
            self._once("died after the commit")
        super().recover()


def _crashing(base: type) -> type:
    class Writer(base):
        def _transaction(self):
            return _CrashingTransaction(self.path, self.id, self.prefix, self.suffix)
    return Writer


class CrashingFiles(transactional.CommittedFiles):
    stream_writer, batch_writer = _crashing(transactional._StreamWriter), _crashing(transactional._BatchWriter)

    @classmethod
    def name(cls) -> str:
        return "tw_committed_crashing"


class CrashingLines(transactional.RollingLines):
    stream_writer, batch_writer = _crashing(transactional._LineStreamWriter), _crashing(transactional._LineBatchWriter)

    @classmethod
    def name(cls) -> str:
        return "tw_rolling_crashing"


#: Two failures are built in; the third attempt must come through.
RESTARTS = RestartPolicy.fixed_delay(2, 0.1)


def _until_done(start) -> None:
    _, restarts = run_with_restart(start, RESTARTS)
    if restarts != 2:
        raise RuntimeError(f"{restarts} restarts instead of the 2 that were provoked")


#: Texts are long: a file of these is a task's work.
DOCUMENTS_PER_FILE = 10_000


@query("etl_exactly_once", """
with b as (select min(doc_id) as lo, (max(doc_id) - min(doc_id)) // 4 + 1 as step from documents),
w as (select (doc_id - lo) // step as slice, unnest(string_split(rtrim(text, ' '), ' ')) as word
      from documents, b where not (text <> '' and rtrim(text, ' ') = '')),
c as (select slice, word, count(*) as n from w group by slice, word)
select word, word || ':' || cast(sum(n) over (partition by word order by slice) as varchar) as line from c
""")
def etl_exactly_once(spark, sf):
    """Word count from topic to topic (M4): documents arrive in four slices, every slice's changed
    counts go out as ``word:count`` through transactional commits. The job dies between its
    tasks and a commit, and between a commit and its files, and restarts from its checkpoint;
    no update is lost or told twice."""
    spark.dataSource.register(CrashingFiles)
    lines = arriving(spark, table(spark, sf, "documents").select("doc_id", F.col("text").alias("value")), "doc_id", "etl",
                     rows_per_file=DOCUMENTS_PER_FILE)
    out, checkpoint = scratch_path(spark, "etl-out"), scratch_path(spark, "etl-ckpt")

    def start():
        counts = jobs.word_counts_stream(lines())
        told = counts.select("word", pair_text("word", "n", ":").alias("line"))
        return (told.writeStream.outputMode("update").foreachBatch(transactional.batch_sink(out, "tw_committed_crashing"))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _until_done(start)
    return spark.read.schema("word string, line string").parquet(out)


@query("stream_rolling_sink", """
select cast(event_id as varchar) || ':::' || event_type as value, strftime(ts, '%Y-%m-%d') as dt from events
""")
def stream_rolling_sink(spark, sf):
    """Rolling file sink (K3) as a stream: daily buckets, files rolled by size, age and idle time, with
    prefix and suffix, renamed into place at commit; two failures on the way."""
    spark.dataSource.register(CrashingLines)
    events = arriving(spark, table(spark, sf, "events").select("event_id", "event_type", "ts"), "event_id", "rolling")
    out, checkpoint = scratch_path(spark, "rolling-out"), scratch_path(spark, "rolling-ckpt")

    def start():
        rows = events().select(pair_text("event_id", "event_type", ":::").alias("value"), basic.bucket_daily(F.col("ts")).alias("dt"))
        return (rows.writeStream.format("tw_rolling_crashing").outputMode("append").trigger(availableNow=True)
                .options(path=out, checkpointLocation=checkpoint, bucketColumn="dt", bucketPrefix="dt=", prefix="prefix", suffix=".txt",
                         maxBytes=str(1 << 30), maxAgeSeconds="900", maxIdleSeconds="300").start())
    _until_done(start)
    return basic.read_rolling(spark, out)


@query("src_offset_tracked", 'select event_id, user_id, value, row_number() over () - 1 as "offset" from events')
def src_offset_tracked(spark, sf):
    """A source with offsets over the files of ``events``, admitted in eight batches, stopped after two
    of them and run on from its checkpoint; each row comes once, with its offset."""
    offset_source.register(spark)
    rows = table(spark, sf, "events").count()
    out, checkpoint, progress = (scratch_path(spark, f"offsets-{x}") for x in ("out", "ckpt", "progress"))
    died = []

    def start():
        stream = (spark.readStream.format("tw_offsets").option("path", f"{sf.rstrip('/')}/events.parquet").option("progress", progress)
                  .option("columns", "event_id,user_id,value").option("rowsPerBatch", -(-rows // 8)).option("rowsPerTask", max(1, rows // 64)).load())

        def write(batch, batch_id):
            if batch_id == 2 and not died:
                died.append(batch_id)
                raise RuntimeError("died in batch 2")
            batch.drop("task").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    for _ in range(2):
        q = start()
        try:
            q.processAllAvailable()
        except StreamingQueryException:
            continue
        finally:
            q.stop()
    return spark.read.schema("event_id long, user_id long, value double, offset long").parquet(f"{out}/batch=*")
