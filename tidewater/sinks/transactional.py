"""Transactional file sinks (K3, K4, K8): a Python data source with task commit messages.

Tasks write in-progress files under ``<path>/_staging`` and tell the driver their names. The
driver commits a micro-batch in three steps: one manifest with all its files, moved into
place (from here on the batch counts); every file renamed to its final name; the batch
noted as the last one of its writer. A crash before the manifest leaves nothing but staged
files, a crash after it is finished by the next start, and a batch that Spark replays
although it was committed only has its second copy thrown away: each batch counts once.

Two formats: ``tw_committed`` (Parquet) and ``tw_rolling`` (lines of text, rolled by size, age and
idle time). Options:

* ``path``: a folder on a file system that driver and executors share;
* ``transactionalId``: names the writer; a new query with a new checkpoint needs a new one, since
  its batches count from 0 again;
* ``batchId`` (batch writes): the micro-batch that a write stands for, see :func:`batch_sink`;
* ``bucketColumn``: a string column that names the sub-folder of a row (``bucketPrefix`` before it);
* ``prefix``, ``suffix`` of the files; ``maxBytes``, ``maxAgeSeconds``, ``maxIdleSeconds``: when a file is closed
  and the next begun; ``maxOpenFiles``: buckets a task keeps open, the one idle longest goes first.
"""

from __future__ import annotations

import sys
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from tidewater import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STAGING, COMMITS = "_staging", "_commits"
#: Rows written between two looks at a file's size and age.
SLICE_ROWS = 1024


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task: (staged path, bucket folder, task partition, number, rows)."""

    files: list[tuple[str, str, int, int, int]]


class LineFile:
    """Rows of one string column as lines; a null is an empty line."""

    def __init__(self, out, schema: pa.Schema):
        self.out, self.rows = out, 0

    def write(self, batch: pa.RecordBatch) -> None:
        self.out.write("".join(f"{v or ''}\n" for v in batch.column(0).to_pylist()).encode("utf-8", "surrogatepass"))
        self.rows += batch.num_rows

    def close(self) -> None:
        self.out.close()


class ParquetFile:
    def __init__(self, out, schema: pa.Schema):
        self.out, self.rows = out, 0
        self.writer = pq.ParquetWriter(out, schema, compression="zstd")

    def write(self, batch: pa.RecordBatch) -> None:
        self.writer.write_batch(batch)
        self.rows += batch.num_rows

    def close(self) -> None:
        self.writer.close()
        self.out.close()


class RollingFiles:
    """The open files of one task, one for each bucket, and when they roll.

    ``make(path)`` opens a file; a file is closed at the first row batch that finds it at
    ``max_bytes``, older than ``max_age`` or unwritten for ``max_idle`` seconds."""

    def __init__(self, make: Callable[[str], LineFile | ParquetFile], name: Callable[[int], str], max_bytes: float, max_age: float,
                 max_idle: float, max_open: int, clock: Callable[[], float] = time.monotonic):
        self.make, self.name, self.clock = make, name, clock
        self.max_bytes, self.max_age, self.max_idle, self.max_open = max_bytes, max_age, max_idle, max_open
        self.open: dict[str, list] = {}  # bucket -> [file, path, opened, written, number]
        self.closed: list[tuple[str, str, int, int]] = []  # (path, bucket, number, rows)
        self.count = 0

    def _close(self, bucket: str) -> None:
        f, path, _, _, number = self.open.pop(bucket)
        f.close()
        self.closed.append((path, bucket, number, f.rows))

    def roll(self) -> None:
        now = self.clock()
        for bucket, (f, _, opened, written, _) in list(self.open.items()):
            if f.out.tell() >= self.max_bytes or now - opened >= self.max_age or now - written >= self.max_idle:
                self._close(bucket)

    def write(self, bucket: str, batch: pa.RecordBatch) -> None:
        self.roll()
        if bucket not in self.open:
            if len(self.open) >= self.max_open:
                self._close(min(self.open, key=lambda b: self.open[b][3]))
            path = self.name(self.count)
            self.open[bucket] = [self.make(path), path, self.clock(), self.clock(), self.count]
            self.count += 1
        self.open[bucket][0].write(batch)
        self.open[bucket][3] = self.clock()

    def finish(self) -> list[tuple[str, str, int, int]]:
        for bucket in list(self.open):
            self._close(bucket)
        return self.closed


class FileTransaction:
    """Commits on the driver. ``stages`` are the file systems' paths, as the tasks named them."""

    def __init__(self, path: str, writer: str, prefix: str, suffix: str):
        self.fs, self.root = files.open_fs(path)
        self.writer, self.prefix, self.suffix = quote(writer, safe="-_"), prefix, suffix
        self.pending, self.last = (f"{self.root}/{COMMITS}/{self.writer}.{kind}.json" for kind in ("pending", "last"))

    def last_batch(self) -> int:
        return files.read_json(self.fs, self.last, {"batch": -1})["batch"]

    def recover(self) -> None:
        """Finish the batch that was committed but not renamed to its end."""
        manifest = files.read_json(self.fs, self.pending)
        if manifest is None:
            return
        for staged, final in manifest["files"]:
            if files.exists(self.fs, staged):
                self.fs.create_dir(final.rpartition("/")[0], recursive=True)
                self.fs.move(staged, final)
            elif not files.exists(self.fs, final):
                raise FileNotFoundError(f"committed file {final} is neither staged nor in place")
        files.write_json(self.fs, self.last, {"batch": manifest["batch"]})
        files.delete(self.fs, self.pending)

    def commit(self, messages: list[Staged | None], batch: int, tag: str | None = None) -> None:
        self.recover()
        if batch <= self.last_batch():
            return self.abort(messages)  # a replay of a batch that counts already
        moves = [(staged, "/".join(x for x in (self.root, bucket, f"{self.prefix}-{tag or batch}-{part}-{number}{self.suffix}") if x))
                 for m in messages if m is not None for staged, bucket, part, number, _ in m.files]
        files.write_json(self.fs, self.pending, {"batch": batch, "files": moves})
        self.recover()

    def abort(self, messages: list[Staged | None]) -> None:
        """Throw staged files away, but for those of a commit under way: Spark aborts a batch
        whose commit failed, even if its manifest was in place by then."""
        manifest = files.read_json(self.fs, self.pending) or {"files": []}
        counted = {staged for staged, _ in manifest["files"]}
        for m in messages:
            for staged, *_ in (m.files if m is not None else []):
                if staged not in counted:
                    files.delete(self.fs, staged)


class _Writer:
    """What the batch and the stream writer share."""

    file_type, default_suffix = ParquetFile, ".parquet"

    def __init__(self, options: dict):
        get = {k.lower(): v for k, v in options.items()}.get
        self.path, self.bucket_column, self.bucket_prefix = options["path"], get("bucketcolumn"), get("bucketprefix", "")
        self.prefix, self.suffix = get("prefix", "part"), get("suffix", self.default_suffix)
        self.id = get("transactionalid", "default")
        self.batch = int(get("batchid")) if get("batchid") else None
        self.limits = (float(get("maxbytes", 1 << 30)), float(get("maxageseconds", "inf")), float(get("maxidleseconds", "inf")),
                       int(get("maxopenfiles", 64)))

    def _transaction(self) -> FileTransaction:
        return FileTransaction(self.path, self.id, self.prefix, self.suffix)

    def _buckets(self, batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[str, pa.RecordBatch]]:
        rows = batch.select(columns)
        if self.bucket_column is None:
            yield "", rows
            return
        keys = batch.column(batch.schema.get_field_index(self.bucket_column))
        for key in pc.unique(keys).to_pylist():
            mask = pc.is_null(keys) if key is None else pc.equal(keys, key)
            name = "__HIVE_DEFAULT_PARTITION__" if key is None else quote(str(key), safe="-_. ")
            yield self.bucket_prefix + name, rows.filter(mask)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, root = files.open_fs(self.path)
        staging, token, out = f"{root}/{STAGING}", uuid.uuid4().hex, None

        def make(path):
            return self.file_type(fs.open_output_stream(path), columns)
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(staging, recursive=True)
                columns = pa.schema([f for f in batch.schema if f.name != self.bucket_column])
                out = RollingFiles(make, lambda n: f"{staging}/{self.prefix}-{part}-{token}-{n}{self.suffix}.inprogress", *self.limits)
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                for bucket, rows in self._buckets(batch.slice(lo, SLICE_ROWS), columns.names):
                    out.write(bucket, rows)
        done = [] if out is None else out.finish()
        return Staged([(path, bucket, part, number, n) for path, bucket, number, n in done])


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._transaction().commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._transaction().abort(messages)


class _BatchWriter(_Writer, DataSourceArrowWriter):
    """One write is one transaction: batch ``batchId`` of its writer, or one with a name of its own."""

    def commit(self, messages) -> None:
        if self.batch is not None:
            return self._transaction().commit(messages, self.batch)
        self.id = f"write-{uuid.uuid4().hex}"
        t = self._transaction()
        t.commit(messages, 0, tag=self.id)
        files.delete(t.fs, t.last)  # nothing will replay it

    def abort(self, messages) -> None:
        self._transaction().abort(messages)


class _LineStreamWriter(_StreamWriter):
    file_type, default_suffix = LineFile, ".txt"


class _LineBatchWriter(_BatchWriter):
    file_type, default_suffix = LineFile, ".txt"


class CommittedFiles(DataSource):
    """``writeStream.format("tw_committed")`` and ``write.format("tw_committed").mode("append")``."""

    stream_writer, batch_writer = _StreamWriter, _BatchWriter

    @classmethod
    def name(cls) -> str:
        return "tw_committed"

    def streamWriter(self, schema, overwrite):
        return self.stream_writer(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("transactional files are appended to; use mode('append')")
        return self.batch_writer(self.options)


class RollingLines(CommittedFiles):
    """Lines of text: one string column, and the bucket column if there is one."""

    stream_writer, batch_writer = _LineStreamWriter, _LineBatchWriter

    @classmethod
    def name(cls) -> str:
        return "tw_rolling"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CommittedFiles)
    spark.dataSource.register(RollingLines)


def batch_sink(path: str, fmt: str = "tw_committed", **options: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler with the same commits by batch id: for output modes that a Python
    sink does not take (updates of an aggregate)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("append").options(path=path, batchId=str(batch_id), **options).save()
    return write


def recover(path: str, writer: str = "default", prefix: str = "part", suffix: str = ".parquet") -> None:
    """Finish what a stopped writer committed, before reading ``path`` without starting it again."""
    FileTransaction(path, writer, prefix, suffix).recover()


def clean_staging(path: str) -> int:
    """Remove the staged files of dead attempts; call it while no writer runs. Committed files stay."""
    fs, root = files.open_fs(path)
    waiting = {s for m in files.names(fs, f"{root}/{COMMITS}") if m.endswith(".pending.json") for s, _ in files.read_json(fs, m)["files"]}
    dead = [p for p in files.names(fs, f"{root}/{STAGING}") if p not in waiting]
    for p in dead:
        fs.delete_file(p)
    return len(dead)
