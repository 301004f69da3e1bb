"""A partitioned source that tracks its own offsets (S9, E8, G13, G18): rows of Parquet files.

``spark.readStream.format("tw_offsets")`` over the files of a folder, or one file, in the
order of their names; files added later must sort after those that are there. The offset is
the number of rows given out. The driver reads footers only, deals a micro-batch's rows to
tasks of at most ``rowsPerTask``, and each task reads its own range of rows. Spark logs the
offsets before a batch and hands them back after a failure, and a range of rows is always
the same rows, so every row comes exactly once (the reference re-reads from its last
snapshot and may repeat; this keeps the intended contract).

Options: ``path``; ``rowsPerBatch``, the most a micro-batch takes (admission); ``rowsPerTask``; ``columns``,
comma-separated; ``startingOffset``, for a new query; ``progress``, a folder that outlives the query.
Spark asks a Python source for its newest offset without saying where the query stands, so
the end of the batch planned last is kept there, one small file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import IntegerType, LongType

from tidewater import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class RowRange(InputPartition):
    """Rows ``lo`` to ``hi`` (exclusive) of a file, counted from 0; ``offset`` is the first one's offset."""

    path: str
    lo: int
    hi: int
    offset: int


def table_files(path: str) -> list[str]:
    fs, root = files.open_fs(path)
    found = files.names(fs, root, recursive=True) if not files.exists(fs, root) or fs.get_file_info(root).type.name == "Directory" else [root]
    return [p for p in found if p.endswith(".parquet") and not any(x[:1] in "_." for x in p[len(root):].split("/") if x)]


def read_range(path: str, lo: int, hi: int, columns: list[str], fs_of: str) -> Iterator[pa.RecordBatch]:
    """Rows ``lo`` to ``hi`` of a Parquet file; only the row groups that hold them are read."""
    fs, _ = files.open_fs(fs_of)
    with fs.open_input_file(path) as f:
        file, at = pq.ParquetFile(f), 0
        for g in range(file.metadata.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            if at < hi and at + n > lo:
                seen = at
                for batch in file.iter_batches(row_groups=[g], columns=columns):
                    first, last = max(lo - seen, 0), min(hi - seen, batch.num_rows)
                    if first < last:
                        yield batch.slice(first, last - first)
                    seen += batch.num_rows
            at += n


class OffsetReader(DataSourceStreamReader):
    def __init__(self, options: dict, columns: list[str]):
        get = {k.lower(): v for k, v in options.items()}.get
        self.path, self.columns = options["path"], columns
        self.per_batch, self.per_task = int(get("rowsperbatch", 1 << 24)), int(get("rowspertask", 1 << 20))
        self.start, self.progress = int(get("startingoffset", 0)), get("progress")
        self.rows: dict[str, int] = {}
        self.planned: int | None = None

    def _progress(self) -> tuple:
        fs, root = files.open_fs(self.progress)
        return fs, f"{root}/planned.json"

    def initialOffset(self) -> dict:
        return {"row": self.start}

    def _files(self) -> list[tuple[str, int]]:
        """(file, rows) in order; a footer is read once."""
        fs, _ = files.open_fs(self.path)
        out = []
        for p in table_files(self.path):
            if p not in self.rows:
                with fs.open_input_file(p) as f:
                    self.rows[p] = pq.read_metadata(f).num_rows
            out.append((p, self.rows[p]))
        return out

    def latestOffset(self) -> dict:
        if self.planned is None:
            self.planned = files.read_json(*self._progress(), {"row": self.start})["row"] if self.progress else self.start
        return {"row": max(self.planned, min(sum(n for _, n in self._files()), self.planned + self.per_batch))}

    def partitions(self, start: dict, end: dict) -> list[RowRange]:
        lo, hi = start["row"], end["row"]
        if hi < lo:
            raise ValueError(f"the query stands at row {lo}, the source at {hi}: its progress folder is missing or of another query")
        if self.planned is None or hi > self.planned:
            self.planned = hi
            if self.progress:
                files.write_json(*self._progress(), {"row": hi})
        out, first = [], 0
        for path, n in self._files():
            a, b = max(lo - first, 0), min(hi - first, n)
            out += [RowRange(path, x, min(x + self.per_task, b), first + x) for x in range(a, b, self.per_task)]
            first += n
        return out

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        context = TaskContext.get()
        task, offset = context.partitionId() if context else 0, partition.offset
        for batch in read_range(partition.path, partition.lo, partition.hi, self.columns, self.path):
            n = batch.num_rows
            numbers = pa.array(range(offset, offset + n), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, numbers, pa.array([task] * n, pa.int32())],
                                             names=[*self.columns, "offset", "task"])
            offset += n


class OffsetTrackedSource(DataSource):
    """The columns of the files, then ``offset`` (of each row) and ``task`` (that read it)."""

    @classmethod
    def name(cls) -> str:
        return "tw_offsets"

    def _arrow(self) -> pa.Schema:
        fs, _ = files.open_fs(self.options["path"])
        with fs.open_input_file(table_files(self.options["path"])[0]) as f:
            found = pq.read_schema(f)
        chosen = self.options.get("columns")
        return pa.schema([found.field(c.strip()) for c in chosen.split(",")]) if chosen else found

    def schema(self):
        return from_arrow_schema(self._arrow()).add("offset", LongType()).add("task", IntegerType())

    def streamReader(self, schema):
        return OffsetReader(self.options, self._arrow().names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OffsetTrackedSource)
