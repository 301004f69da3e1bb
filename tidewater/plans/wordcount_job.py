"""Word count to files with an ``--output`` argument (M5).

    spark-submit tidewater/plans/wordcount_job.py --input <path> [--output <dir>] [--files N]

Reads text (one row per line) or a parquet column, counts words with the
reference's split rule and writes ``(word,count)`` lines into ``--files`` files.
Without ``--output`` the folder is ``wordcount-<epoch ms>`` under the shared
checkpoint root, as the reference suffixes its default path with the time.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import tokens
from tidewater.operators.keyed import keyed_count
from tidewater.session import checkpoint_root, configure
from tidewater.sinks.basic import write_tuples


def run(spark: SparkSession, source: str, output: str | None = None, files: int = 1,
        fmt: str = "text", column: str = "value") -> str:
    lines = (spark.read.text(source) if fmt == "text"
             else spark.read.parquet(source).select(F.col(column).alias("value")))
    counts = keyed_count(tokens(lines), "word", "n")
    out = output or f"{checkpoint_root(spark).rstrip('/')}/wordcount-{int(time.time() * 1000)}"
    write_tuples(counts, ["word", "n"], out, files)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--input", required=True)
    ap.add_argument("--output")
    ap.add_argument("--files", type=int, default=1)
    ap.add_argument("--format", choices=["text", "parquet"], default="text")
    ap.add_argument("--column", default="value")
    a = ap.parse_args(argv)
    spark = configure(SparkSession.builder.getOrCreate())
    print(run(spark, a.input, a.output, a.files, a.format, a.column))


if __name__ == "__main__":
    main()
