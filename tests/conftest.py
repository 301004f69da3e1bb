import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TW_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tw-test-", dir="/tmp")


def stream_files(spark, rows_per_batch, schema, path):
    """Write one parquet file per batch so a file stream sees them as micro-batches."""
    for i, rows in enumerate(rows_per_batch):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/b{i:04d}")
    return path


def run_available_now(df, name, mode="append", checkpoint=None):
    """Drive a streaming frame to completion over the files present; return rows."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or tempfile.mkdtemp(prefix="tw-ckpt-", dir="/tmp"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name).collect()
