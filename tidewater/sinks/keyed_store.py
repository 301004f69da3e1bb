"""A keyed store (K6, G17: ``HSET hash field value``): hash buckets, delta files, a versioned manifest.

``<path>/manifest.json`` names everything that counts: the base folder of every bucket, the deltas
written since, and the last batch. It is replaced as a whole, so a reader sees one version, and
what a stopped writer left behind is in no manifest. A batch is one delta, sorted out by bucket;
``compact`` merges deltas into the buckets they touch and leaves the other buckets' files
alone. A batch counts once: a replay, before a compaction or after it, changes nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import files

SCHEMA = "field string, value string, batch bigint, seq bigint, bucket int"


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, hash_name: str, buckets: int = 16, max_deltas: int = 8):
        self.spark, self.path, self.hash = spark, path.rstrip("/"), hash_name
        self.buckets, self.max_deltas = buckets, max_deltas
        self.fs, self.root = files.open_fs(self.path)

    def manifest(self) -> dict:
        """``buckets`` (fixed when the store begins), ``version``, ``batch``, ``base`` (bucket -> folder), ``deltas`` (folder, buckets)."""
        empty = {"buckets": self.buckets, "version": 0, "batch": -1, "base": {}, "deltas": []}
        return files.read_json(self.fs, f"{self.root}/manifest.json", empty)

    def _publish(self, manifest: dict) -> None:
        files.write_json(self.fs, f"{self.root}/manifest.json", {**manifest, "version": manifest["version"] + 1})

    def _write(self, rows: DataFrame, kind: str) -> str:
        folder = f"{kind}-{uuid.uuid4().hex[:12]}"
        rows.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        return folder

    def _read(self, folder: str, buckets: list[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{folder}")
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        """The newest row of each field: by batch, then sequence, then value."""
        newest = F.max(F.struct("batch", "seq", "value")).alias("_r")
        return rows.groupBy("bucket", "field").agg(newest).select("field", "_r.value", "_r.batch", "_r.seq", "bucket")

    def upsert(self, updates: DataFrame, field: Column | str, value: Column | str, seq: Column | str, batch_id: int) -> None:
        """Last write of ``updates`` per field, by ``seq``. Batches come in rising order of their ids, as ``foreachBatch``
        gives them; one that the store has already is skipped. Null fields are dropped, as a hash has none."""
        manifest = self.manifest()
        if batch_id <= manifest["batch"]:
            return
        f, v, s = (F.col(c) if isinstance(c, str) else c for c in (field, value, seq))
        rows = updates.select(f.cast("string").alias("field"), v.cast("string").alias("value"), F.lit(batch_id).cast("long").alias("batch"),
                              s.cast("long").alias("seq")).where("field IS NOT NULL")
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("field"), F.lit(manifest["buckets"])).cast("int"))
        folder = self._write(self._latest(rows), f"delta-{batch_id}")
        touched = sorted({int(p.rsplit("/bucket=", 1)[1].split("/")[0]) for p in files.names(self.fs, f"{self.root}/{folder}", recursive=True) if "/bucket=" in p})
        deltas = [*manifest["deltas"], {"folder": folder, "buckets": touched}] if touched else manifest["deltas"]
        self._publish({**manifest, "batch": batch_id, "deltas": deltas})
        if len(deltas) > self.max_deltas:
            self.compact()

    def compact(self) -> list[int]:
        """Merge all deltas into the buckets they touch; returns these. Folders that no manifest names any more are
        removed after the next compaction, so readers of the version before finish undisturbed."""
        manifest = self.manifest()
        touched = sorted({b for d in manifest["deltas"] for b in d["buckets"]})
        if not touched:
            return []
        folder = self._write(self._latest(self._rows(manifest, touched)), f"base-{manifest['version']}")
        base = {**manifest["base"], **{str(b): folder for b in touched}}
        old = manifest.get("retired", [])
        unused = [d["folder"] for d in manifest["deltas"]] + [f for f in set(manifest["base"].values()) if f not in base.values()]
        self._publish({**manifest, "base": base, "deltas": [], "retired": unused})
        for f in old:
            if files.exists(self.fs, f"{self.root}/{f}"):
                self.fs.delete_dir(f"{self.root}/{f}")
        return touched

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        by_folder: dict[str, list[int]] = {}
        for b, folder in manifest["base"].items():
            if buckets is None or int(b) in buckets:
                by_folder.setdefault(folder, []).append(int(b))
        parts = [self._read(folder, bs) for folder, bs in by_folder.items()]
        parts += [self._read(d["folder"], buckets) for d in manifest["deltas"]]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], SCHEMA)

    def state(self) -> DataFrame:
        """``hash, field, value``: the newest value of every field. Buckets without deltas are read as they are."""
        manifest = self.manifest()
        changed = sorted({b for d in manifest["deltas"] for b in d["buckets"]})
        still = {b: f for b, f in manifest["base"].items() if int(b) not in changed}
        rows = self._rows({**manifest, "base": still, "deltas": []})
        if changed:
            rows = rows.unionByName(self._latest(self._rows(manifest, changed)))
        return rows.select(F.lit(self.hash).alias("hash"), "field", "value")
