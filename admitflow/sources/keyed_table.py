"""A keyed Parquet table in hash buckets: a merge rewrites the buckets that its keys fall into, and no others."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import written

_BUCKET = "_bucket"


class MergeConflict(RuntimeError):
    """Another writer published the version that a merge was based on."""


class KeyedTable:
    """Rows with unique keys below ``path``: ``data/<merge>/_bucket=N`` holds the rows of bucket N as one merge left
    them, and ``manifest/<version>.json`` names, for each bucket, the merge whose files are current.

    A version is current once its manifest has its name, which it gets by a rename that doesn't overwrite. A merge
    that ends before leaves files that no manifest names, and the table as it was. Of two merges on one version the
    second fails to publish and starts anew on what the first wrote. The folder must be on a file system whose rename
    is atomic. Null is a key value like any other. A manifest has a line per bucket, so it doesn't grow with the rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        place, fs = self._fs(f"{self.path}/manifest/*.json")
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in fs.globStatus(place) or [])

    def manifest(self, version: int | None = None) -> dict | None:
        """keys, schema, buckets and the current merge of each bucket; null where nothing is published."""
        known = self.versions()
        if not known:
            return None
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifest/{known[-1] if version is None else version:012d}.json")
        return json.loads(text.first()[0])

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version (the last by default), of all buckets or of some."""
        now = self.manifest(version)
        if now is None:
            raise ValueError(f"no version of a table at {self.path}")
        return self._rows(now, buckets)

    def _rows(self, now: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(now["schema"])
        paths = [f"{self.path}/data/{merge}/{_BUCKET}={b}" for b, merge in now["merges"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, keys: list[str], order: str | None = None, stamp: str | None = None, buckets: int = 64, newer: str | None = None, attempts: int = 5) -> int:
        """Puts the rows of ``batch`` in by key and returns the new version.

        On repeated keys in the batch the last by ``order`` counts, which is no column of the table. ``stamp`` names
        a column that is set to the current time. With ``newer``, a stored row stays where its value of that column
        is larger. The first merge makes the table and fixes its columns, keys and number of buckets.
        """
        if order:
            last = Window.partitionBy(*keys).orderBy(F.desc(order))
            batch = batch.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", order)
        if stamp:
            batch = batch.withColumn(stamp, F.current_timestamp())
        with written(batch) as rows:
            for _ in range(attempts):
                try:
                    return self._merge_once(rows, keys, stamp, buckets, newer)
                except MergeConflict as e:
                    conflict = e
        raise conflict

    def _merge_once(self, batch: DataFrame, keys: list[str], stamp: str | None, buckets: int, newer: str | None) -> int:
        known = self.versions()
        now = self.manifest(known[-1]) if known else {"keys": keys, "schema": json.loads(batch.schema.json()), "buckets": buckets, "merges": {}}
        if now["keys"] != keys:
            raise ValueError(f"the table's keys are {now['keys']}")
        schema = T.StructType.fromJson(now["schema"])
        if stamp and stamp not in schema.names:
            schema = schema.add(stamp, "timestamp")
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in schema]).withColumn(_BUCKET, self._bucket(keys, now["buckets"]))
        touched = sorted(r[0] for r in rows.select(_BUCKET).distinct().collect())
        if known and not touched:
            return known[-1]
        now["schema"] = json.loads(schema.json())
        merge, old = uuid.uuid4().hex, self._rows(now, touched)
        merged = self._merged(old.withColumn(_BUCKET, self._bucket(keys, now["buckets"])), rows, keys, newer)
        merged.repartition(max(1, len(touched)), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{merge}")
        now["merges"] |= {str(b): merge for b in touched}
        version = known[-1] + 1 if known else 0
        self._publish(version, now)
        return version

    @staticmethod
    def _bucket(keys: list[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    @staticmethod
    def _merged(old: DataFrame, new: DataFrame, keys: list[str], newer: str | None) -> DataFrame:
        """Both sides hash on the keys, so this is one exchange of the touched buckets."""
        rank = [F.desc_nulls_last(newer)] if newer else []
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rank, F.desc("_new")))
        both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        return both.withColumn("_n", place).where("_n = 1").drop("_n", "_new")

    def _publish(self, version: int, manifest: dict) -> None:
        jvm = self.spark._jvm
        target, fs = self._fs(f"{self.path}/manifest/{version:012d}.json")
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, target, options)
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(target):
                raise MergeConflict(f"version {version} of {self.path} is taken") from e
            raise

    def vacuum(self, keep: int = 2) -> int:
        """Deletes versions but the last ``keep``, and merges that none of these names; returns how many merges went.

        Merges that run at the same time aren't published yet, so this is for times without writers.
        """
        known = self.versions()
        used = {m for v in known[-keep:] for m in self.manifest(v)["merges"].values()}
        for v in known[:-keep]:
            place, fs = self._fs(f"{self.path}/manifest/{v:012d}.json")
            fs.delete(place, False)
        place, fs = self._fs(f"{self.path}/data/*")
        gone = [f.getPath() for f in fs.globStatus(place) or [] if f.getPath().getName() not in used]
        for p in gone:
            fs.delete(p, True)
        return len(gone)
