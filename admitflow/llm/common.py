"""Pieces that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Scratch:
    """Tables written to the folder that all executors share.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, a local session, as in tests, gets a
    temporary one; on a cluster, whose executors would each write to their own disk, that is an error. A written
    table cuts the lineage and outlives lost executors.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="spark-")
        self.root = f"{base.rstrip('/')}/admitflow-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        df.write.mode("overwrite").option("compression", compression).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that are no longer read."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_sample(rows: DataFrame, size: int) -> DataFrame:
    """About ``size`` of the distinct rows of ``rows``: those of the lowest 64-bit hash, all where there are no more.

    The bound is the same at every size of the table: copies count once, and the limit of the hash has 64 bits, so
    that it doesn't round to nothing.
    """
    mark = F.xxhash64(F.lit(3), *rows.columns)
    distinct = rows.agg(F.approx_count_distinct(mark, 0.02)).first()[0]
    top = min(2**64 - 1, (size << 64) // max(1, distinct)) - 2**63
    return rows.where(mark <= F.lit(top).cast("long")).distinct()


def join_per_key(rows: DataFrame, values: DataFrame, key: str, share: int = 256) -> DataFrame:
    """``rows`` joined to ``values``, which has one row per key with ``n``, the number of rows of that key.

    Keys with more than one row in ``share`` are broadcast, of which there can't be ``share``; their rows stay where
    they are. All others meet in a shuffle, where no task gets much of one key. Rows of a key that ``values`` lacks
    are left out. Both tables are read twice, so they should be written ones.
    """
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot, cold = values.where(F.col("n") * share > total).drop("n"), values.where(F.col("n") * share <= total).drop("n")
    beside = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(beside.join(cold.hint("merge"), key))


def released(run: Callable) -> Callable:
    """``run`` for mapInArrow, such that what a task has freed goes back to the system when it ends.

    Python workers outlive their tasks; kept pages of one stage would count against the executor in the next.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return whole


class WordHashes(dict):
    """64-bit hashes of words, kept for reuse up to a bounded number."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of a word-hash array; a shorter text is one gram, an empty one none."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * _STEP + words[k : len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def stream_groups(df: DataFrame, keys: list[str], work: Callable[[tuple, pa.Table], dict], schema: str) -> DataFrame:
    """Apply ``work(key, rows)`` to each group of long keys; only one group is held at a time.

    ``work`` returns columns by name. Callers bound their groups by splitting them into blocks first.
    """
    names = [f.split()[0] for f in schema.split(",")]
    out_schema = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_schema)
        kept: dict[str, list] = {n: [] for n in names}
        rows = 0
        for key, table in _groups(batches, keys):
            got = work(key, table)
            size = len(got[names[0]])
            if size:
                rows += size
                for n in names:
                    kept[n].append(np.asarray(got[n]))
            if rows >= 20_000:
                yield _batch(kept, arrow)
                kept, rows = {n: [] for n in names}, 0
        if rows:
            yield _batch(kept, arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _batch(kept: dict[str, list], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept[f.name]), type=f.type) for f in arrow], schema=arrow)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            key = tuple(int(c[start]) for c in columns)
            if key != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(start, end - start))
    if held:
        yield now, pa.Table.from_batches(held)


class Forest:
    """Union-find over positions, whose roots are the smallest members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)


def connected_components(edges: DataFrame, scratch: Scratch, name: str, most_rounds: int = 40) -> DataFrame:
    """(id, label) for the nodes of ``edges(a, b)``: label is the component's smallest id.

    Alternates large-star and small-star steps, each a min per node and a join; rounds grow with the logarithm of the
    size. The root of a large component has most of its edges: such nodes are broadcast (``join_per_key``), so no
    component meets in one task.
    """
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    seen = None
    for i in range(1, most_rounds + 1):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.save(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "a")), f"{name}low")
        large = join_per_key(both, low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Edges point down now, from a node to the least of its neighbours; a node has few of them.
        large = scratch.save(large, f"{name}large")
        low = scratch.save(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), f"{name}low")
        joined = join_per_key(large, low, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = scratch.save(small, f"{name}{i}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}{i - 1}", f"{name}low", f"{name}large")
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(roots.select("id", F.col("id").alias("label")))


def numbered(rows: DataFrame, order: list[Column], scratch: Scratch, name: str, number: str = "number") -> DataFrame:
    """``rows`` with their place (from 0) in the given order, written to ``scratch``.

    A range partitioning deals the rows out, so a hot value is split where rows differ in a later column of the order;
    only one count per partition comes to the driver.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.save(ordered.withColumn(number, F.monotonically_increasing_id()), name)
    part = F.shiftright(number, 33)
    before, starts = 0, []
    for p, n in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        starts.append((p, before))
        before += n
    starts = placed.sparkSession.createDataFrame(starts, "number_part long, number_before long")
    joined = placed.withColumn("number_part", part).join(F.broadcast(starts), "number_part")
    return joined.withColumn(number, F.col(number).bitwiseAND(F.lit((1 << 33) - 1)) + F.col("number_before")).drop("number_part", "number_before")
