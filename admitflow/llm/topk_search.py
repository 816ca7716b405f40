"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are range-partitioned by length and worked off in buckets of similar length. A lower bound of each query's
k-th score, first from the longest vectors and then from what its task has found, gives a cosine threshold that is
local to the bucket: it skips the bucket, cuts it by length or by the ranges of a few large coordinates, or is too
low to prune. What is left is verified by exact products. Queries and vectors are stored in blocks of bounded size,
and a bucket goes to the groups of query blocks that it can still improve; neither passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Vectors in a bucket, longest vectors that give first bounds, queries in a block, blocks that a task keeps open.
BUCKET, SEEDS, BLOCK, OPEN = 4096, 4096, 4096, 4


def _quantise(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed, norms = [], [], []
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or row is None or any(x is None for x in row):
                    continue
                v = np.floor(np.array(row, np.float64) * scale)
                if not np.isfinite(v).all():
                    continue
                ids.append(i)
                packed.append(v.astype(np.float64).tobytes())
                norms.append(float(np.sqrt((v * v).sum())))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(norms)], ["vec_id", "v", "norm"])

    return run


@dataclass
class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    k: int
    score: np.ndarray
    vec: np.ndarray
    bound: np.ndarray

    @classmethod
    def empty(cls, n: int, k: int, bound: np.ndarray | None = None) -> Best:
        return cls(k, np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max), np.full(n, -np.inf) if bound is None else bound.copy())

    def wanted(self, scores: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        worst, last = self.score[queries, -1], self.vec[queries, -1]
        return (scores >= self.bound[queries]) & ((scores > worst) | ((scores == worst) & (ids < last)))

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched = np.unique(queries)
        q = np.concatenate([np.repeat(touched, self.k), queries])
        i = np.concatenate([self.vec[touched].ravel(), ids])
        s = np.concatenate([self.score[touched].ravel(), scores])
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        keep = rank < self.k
        self.score[q[keep], rank[keep]], self.vec[q[keep], rank[keep]] = s[keep], i[keep]
        self.bound = np.maximum(self.bound, self.score[:, -1])


class Search:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, bound: np.ndarray | None = None, focus: int = 3, low: float = 0.6):
        self.ids, self.q, self.focus, self.low = ids, vectors, focus, low
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = vectors / np.maximum(self.norm, 1e-300)[:, None]
        self.best = Best.empty(len(ids), k, bound)

    def bucket(self, ids: np.ndarray, vectors: np.ndarray, norm: np.ndarray) -> None:
        """One bucket, longest vectors first."""
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(self.norm * norm[0] > 0, self.best.bound / (self.norm * norm[0]), np.where(self.best.bound > 0, np.inf, -np.inf))
        open_ = np.flatnonzero(local <= 1 + 1e-9)
        plain = open_[local[open_] < self.low]
        pruned = open_[local[open_] >= self.low]
        for at in range(0, len(plain), 256):
            self._verify(plain[at : at + 256], slice(None), ids, vectors)
        if not len(pruned):
            return
        unit = vectors / np.maximum(norm, 1e-300)[:, None]
        orders: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for j in pruned.tolist():
            limit = min(1.0, max(-1.0, self.best.bound[j] / (self.norm[j] * norm[0]) - 1e-9))
            long_enough = int(np.searchsorted(-norm, -(self.best.bound[j] / self.norm[j] - 1e-6), "right"))
            rows = np.arange(long_enough)
            near = np.arccos(limit)
            for f in np.argsort(-np.abs(self.unit[j]))[: self.focus].tolist():
                if f not in orders:
                    order = np.argsort(unit[:, f])
                    orders[f] = (order, unit[order, f])
                angle = np.arccos(min(1.0, max(-1.0, self.unit[j, f])))
                least, most = np.cos(min(np.pi, angle + near)) - 1e-9, np.cos(max(0.0, angle - near)) + 1e-9
                order, values = orders[f]
                start, end = np.searchsorted(values, least, "left"), np.searchsorted(values, most, "right")
                if end - start < len(rows) // 2:
                    rows = order[start:end][order[start:end] < long_enough] if len(rows) == long_enough else rows[(unit[rows, f] >= least) & (unit[rows, f] <= most)]
                else:
                    rows = rows[(unit[rows, f] >= least) & (unit[rows, f] <= most)]
            if len(rows):
                self._verify(np.array([j]), rows, ids, vectors)

    def _verify(self, queries: np.ndarray, rows, ids: np.ndarray, vectors: np.ndarray) -> None:
        ids, scores = ids[rows], self.q[queries] @ vectors[rows].T
        hit_q, hit_v = np.nonzero(scores >= self.best.bound[queries][:, None])
        q, i, s = queries[hit_q], ids[hit_v], scores[hit_q, hit_v]
        keep = self.best.wanted(s, q, i) & (i != self.ids[q])
        if keep.any():
            self.best.add(q[keep], i[keep], s[keep])


def _unpack(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def _packed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, ids, vectors) of up to ``most`` successive rows ``vec_id, v`` of one number of dimensions."""
    ids: list[int] = []
    held: list[bytes] = []
    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (len(held) == most or len(v) != len(held[0])):
                yield len(held[0]) // 8, np.array(ids, np.int64), _unpack(held)
                ids, held = [], []
            ids.append(i)
            held.append(v)
    if held:
        yield len(held[0]) // 8, np.array(ids, np.int64), _unpack(held)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for dims, ids, v in _packed(batches, BUCKET):
        longest = float(np.sqrt((v * v).sum(axis=1)).max())
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([dims], pa.int32()), pa.array([longest]), pa.array([ids.tobytes()]), pa.array([v.tobytes()])], ["bucket", "dims", "longest", "ids", "v"])
        number += 1


def needed_length(norms: np.ndarray, bounds: np.ndarray) -> float:
    """Length below which no vector can reach the bound of any of the queries, with room for rounding."""
    with np.errstate(divide="ignore", invalid="ignore"):
        each = np.where(norms > 0, bounds / norms, np.where(bounds > 0, np.inf, -np.inf))
    least = float(each.min())
    return least - 1e-6 * abs(least) if np.isfinite(least) else least


def _blocks(seeds, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for dims, ids, q in _packed(batches, BLOCK):
            first = Search(ids, q, k)
            if dims in seeds.value:
                first.bucket(*seeds.value[dims])
            least = needed_length(first.norm, first.best.bound)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([dims], pa.int32()), pa.array([least]), pa.array([ids.tobytes()]), pa.array([q.tobytes()]), pa.array([first.best.bound.tobytes()])], ["block", "dims", "least", "ids", "v", "bound"])
            number += 1

    return run


def _search(k: int):
    """Rows of a group come together, its blocks first and then its buckets, the longest vectors first."""

    def results(open_: list[Search]) -> Iterator[pa.RecordBatch]:
        for search in open_:
            found, at = np.nonzero(np.isfinite(search.best.score))
            yield pa.RecordBatch.from_arrays([pa.array(search.ids[found]), pa.array(search.best.vec[found, at]), pa.array(search.best.score[found, at].astype(np.int64))], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_ = None, []
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            for r, (group, bound) in enumerate(zip(column["group"].to_pylist(), column["bound"])):
                if group != now:
                    yield from results(open_)
                    now, open_ = group, []
                ids = np.frombuffer(column["ids"][r].as_buffer(), np.int64)
                vectors = np.frombuffer(column["v"][r].as_buffer(), np.float64).reshape(len(ids), -1)
                if bound.is_valid:
                    open_.append(Search(ids.copy(), vectors.copy(), k, np.frombuffer(bound.as_buffer(), np.float64)))
                    continue
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                for search in open_:
                    search.bucket(ids, vectors, norms)
        yield from results(open_)

    return run


def pairs_left(buckets: DataFrame, blocks: DataFrame) -> DataFrame:
    """(bucket, group) of the buckets whose longest vector can still reach a bound of the group's queries.

    Only numbers are joined: a row per bucket of ``BUCKET`` vectors with a row per group of ``OPEN`` * ``BLOCK`` queries.
    """
    groups = blocks.groupBy("group", "dims").agg(F.min("least").alias("least"))
    narrow = buckets.select("bucket", "dims", "longest")
    return narrow.join(F.broadcast(groups), (narrow["dims"] == groups["dims"]) & (narrow["longest"] >= groups["least"])).select("bucket", "group")


def top_k_search(vectors: DataFrame, queries: str, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer inner products of each row that ``queries`` selects.

    Components become floor(scale * x). Candidates are all rows but those with the query's own vec_id; ties go to
    the smaller vec_id; fewer than ``k`` candidates give fewer rows. Vectors that are null, or hold null or
    non-finite components, and rows without vec_id take no part. Repeated rows are candidates each; a repeated
    query is asked once, with the smallest of its vectors. A vector is a candidate of queries with as many
    dimensions. Products are exact while they stay below 2^53. Other columns are ignored.

    A table of numbers says which buckets can still improve which groups of query blocks; only these are sent. A task
    keeps the best of its few blocks, and its bounds rise from bucket to bucket. Broadcast are the ``SEEDS`` longest
    vectors, and a row of numbers for each group of 16,384 queries.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_quantise(scale), "vec_id long, v binary, norm double")
    rows = scratch.save(rows, "rows")
    seeds: dict[int, list] = {}
    for r in rows.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).collect():
        seeds.setdefault(len(r.v) // 8, []).append(r)
    shared = spark.sparkContext.broadcast({d: (np.array([r.vec_id for r in x]), _unpack([r.v for r in x]), np.array([r.norm for r in x])) for d, x in seeds.items()})
    order = [F.octet_length("v"), F.desc("norm"), F.col("vec_id")]
    buckets = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "v").mapInArrow(_buckets, "bucket long, dims int, longest double, ids binary, v binary")
    buckets = scratch.save(buckets, "buckets")
    asked = scratch.save(rows.where(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    count = max(1, -(-asked.count() // BLOCK))
    blocks = asked.repartition(count).sortWithinPartitions(F.octet_length("v"), "vec_id").mapInArrow(_blocks(shared, k), "block long, dims int, least double, ids binary, v binary, bound binary")
    # A group has blocks of one number of dimensions.
    blocks = blocks.withColumn("group", F.struct("dims", F.floor(F.shiftright("block", 33) / OPEN).alias("part")))
    blocks = scratch.save(blocks, "blocks")
    scratch.drop("rows", "queries")
    sent = buckets.join(scratch.save(pairs_left(buckets, blocks), "pairs"), "bucket").select("group", F.lit(1).alias("kind"), F.col("longest").alias("place"), "ids", "v", F.lit(None).cast("binary").alias("bound"))
    both = blocks.select("group", F.lit(0).alias("kind"), F.lit(0.0).alias("place"), "ids", "v", "bound").unionByName(sent)
    both = both.repartition("group").sortWithinPartitions("group", "kind", F.desc("place"))
    out = both.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
