"""Shards along a Hilbert curve over several metadata dimensions, cut into runs of near equal bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, join_per_key

BITS = 6


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate."""
    axes = [points[:, k].astype(np.int64).copy() for k in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for k, axis in enumerate(axes):
            turned = (axis & q) > 0
            swap = np.where(turned, 0, (axes[0] ^ axis) & low)
            if k:
                axes[k] = axis ^ swap
            axes[0] = axes[0] ^ np.where(turned, low, swap if k else 0)
    for k in range(1, len(axes)):
        axes[k] ^= axes[k - 1]
    flip = np.zeros(len(points), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] >> level & 1, (1 << level) - 1, 0)
    index = np.zeros(len(points), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = index << 1 | ((axis ^ flip) >> level & 1)
    return index


@F.pandas_udf(T.LongType())
def _curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([a, b, c], axis=1), BITS))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and bytes before each row of the partition."""
    rows = total = 0
    for batch in batches:
        size = batch.column(batch.schema.get_field_index("size")).to_numpy()
        before = total + np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
        n = len(size)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), pa.array(np.arange(rows, rows + n)), pa.array(before.astype(np.int64))], [*batch.schema.names, "part", "row", "before"])
        rows, total = rows + n, total + int(size.sum())


def _cells(rows: DataFrame, name: str) -> Column:
    """Cell of a column, in the order of its values: each of the most frequent values begins one, spread over all cells;
    null is cell 0."""
    frequent = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name).limit((1 << BITS) - 1).collect()
    starts = sorted((r[0] for r in frequent), key=lambda v: v.encode("utf-8", "surrogatepass"))
    at = F.lit(0)
    for value in starts:
        at = at + (F.col(name) >= F.lit(value)).cast("int")
    return (F.coalesce(at, F.lit(0)) * (((1 << BITS) - 1) // max(1, len(starts)))).cast("long")


def hilbert_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang, source)``: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, curve.

    The dimensions are source and lang, in the order of their values and with cells that the most frequent values
    begin (null is cell 0), and size in half powers of two,
    spread over the cells from the least to the largest. Rows with equal texts take the smallest source and lang
    among them, so they are neighbours on the curve and only the shards' ends can part them: a group of equal texts
    smaller than a shard lies in at most two shards. Rows are sorted by curve index, text and doc_id, and cut into
    runs of near equal bytes: a row belongs to the shard in which its middle byte falls. size is the text's UTF-8
    bytes plus 1 (null text: 1). Repeated rows get slots of their own; an empty table gives no row.

    Texts are read once and not moved. The sort is a range partitioning with one total per partition to the driver,
    and texts with many copies are broadcast (``join_per_key``), so neither a hot cell nor a hot text lies in one task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("hash"),
        "source",
        "lang",
    )
    rows = scratch.save(rows, "rows")
    power = "(length(bin(size)) - 1)"
    scale = F.expr(f"2 * {power} + int(size * size >= shiftleft(1L, 2 * {power} + 1))")
    least, most = rows.agg(F.min(scale), F.max(scale)).first()
    scale = F.floor((scale - (least or 0)) * ((1 << BITS) - 1) / max(1, (most or 0) - (least or 0)))
    texts = rows.groupBy("hash", "text_crc32", "size").agg(F.min("source").alias("source"), F.min("lang").alias("lang"), F.count("*").alias("n"))
    texts = texts.select("hash", "text_crc32", "size", "n", _curve(_cells(rows, "source"), _cells(rows, "lang"), scale.cast("long")).alias("curve"))
    same = F.struct("hash", "text_crc32", "size").alias("same")
    texts = scratch.save(texts.select(same, "curve", "n"), "texts")
    ordered = join_per_key(rows.select("doc_id", same), texts, "same").select("doc_id", "same.*", "curve")
    ordered = ordered.repartitionByRange("curve", "text_crc32", "hash", "doc_id").sortWithinPartitions("curve", "text_crc32", "hash", "doc_id")
    numbered = scratch.save(ordered.drop("hash").select("doc_id", "size", "text_crc32", "curve").mapInArrow(_number, "doc_id long, size long, text_crc32 long, curve long, part int, row long, before long"), "numbered")
    scratch.drop("rows", "texts")

    parts = sorted(numbered.groupBy("part").agg(F.count("*").alias("rows"), F.sum("size").alias("size")).collect())
    starts, rows_before, before = [], 0, 0
    for p in parts:
        starts.append((p.part, rows_before, before))
        rows_before, before = rows_before + p.rows, before + p["size"]
    starts = spark.createDataFrame(starts, "part int, first_row long, first_byte long")
    placed = numbered.join(F.broadcast(starts), "part").withColumn("row", F.col("row") + F.col("first_row"))
    placed = placed.withColumn("shard", F.expr(f"cast(((2 * (before + first_byte) + size) * {shards}) div {2 * max(1, before)} as int)"))
    first = [r for r in placed.groupBy("shard").agg(F.min("row").alias("first")).collect()]
    first = spark.createDataFrame(first, "shard int, first long")
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Writes ``docs`` with a directory per shard, each file sorted along the curve. doc_id must be unique."""
    placed = hilbert_shards(docs, shards).select("doc_id", "shard", "slot")
    docs.join(placed, "doc_id").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("slot").write.mode("overwrite").partitionBy("shard").parquet(path)
