"""Importance resampling of a corpus towards a target corpus, with bit-sliced sums of the buckets' gains."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, numbered, released

#: Lower-cases A-Z; ASCII other than letters and digits parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class _Buckets(dict):
    """Bucket of a feature, kept for reuse up to a bounded number."""

    def __init__(self, buckets: int, most: int = 250_000):
        super().__init__()
        self.buckets, self.most = buckets, most

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.buckets
        return value


def _words(raw: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text in lists of bounded size."""
    folded, start = raw.translate(_FOLD), 0
    while start < len(folded):
        end = len(folded)
        if end - start > piece:
            end = folded.rfind(b" ", start, start + piece)
            end = end if end > start else folded.find(b" ", start + piece)
            end = end if end > 0 else len(folded)
        yield folded[start:end].split()
        start = end


def _features(raw: bytes, longest: int, known: _Buckets) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to ``longest`` words, repeats counted."""
    carried: list[bytes] = []
    for words in _words(raw):
        whole = carried + words
        for n in range(1, longest + 1):
            runs = words if n == 1 else [b" ".join(whole[i - n : i]) for i in range(max(n, len(carried) + 1), len(whole) + 1)]
            yield np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))
        carried = whole[len(whole) - longest + 1 :] if longest > 1 else carried


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()):
        yield value.as_py() or b""


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features of all ``texts(text)`` in each bucket: each task adds its own up, so only ``buckets`` rows a task move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in _texts(batch):
                for found in _features(raw, longest, known):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select("text").mapInArrow(released(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of how much more frequent a bucket is in the target, each with one added."""
    m, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(s + m) / (float(a + 1) * float(t + m)))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def _planes(values: np.ndarray) -> list[np.ndarray]:
    """Bit planes of rows of whole numbers: plane j has bit j of each number, packed to 64-bit words."""
    out = []
    for j in range(int(values.max(initial=0)).bit_length()):
        packed = np.packbits((values >> j & 1).astype(bool), axis=1)
        out.append(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64))
    return out


class GainSums:
    """Sums of signed gains over documents' bucket counts, by AND and popcount of bit planes."""

    def __init__(self, gains: np.ndarray):
        self.signed = [(sign << k, plane[0]) for sign in (1, -1) for k, plane in enumerate(_planes(np.maximum(sign * gains, 0)[None, :]))]

    def of(self, counts: np.ndarray) -> np.ndarray:
        """Exact sum of count times gain for each row of ``counts``."""
        total = np.zeros(len(counts), np.int64)
        for j, plane in enumerate(_planes(counts)):
            for factor, gain in self.signed:
                total += (np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) << j) * factor
        return total


def importance_weights(docs: DataFrame, gains: np.ndarray, longest: int = 1, block: int = 64) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean of gains over the features, for each row of ``docs``.

    A block of documents at a time is turned into bit planes; memory doesn't grow with the length of a text but for
    the text itself.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = _Buckets(buckets), GainSums(gains)
        for batch in batches:
            n = batch.num_rows
            words, features, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            counts = np.zeros((min(block, n), buckets), np.int64)
            for i, raw in enumerate(_texts(batch)):
                row = counts[i % block]
                row[:] = 0
                for k, found in enumerate(_features(raw, longest, known)):
                    row += np.bincount(found, minlength=buckets)
                    words[i] += len(found) if k % longest == 0 else 0
                    features[i] += len(found)
                if i % block == block - 1 or i == n - 1:
                    start = i - i % block
                    total[start : i + 1] = sums.of(counts[: i + 1 - start])
            weight = total // np.maximum(features, 1)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {id_type}, n_words long, n_features long, weight long")


def _noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from the document's id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u)))


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, longest: int = 1, least_words: int = 20, buckets: int = 10_000) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of each row of ``docs(doc_id, text)``; rank is null where not drawn.

    Features are runs of 1 to ``longest`` words in ``buckets`` hash buckets. A bucket's gain says how much more
    frequent it is in all ``target`` texts than in all ``docs``; a document's weight is the mean of its features'
    gains, its score the weight and Gumbel noise, so that the highest scores are a weighted draw without replacement:
    ``percent`` of the documents with at least ``least_words`` words, ties to the smaller doc_id (null last).

    A null or empty text has no features and weight 0. Repeated rows are rows of their own: with one doc_id they have
    one noise. A null doc_id draws its noise from the seed alone. Empty tables give no row; an empty target draws too.

    The counts of all texts come to the driver as one number per bucket, and the scores as one count per distinct
    whole number (these lie within some 120,000 values: a gain is a logarithm). Only rows from the last drawn score
    on are sorted, by a range partitioning.
    """
    scratch = Scratch(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = importance_weights(docs, gains, longest).withColumn("score", F.col("weight") + _noise(seed))
    scored = scratch.save(scored, "scored")
    enough = F.col("n_words") >= least_words
    counts = sorted(scored.where(enough).groupBy("score").agg(F.count("*").alias("n")).collect(), reverse=True)
    draw, seen, cut = percent * sum(n for _, n in counts) // 100, 0, None
    for score, n in counts:
        if seen >= draw:
            break
        seen, cut = seen + n, score
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = enough & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("row")]
    top = numbered(scored.where(near).withColumn("row", F.monotonically_increasing_id()), order, scratch, "top").drop("row")
    top = top.withColumn("rank", F.when(F.col("number") < draw, F.col("number") + 1)).drop("number")
    return top.unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, resampled: DataFrame) -> DataFrame:
    """The rows of ``docs`` that were drawn. doc_id must be unique and not null."""
    return docs.join(resampled.where("rank is not null").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
