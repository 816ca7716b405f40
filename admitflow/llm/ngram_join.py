"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with equal shingle sets are collapsed first. Banded MinHash values give buckets; inside a bucket, pairs
compare their MinHash values in steps and are dropped once the posterior probability of reaching the threshold falls
below a tolerance. What survives forms small components, inside which every pair is verified on the exact shingle
sets. Buckets and components are worked off in pairs of bounded blocks, so no group meets in one task and no pairs
are written out: a task returns a spanning forest and link counts, both linear in its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, Scratch, WordHashes, connected_components, gram_hashes, join_per_key, released, stream_groups

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS


def cutoffs(threshold: float, tolerance: float, step: int = 32, hashes: int = HASHES) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on), from a uniform prior on the similarity.

    After m of n matches the similarity's posterior is Beta(m + 1, n - m + 1), and its chance of reaching t is
    the chance that a binomial variable over n + 1 trials at t is at most m.
    """
    out = []
    for n in range(step, hashes + 1, step):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240)
    return rng.integers(1, 2**32, HASHES, np.uint32) | np.uint32(1), rng.integers(0, 2**32, HASHES, np.uint32)


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 bits of each of the MinHash values of a set of 64-bit gram hashes."""
    x = (grams >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        h = np.multiply.outer(a, x[i : i + 4096])
        h += b[:, None]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(low, h.min(axis=1), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _sign(n_gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (a, b) = WordHashes(), _multipliers()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys, sizes, sigs = [], [], []
                for text in part.column(1):
                    text = text.as_py()
                    grams = np.unique(gram_hashes(words.array((text or "").lower().split()), n_gram))
                    keys.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                    sizes.append(len(grams))
                    sigs.append(signature(grams, a, b).tobytes() if len(grams) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary())], ["doc_id", "mark", "key", "n", "sig"])

    return run


def _survivors(a: np.ndarray, b: np.ndarray | None, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Position pairs (of a with itself, or of a with b) that no step drops."""
    other = a if b is None else b
    n, least = steps[0]
    hits = np.zeros((len(a), len(other)), np.uint8)
    for h in range(n):
        hits += a[:, h, None] == other[None, :, h]
    i, j = np.nonzero(hits >= least)
    if b is None:
        i, j = i[i < j], j[i < j]
    count = hits[i, j].astype(np.int32)
    for (start, _), (end, least) in zip(steps, steps[1:]):
        for at in range(0, len(i), 100_000):
            s = slice(at, at + 100_000)
            count[s] += (a[i[s], start:end] == other[j[s], start:end]).sum(axis=1, dtype=np.int32)
        keep = count >= least
        i, j, count = i[keep], j[keep], count[keep]
    return i, j


def _prune(steps: list[tuple[int, int]]):
    def work(key: tuple, rows: pa.Table) -> dict:
        c, chunk = rows["c"].to_numpy(), rows["chunk"].to_numpy()
        sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint16).reshape(len(c), HASHES)
        order = np.argsort(c, kind="stable")
        c, chunk, sig = c[order], chunk[order], sig[order]
        _, low, high = key
        first = np.flatnonzero(chunk == low)
        second = first if low == high else np.flatnonzero(chunk == high)
        i, j = _survivors(sig[first], None if low == high else sig[second], steps)
        tree = Forest(len(c))
        for x, y in _thin(first[i], second[j], len(c)):
            tree.join(x, y)
        root = tree.roots()
        moved = np.flatnonzero(root != np.arange(len(c)))
        return {"a": c[moved], "b": c[root[moved]]}

    return work


def _thin(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The same connections with far fewer pairs where many are given: label passing until nothing changes."""
    if len(i) < 2000:
        return list(zip(i.tolist(), j.tolist()))
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            return list(enumerate(label.tolist()))


def _verify(threshold: float):
    def work(key: tuple, rows: pa.Table) -> dict:
        c, chunk, mult = rows["c"].to_numpy(), rows["chunk"].to_numpy(), rows["mult"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows["grams"].to_pylist()]
        order = np.unique(c, return_index=True)[1]
        c, chunk, mult, sets = c[order], chunk[order], mult[order], [sets[o] for o in order]
        sizes = np.array([len(s) for s in sets], np.int64)
        _, low, high = key
        first = np.flatnonzero(chunk == low)
        second = first if low == high else np.flatnonzero(chunk == high)
        shared = _intersections([sets[x] for x in first], [sets[x] for x in second])
        union = sizes[first][:, None] + sizes[second][None, :] - shared
        linked = shared >= threshold * union - 1e-9
        if low == high:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(c), np.int64)
        links[first] += linked @ mult[second]
        if low != high:
            links[second] += linked.T @ mult[first]
        i, j = np.nonzero(linked)
        tree = Forest(len(c))
        for x, y in _thin(first[i], second[j], len(c)):
            tree.join(x, y)
        return {"c": c, "links": links, "root": c[tree.roots()]}

    return work


def _intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b, by products of 0/1 blocks."""
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    vocabulary, at = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    at_a, at_b = at[: len(row_a)], at[len(row_a) :]
    in_both = (np.bincount(at_a, minlength=len(vocabulary)) > 0) & (np.bincount(at_b, minlength=len(vocabulary)) > 0)
    rank = np.cumsum(in_both) - 1
    row_a, at_a = row_a[in_both[at_a]], rank[at_a[in_both[at_a]]]
    row_b, at_b = row_b[in_both[at_b]], rank[at_b[in_both[at_b]]]
    out = np.zeros((len(a), len(b)), np.int64)
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    row_a, at_a, row_b, at_b = row_a[order_a], at_a[order_a], row_b[order_b], at_b[order_b]
    for start in range(0, int(in_both.sum()), width):
        (s, e), (t, f) = np.searchsorted(at_a, (start, start + width)), np.searchsorted(at_b, (start, start + width))
        used = min(width, int(in_both.sum()) - start)
        x, y = np.zeros((len(a), used), np.float32), np.zeros((len(b), used), np.float32)
        x[row_a[s:e], at_a[s:e] - start] = 1
        y[row_b[t:f], at_b[t:f] - start] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _shingles(n_gram: int):
    """Shingle sets of the texts that have the set asked for: a doc_id may be repeated with other texts. Of repeated
    rows, one sends its set on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, names, sent = WordHashes(), ["c", "mult", "comp", "parts"], set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = []
                for text, key, c in zip(part.column("text"), part.column("key").to_pylist(), part.column("c").to_pylist()):
                    grams = None
                    if c not in sent:
                        grams = np.unique(gram_hashes(words.array((text.as_py() or "").lower().split()), n_gram)).tobytes()
                        grams = grams if xxhash.xxh3_128_digest(grams) == key else None
                    if grams is not None:
                        sent.add(c)
                    sets.append(grams)
                right = pa.array([s is not None for s in sets])
                yield pa.RecordBatch.from_arrays([*(part.column(k).filter(right) for k in names), pa.array([s for s in sets if s is not None], pa.binary())], [*names, "grams"])

    return run


def _blocks(df: DataFrame, size: str, block: int) -> DataFrame:
    """A row for each pair of blocks of its group that a row takes part in."""
    df = df.withColumnRenamed(size, "parts")
    return (
        df.withColumn("parts", F.ceil(F.col("parts") / block).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("c"), F.col("parts")).cast("long"))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
        .withColumn("low", F.least("chunk", "with"))
        .withColumn("high", F.greatest("chunk", "with"))
        .drop("with", "parts")
    )


def ngram_jaccard_join(docs: DataFrame, threshold: float = 0.8, n_gram: int = 5, tolerance: float = 1e-6, block: int = 512) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_links, n_grams.

    Texts are lower-cased and split at white space; the shingles are the sets of ``n_gram`` consecutive words (the
    whole text where it is shorter). Two documents are linked where the Jaccard similarity of their sets is
    ``threshold`` or more. ``n_links`` counts the linked documents, equal ones included; ``class_id`` is the
    smallest doc_id of the documents connected through links; ``copy_id`` the smallest with the same shingle set.
    Null, empty and blank texts have no shingles and link to nothing: each is its own class. Rows without doc_id
    take no part. Repeated rows are copies of each other. Other columns are ignored.

    A pair at the threshold shares no band with a chance of 3e-6 and is dropped by the tolerance with about as
    much; with higher similarity both chances vanish.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    # Rows of one doc_id are told apart by their texts, so that a class finds the rows of its own text only.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark")).where("doc_id is not null")
    signed = scratch.save(docs.mapInArrow(released(_sign(n_gram)), "doc_id long, mark long, key binary, n int, sig binary"), "signed")
    classes = signed.where("key is not null").groupBy("key").agg(F.min(F.struct("doc_id", "mark")).alias("row"), F.count("*").alias("mult"), F.first("sig").alias("sig")).withColumn("copy_id", F.col("row.doc_id"))
    classes = scratch.save(classes.withColumn("c", F.monotonically_increasing_id()), "classes")

    bands = classes.select("c", F.posexplode(F.array(*[F.substring("sig", i * ROWS * 2 + 1, ROWS * 2) for i in range(BANDS)])).alias("band", "value"))
    bands = bands.select("c", F.xxhash64("band", "value").alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(F.xxhash64("c").cast("decimal(38,0)")).alias("sum"), F.expr("bit_xor(xxhash64(c, 7L))").alias("xor"))
    # Buckets with the same members are worked off once.
    buckets = buckets.where("size > 1").groupBy("size", "sum", "xor").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    buckets = scratch.save(buckets.withColumn("n", F.col("size")), "buckets")
    members = _blocks(join_per_key(bands, buckets, "bucket"), "size", 1024)
    members = members.join(classes.select("c", "sig"), "c").select("bucket", "low", "high", "chunk", "c", "sig")
    edges = scratch.save(stream_groups(members, ["bucket", "low", "high"], _prune(cutoffs(threshold, tolerance)), "a long, b long"), "edges")

    near = scratch.save(connected_components(edges, scratch, "near"), "components")
    sizes = scratch.save(near.groupBy("label").agg(F.count("*").alias("size"), F.count("*").alias("n")), "sizes")
    near = join_per_key(near, sizes, "label").select(F.col("id").alias("c"), F.col("label").alias("comp"), F.col("size").alias("parts"))
    near = scratch.save(near.join(classes.select("c", "row", "mult", "key"), "c").withColumn("n", F.col("mult")), "near")
    texts = join_per_key(docs.withColumn("row", F.struct("doc_id", "mark")), near, "row").select("text", "key", "c", "mult", "comp", "parts")
    sets = texts.mapInArrow(released(_shingles(n_gram)), "c long, mult long, comp long, parts long, grams binary")
    pairs = _blocks(sets, "parts", block)
    checked = scratch.save(stream_groups(pairs, ["comp", "low", "high"], _verify(threshold), "c long, links long, root long"), "checked")

    links = checked.groupBy("c").agg(F.sum("links").alias("links"))
    found = connected_components(checked.select(F.col("c").alias("a"), F.col("root").alias("b")), scratch, "linked")
    named = classes.select("c", "key", "copy_id", "mult").join(links, "c", "left").join(found.withColumnRenamed("id", "c"), "c", "left")
    named = scratch.save(named.withColumn("label", F.coalesce("label", "c")), "labels")
    lowest = scratch.save(named.groupBy("label").agg(F.min("copy_id").alias("class_id"), F.count("*").alias("n")), "lowest")
    named = join_per_key(named, lowest, "label").select("key", "class_id", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.col("mult").alias("n"))
    named = scratch.save(named, "named")
    scratch.drop("classes", "buckets", "edges", "components", "near", "checked", "sizes", "labels", "lowest")
    whole = signed.select("doc_id", "key", F.col("n").cast("long").alias("n_grams"))
    shared = join_per_key(whole.where("key is not null"), named, "key").select("doc_id", "class_id", "copy_id", "n_links", "n_grams")
    blank = whole.where("key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), "n_grams")
    return shared.unionByName(blank)
