"""Mixing sources to target weights: copies of documents whose sizes add up to each source's target."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_per_key, numbered


def target_sizes(sizes: Sequence[int], weights: Sequence[int], most: int = 3) -> list[Fraction]:
    """Shares by weight of the sum of ``sizes``; none above ``most`` times its own, what is over goes to the others."""
    target, free, left = [Fraction(0)] * len(sizes), set(range(len(sizes))), Fraction(sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * unit > most * sizes[i]}
        for i in full or free:
            target[i] = Fraction(most * sizes[i]) if full else weights[i] * unit
        left -= sum(target[i] for i in full)
        free -= full or free
    return target


def subset_sum(sizes: np.ndarray, counts: np.ndarray, goal: int) -> np.ndarray:
    """How many of each size, at most ``counts``, add up as near to ``goal`` as can be (the lower of two equally near).

    Bounded knapsack over the sums from 0: counts are split into powers of two, each of which is taken or not, and
    each sum remembers the part that reached it first.
    """
    take = np.zeros(len(sizes), np.int64)
    usable = np.flatnonzero((counts > 0) & (sizes > 0))
    if goal <= 0 or not len(usable):
        return take
    top = min(2 * goal, goal + int(sizes[usable].max()))
    reached, by = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int32)
    reached[0] = True
    parts: list[tuple[int, int]] = []
    for i in sorted(usable, key=lambda i: -sizes[i]):
        size, left, power = int(sizes[i]), min(int(counts[i]), top // int(sizes[i])), 1
        while left > 0 and not reached[goal]:
            n = min(power, left)
            new = reached[: top + 1 - n * size] & ~reached[n * size :]
            by[n * size :][new] = len(parts)
            reached[n * size :] |= new
            parts.append((int(i), n))
            left, power = left - n, 2 * power
        if reached[goal]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    while at:
        i, n = parts[by[at]]
        take[i] += n
        at -= n * int(sizes[i])
    return take


def fit_copies(sizes: np.ndarray, counts: np.ndarray, budget: int, most: int = 1, most_sum: int = 1 << 16) -> np.ndarray:
    """How many copies of the documents of each size make up ``budget``, with nearly the same share of all sizes.

    Each size gets its share of copies, rounded along the ascending sizes, and the dynamic programme fits what
    remains with up to one copy more than the share of each document. Where it misses, some copies are given back,
    evenly over the sizes, so that it has more to choose from, and at last all documents may have ``most`` copies.
    Sums past 4 * ``most_sum`` are left to the largest documents that fit.
    """
    order = np.argsort(sizes, kind="stable")
    size, n = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    total = int((size * n).sum())
    out = np.zeros(len(size), np.int64)
    if budget >= most * total:
        out[order] = most * n
        return out
    if budget <= 0:
        return out
    share = budget / total
    base = np.clip(np.diff(np.floor(np.cumsum(n) * share).astype(np.int64), prepend=0), 0, most * n)
    picked = np.flatnonzero(base)
    best, best_miss = base, None
    for each in sorted({min(most, int(share) + 1), most}):
        for back in (0, 4, 16, 64, 256):
            trial = base.copy()
            if len(picked):
                np.subtract.at(trial, picked[np.linspace(0, len(picked) - 1, min(back, len(picked))).astype(np.int64)], 1)
            trial += _filled(size, each * n - trial, trial, budget - int((size * trial).sum()), most_sum)
            miss = abs(budget - int((size * trial).sum()))
            if best_miss is None or miss < best_miss:
                best, best_miss = trial, miss
            if not best_miss or back >= len(picked):
                break
        if not best_miss:
            break
    out[order] = best
    return out


def _filled(size: np.ndarray, free: np.ndarray, taken: np.ndarray, rest: int, most_sum: int) -> np.ndarray:
    """Copies to add (or to take back) of each size, so that ``rest`` is used up: ``free`` may be added at most."""
    change = np.zeros(len(size), np.int64)
    for i in range(len(size) - 1, -1, -1):
        if rest < 0 and taken[i]:
            change[i] = -min(int(taken[i]), -(rest // int(size[i])))
        elif rest > 2 * most_sum and size[i] <= rest:
            change[i] = min(int(free[i]), (rest - most_sum) // int(size[i]))
        rest -= int(change[i]) * int(size[i])
    if rest <= 4 * most_sum:
        change += subset_sum(size, np.where(size <= 4 * most_sum, free - change, 0), rest)
    return change


def _fitter(most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fit(hist: pd.DataFrame) -> pd.DataFrame:
        """Copies to take of the documents of each size of one source."""
        size, n = hist["size"].to_numpy(), hist["n"].to_numpy()
        copies = np.zeros(len(size), np.int64)
        words = size > 0
        copies[words] = fit_copies(size[words], n[words], int(hist["budget"].iloc[0]), most)
        return pd.DataFrame({"no": hist["no"], "size": size, "n": n, "copies": copies})

    return fit


def word_count(text: str = "text") -> Column:
    """Number of runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: int = 11, size: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats, taken of each row of ``docs(doc_id, source, text)``.

    Sources in the order of their code points, null last, take ``weights`` in turn and share the size of the whole
    corpus; a target stops at ``most`` times its source and the excess is shared anew. size is the number of words
    unless another column is given. A source's documents are counted by size, and the copies to take of each size are
    fitted to the target by a bounded-knapsack dynamic programme. The documents of one size share its copies evenly;
    those of the lowest seeded hash have one more than the others. taken is size times repeats.

    Null texts have size 0, which is never taken; so have sources without words a target of 0. The hash is that of
    doc_id and text, so reruns agree, and repeated rows are interchangeable. An empty table gives no row.

    To the driver comes a row per source: the components of the mix. One task gets the histogram of one source, which
    has one row per distinct size: for W words at most sqrt(2 W) rows. Documents are ranked by a range partitioning
    over source, size and hash, so neither a large source nor a frequent size lies in one task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = F.struct(F.col("source").isNull().alias("missing"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name")).alias("key")
    rows = docs.select("doc_id", source, (word_count() if size is None else size).cast("long").alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("hash"))
    rows = scratch.save(rows, "rows")
    sources = sorted(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect(), key=lambda r: (r.key.missing, r.key.name))
    targets = target_sizes([r["size"] for r in sources], [weights[i % len(weights)] for i in range(len(sources))], most)
    mix = [(tuple(r.key), i, r["size"], float(t), int(round(t)), r.n) for i, (r, t) in enumerate(zip(sources, targets))]
    mix = spark.createDataFrame(mix, "key struct<missing:boolean,name:string>, no int, source_size long, target double, budget long, n long")
    placed = join_per_key(rows, mix, "key").withColumn("row", F.monotonically_increasing_id())
    ranked = numbered(placed, [F.asc(c) for c in ("no", "size", "hash", "doc_id", "row")], scratch, "ranked").drop("row")
    sizes = ranked.groupBy("no", "size", "budget").agg(F.count("*").alias("n"), F.min("number").alias("first"))
    sizes = scratch.save(sizes, "sizes")
    fitted = sizes.drop("first").groupBy("no").applyInPandas(_fitter(most), "no int, size long, n long, copies long")
    pair = F.struct("no", "size").alias("pair")
    plan = scratch.save(fitted.drop("n").join(sizes.drop("budget"), ["no", "size"]).select(pair, "n", "first", F.expr("copies div n").alias("whole"), F.expr("copies % n").alias("more")), "plan")
    out = join_per_key(ranked.withColumn("pair", F.struct("no", "size")), plan, "pair")
    out = out.withColumn("repeats", F.col("whole") + (F.col("number") - F.col("first") < F.col("more")).cast("long"))
    name = F.when(~F.col("key.missing"), F.col("key.name")).alias("source")
    return out.select("doc_id", name, "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them, repeats as rows of their own. doc_id must be unique and not null."""
    times = mixed.where("repeats > 0").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy"))
    return docs.join(times.drop("copy"), "doc_id").select(docs.columns)
