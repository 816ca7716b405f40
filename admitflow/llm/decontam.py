"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

A CGK walk reads a string through shared random functions and emits a character per step, so that strings at a small
edit distance get outputs at a small Hamming distance. Windows of documents and of benchmark items are walked; a
repetition samples steps of the walk and compares the characters there. Windows are as wide as the smallest item of
their class of lengths, every item gives a window at each of its words, and a document one at every few words, so an
item is met at many places. Where text has no spaces, characters take the place of words. A met item is verified at its whole length by exact edit distance. Documents never move:
the items go to them, in slices of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, released

_SPACES = bytes(32 if chr(i).isspace() and i < 128 else i for i in range(256))
_WIDE_SPACES = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Bytes from which on each character of a word starts a window.
LONG = 24
_P = np.uint64(0x9E3779B97F4A7C15)
#: Steps of the walk and stride in words, by least length of an item in bytes.
CLASSES = ((96, 64, 2), (40, 40, 1), (12, 12, 1), (1, 1, 1))


def normalise(text: str | None) -> bytes:
    """Lower-cased UTF-8 with white space as single bytes 32."""
    text = (text or "").lower()
    if not text.isascii():
        text = _WIDE_SPACES.sub(" ", text)
    return text.encode("utf-8", "surrogatepass").translate(_SPACES).replace(b"\0", b" ")


def window_starts(buf: np.ndarray) -> np.ndarray:
    """Starts of words, of characters in words of ``LONG`` bytes or more, and of all characters of three bytes or
    more, as the scripts without spaces are there."""
    solid = buf > 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    first, behind = edges[::2], edges[1::2]
    starts = buf >= 0xE0
    starts[first] = True
    long = behind - first >= LONG
    if long.any():
        depth = np.zeros(len(buf) + 1, np.int8)
        depth[first[long]] = 1
        depth[behind[long]] = -1
        starts |= (np.cumsum(depth[:-1], dtype=np.int8) > 0) & ((buf & 0xC0) != 0x80)
    return np.flatnonzero(starts)


class Myers:
    """Least edit distance of a pattern to any substring of a text, with bit-parallel columns."""

    def __init__(self, pattern: bytes):
        self.m = len(pattern)
        self.mask = (1 << self.m) - 1
        self.peq: dict[int, int] = {}
        for i, c in enumerate(pattern):
            self.peq[c] = self.peq.get(c, 0) | 1 << i

    def best(self, text: bytes) -> tuple[int, int]:
        """(distance, end of the first best substring)."""
        pv, mv, score, best, end = self.mask, 0, self.m, self.m, 0
        high, mask, get = 1 << self.m - 1, self.mask, self.peq.get
        for j, c in enumerate(text):
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv)
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
                if score < best:
                    best, end = score, j + 1
            ph <<= 1
            mh <<= 1
            pv = (mh | ~(xv | ph)) & mask
            mv = ph & xv & mask
        return best, end


class Lsh:
    """Sampled walks of one class of items; ``find`` gives (window, item, offset) for windows that meet."""

    def __init__(self, items: list[tuple[int, bytes]], steps: int, stride: int, repetitions: int, samples: int, seed: int = 7):
        self.steps, self.stride, self.depth = steps, stride, min(samples, steps)
        rng = np.random.default_rng(seed)
        self.tables = []
        buf, starts, owner, offset = _window_list(items, steps)
        # Some 32 places for each key, so that few walks of documents go on by chance; a table per sample of each walk,
        # a bit per place: at most 2^19 bytes each, so 96 tables of a class are 50 MB for the largest slice of items.
        bits = min(22, max(12, (32 * len(starts)).bit_length()))
        self.shift = np.uint64(64 - bits)
        for _ in range(repetitions):
            walk = rng.integers(0, 2, (steps, 256), np.uint8)
            walk[:, 0] = 0  # the end of a text is never left
            at = set(rng.choice(steps, self.depth, replace=False).tolist())
            seen: dict[int, np.ndarray] = {}
            pos, h, depth = starts.copy(), np.zeros(len(starts), np.uint64), 0
            for t in range(steps):
                c = buf[pos]
                if t in at:
                    h = (h + c + np.uint64(1)) * _P
                    depth += 1
                    places = np.zeros(1 << bits, bool)
                    places[h >> self.shift] = True
                    seen[depth] = np.packbits(places, bitorder="little")
                pos = pos + walk[t][c]
            order = np.argsort(h, kind="stable")
            self.tables.append((walk, at, seen, h[order], owner[order], offset[order]))

    def find(self, buf: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for walk, at, seen, keys, owner, offset in self.tables:
            pos, h, first, depth = starts, np.zeros(len(starts), np.uint64), starts, 0
            for t in range(self.steps):
                c = buf[pos]
                if t in at:
                    h = (h + c + np.uint64(1)) * _P
                    depth += 1
                    if depth > 1:
                        place = h >> self.shift
                        keep = np.flatnonzero(seen[depth][place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                        pos, h, first, c = pos[keep], h[keep], first[keep], c[keep]
                        if not len(pos):
                            break
                pos = pos + walk[t][c]
            if len(pos):
                low, high = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
                n = high - low
                at_key = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                yield np.repeat(first, n), owner[at_key], offset[at_key]


def _window_list(items: list[tuple[int, bytes]], steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Items in one buffer, and of each window its start, item and offset; windows that the item can't fill are left
    out but for the first."""
    buf = np.frombuffer(b"".join(t + bytes(steps + 1) for _, t in items), np.uint8)
    starts, owner, offset, base = [], [], [], 0
    for i, t in items:
        at = window_starts(np.frombuffer(t, np.uint8))
        at = at[(at + steps * 5 // 8 <= len(t)) | (at == at[0])] if len(at) else at
        starts.append(at + base)
        owner.append(np.full(len(at), i))
        offset.append(at)
        base += len(t) + steps + 1
    return buf, np.concatenate(starts).astype(np.int32), np.concatenate(owner), np.concatenate(offset)


class Detector:
    """Finds the items of one slice in texts."""

    def __init__(self, items: list[tuple[int, str]], max_distance: float, repetitions: int, samples: int):
        self.items = [(i, normalise(t).strip()) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        self.limits = [int(len(t) * max_distance) for _, t in self.items]
        self.forward: dict[int, Myers] = {}
        self.back: dict[int, Myers] = {}
        self.classes = []
        sizes = [c[0] for c in CLASSES]
        for k, (least, steps, stride) in enumerate(CLASSES):
            own = [(n, t) for n, (_, t) in enumerate(self.items) if len(t) >= least and (k == 0 or len(t) < sizes[k - 1])]
            if own:
                self.classes.append(Lsh(own, steps, stride, repetitions, samples))

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, end) with the best place of each item in each text."""
        gap = 97
        buf = np.frombuffer(b"".join(t + bytes(gap) for t in texts), np.uint8)
        base = np.concatenate([[0], np.cumsum([len(t) + gap for t in texts])])
        starts = window_starts(buf).astype(np.int32)
        found: dict[tuple[int, int], set[int]] = {}
        for lsh in self.classes:
            for at in range(0, len(starts), 1 << 16):
                for first, item, offset in lsh.find(buf, starts[at : at + (1 << 16)][:: lsh.stride]):
                    owner = np.searchsorted(base, first, "right") - 1
                    near = (first - base[owner] - offset) // 16
                    for d, i, s in set(zip(owner.tolist(), item.tolist(), near.tolist())):
                        found.setdefault((d, i), set()).add(s * 16)
        out = []
        for (d, i), places in sorted(found.items()):
            best = self._verify(texts[d], i, sorted(places))
            if best:
                out.append((d, i, *best))
        return out

    def _verify(self, text: bytes, i: int, places: list[int]) -> tuple[int, int, int] | None:
        pattern, limit = self.items[i][1], self.limits[i]
        if i not in self.forward:
            self.forward[i], self.back[i] = Myers(pattern), Myers(pattern[::-1])
        best, done = None, -1
        for s in places:
            left, right = max(0, s - limit), s + 16 + len(pattern) + limit
            if right <= done:
                continue
            done = right + 16  # the next place adds nothing within this
            region = text[left : right + 16]
            distance, end = self.forward[i].best(region)
            if distance <= limit and (best is None or distance < best[0]):
                back = self.back[i].best(region[:end][::-1])[1]
                best = (distance, left + end - back, left + end)
                if distance == 0:
                    break
        return best


def _slices(items: DataFrame, most_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items in slices that are safe to hand to every task, the size checked before they are fetched."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // most_bytes)) if total > most_bytes else 1
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == k).collect()
        if rows:
            yield sorted((r.item_id if r.item_id is not None else -1, r.text) for r in rows)


def _detector(docs: DataFrame, slice_: list, max_distance: float, repetitions: int, samples: int):
    shared = docs.sparkSession.sparkContext.broadcast(slice_)
    return lambda: Detector(shared.value, max_distance, repetitions, samples)


def _parts(batch: pa.RecordBatch, most: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    start, held, texts = 0, 0, []
    for row, t in enumerate(batch.column("text")):
        texts.append(normalise(t.as_py()))
        held += len(texts[-1])
        if held >= most:
            yield batch.slice(start, row + 1 - start), texts
            start, held, texts = row + 1, 0, []
    if texts:
        yield batch.slice(start), texts


def find_contamination(docs: DataFrame, items: DataFrame, max_distance: float = 0.1, repetitions: int = 6, samples: int = 16, most_bytes: int = 8_000_000) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, item_bytes, start, end.

    An item is found where the edit distance of its whole text to a part of the document is at most
    ``max_distance`` of its length, over lower-cased UTF-8 bytes with any white space as a space; start and end are
    bytes of the document in that form, of the best place. Null and blank texts have nothing; rows of repeated
    ids are judged one by one; other columns are ignored.

    An item that starts and ends inside one word of less than 24 bytes, of characters of one or two bytes, has no
    window there and is missed.
    The target recall is 0.9 of the passages within ``max_distance``, letters changed at random or whole words, for
    items of each class of lengths; a test measures it at the limit of 0.1. Windows are smaller than long items: a
    window of 64 steps reads about 32 bytes, and a document gives one at every second word. Exact copies are all
    found. More than ``most_bytes`` of items are worked off in slices, a pass over the documents each.
    """
    out, scratch, slices = None, Scratch(docs.sparkSession), 0
    for slice_ in _slices(items, most_bytes):
        make = _detector(docs, slice_, max_distance, repetitions, samples)

        def run(batches: Iterator[pa.RecordBatch], make=make) -> Iterator[pa.RecordBatch]:
            detector = make()
            for batch in batches:
                for part, texts in _parts(batch):
                    got = detector.search(texts)
                    if got:
                        ids = part.column("doc_id").to_pylist()
                        columns = [[ids[d] for d, *_ in got], [detector.items[i][0] for _, i, *_ in got], [g[2] for g in got], [len(detector.items[g[1]][1]) for g in got], [g[3] for g in got], [g[4] for g in got]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "item_bytes", "start", "end"])

        one = docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, item_id long, distance long, item_bytes long, start long, end long")
        # Past the first, what the slices find is written, so that a task runs one slice at a time.
        out = one if out is None else (scratch.save(out, "found0") if slices == 1 else out).unionByName(scratch.save(one, f"found{slices}"))
        slices += 1
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance long, item_bytes long, start long, end long")


def decontaminate(docs: DataFrame, items: DataFrame, max_distance: float = 0.1, repetitions: int = 6, samples: int = 16, most_bytes: int = 8_000_000) -> DataFrame:
    """``docs`` without those in which ``find_contamination`` finds an item; decided where they lie, without a join.

    Past one slice of items, what a slice leaves is written before the next one reads it.
    """
    scratch, slices = Scratch(docs.sparkSession), 0
    for slice_ in _slices(items, most_bytes):
        if slices:
            docs = scratch.save(docs, f"left{slices}")
            scratch.drop(f"left{slices - 1}")
        slices += 1
        make = _detector(docs, slice_, max_distance, repetitions, samples)

        def run(batches: Iterator[pa.RecordBatch], make=make) -> Iterator[pa.RecordBatch]:
            detector = make()
            for batch in batches:
                for part, texts in _parts(batch):
                    hit = {d for d, *_ in detector.search(texts)}
                    yield part.filter(pa.array([d not in hit for d in range(len(texts))]))

        docs = docs.mapInArrow(released(run), docs.schema)
    return docs
