"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Tokenising, cutting, assigning and checksums run in one pass over the input's partitions: packing needs no shuffle,
as a chunk of a few million tokens already packs without waste. Chunks are bounded by tokens, not rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import released

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
#: Fixed value: how byte-level vocabularies split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_SPACE = re.compile(r"\s{10000}")


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes, each text with ``end_id`` behind it.

    The ids are those of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``, so the string of an
    added token in a text is that token. A byte-level vocabulary with the usual split pattern is handed to
    tiktoken, whose merge loop gives the same ids in a fifth of the time; any other one, and a text that the loop
    gives up on (millions of spaces in a row), goes to the tokenizer itself.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        with open(path, encoding="utf-8") as f:
            self.fast = _merge_loop(json.load(f))

    def ids(self, text: str) -> bytes:
        if self.fast and not _LONG_SPACE.search(text):
            return array("I", self.fast.encode(text, allowed_special="all")).tobytes()
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.ids(t or "") + self.end for t in texts]


def _merge_loop(config: dict):
    """tiktoken's encoding of a tokenizer file, or None where the file asks for anything but plain byte-level merges."""
    model, split = config["model"], config["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    odd = [config["normalizer"], model.get("dropout"), model.get("unk_token"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"), model.get("byte_fallback"), model.get("ignore_merges")]
    added = config["added_tokens"]
    if not plain or any(odd) or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) or sys.byteorder != "little":
        return None
    # The vocabulary shows each byte as a character: itself where it is visible, else the next one from 256 on.
    hidden = [b for b in range(256) if b not in {*range(33, 127), *range(161, 173), *range(174, 256)}]
    byte = {chr(256 + hidden.index(b)) if b in hidden else chr(b): b for b in range(256)}
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(map(byte.__getitem__, token)): rank for token, rank in model["vocab"].items() if token not in special}
    # Merges in the order of the ids that they make are what lets ids stand for ranks.
    made = [ranks[bytes(map(byte.__getitem__, "".join(m if isinstance(m, list) else m.split(" "))))] for m in model["merges"]]
    if made != sorted(set(made)) or len(made) + 256 != len(ranks):
        return None
    import tiktoken

    return tiktoken.Encoding(config["model"]["type"], pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int]], list[float]]:
    """Pieces (document, start, length, sequence) and the cost of each sequence; no sequence has room left.

    Whole sequences are cut off long documents. The rests go, longest first, each to the sequence of lowest cost
    that has room for it; those that fit nowhere whole are cut over the sequences of lowest cost. The last
    sequences have the powers of two that make up what a full sequence would leave empty. A piece of n tokens
    costs ``linear * n + quadratic * n * n``, as attention stays inside it.
    """
    pieces, costs = [], []
    price = lambda n: linear * n + quadratic * n * n
    rests = []
    for d, n in enumerate(lengths):
        full = n // capacity
        for k in range(full):
            pieces.append((d, k * capacity, capacity, len(costs)))
            costs.append(price(capacity))
        if n % capacity:
            rests.append((n % capacity, d, full * capacity))
    total, base = sum(r[0] for r in rests), len(costs)
    rooms = [capacity] * (total // capacity) + [1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1]
    room, cost = np.array(rooms, np.int64), np.zeros(len(rooms))
    put = lambda d, start, n, s: (pieces.append((d, start, n, base + int(s))), room.__setitem__(s, room[s] - n), cost.__setitem__(s, cost[s] + price(n)))
    left = []
    for n, d, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        fits = np.where(room >= n, cost, np.inf)
        s = int(fits.argmin())
        if np.isfinite(fits[s]):
            put(d, start, n, s)
        else:
            left.append((n, d, start))
    for n, d, start in left:
        while n:
            s = int(np.where(room > 0, cost, np.inf).argmin())
            took = int(min(n, room[s]))
            put(d, start, took, s)
            n, start = n - took, start + took
    return pieces, [*costs, *cost.tolist()]


def pack_sequences(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, linear: float = 1.0, quadratic: float = 1 / 2048, chunk_tokens: int = 2_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost of the sequence.

    ``tokenizer`` is the path of a tokenizer file on every machine; ``end_id`` follows each document. Each token
    lies in exactly one piece, offsets in a sequence are gapless from 0, and only powers of two occur as lengths of
    sequences, so nothing is padded where ``capacity`` is one. Null and empty texts are the end id alone. Rows with
    equal or null doc_id are packed one by one. Documents are grouped in input order into chunks of
    ``chunk_tokens``; ``sequence_id`` holds the partition in its upper bits. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end_id)
        first = TaskContext.get().partitionId() << 33
        ids: list = []
        coded: list[bytes] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = encoder.encode(part.column(1).to_pylist())
                ids += part.column(0).to_pylist()
                coded += got
                held += sum(map(len, got)) // 4
                if held >= chunk_tokens:
                    out, count = _rows(ids, coded, capacity, linear, quadratic, first)
                    yield out
                    ids, coded, held, first = [], [], 0, first + count
        if ids:
            yield _rows(ids, coded, capacity, linear, quadratic, first)[0]

    return docs.select("doc_id", "text").mapInArrow(released(run), SCHEMA)


def _rows(ids: list, coded: list[bytes], capacity: int, linear: float, quadratic: float, first: int) -> tuple[pa.RecordBatch, int]:
    pieces, costs = assign([len(c) // 4 for c in coded], capacity, linear, quadratic)
    filled = [0] * len(costs)
    offsets = []
    for _, _, n, s in pieces:
        offsets.append(filled[s])
        filled[s] += n
    columns = [
        pa.array([ids[d] for d, *_ in pieces], pa.int64()),
        pa.array([p[1] for p in pieces], pa.int64()),
        pa.array([p[2] for p in pieces], pa.int64()),
        pa.array([zlib.crc32(memoryview(coded[d])[4 * start : 4 * (start + n)]) for d, start, n, _ in pieces], pa.int64()),
        pa.array([len(coded[p[0]]) // 4 for p in pieces], pa.int64()),
        pa.array([first + p[3] for p in pieces], pa.int64()),
        pa.array(offsets, pa.int64()),
        pa.array([costs[p[3]] for p in pieces], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")]), len(costs)
