"""URL filter: all glob rules run at once over a URL as one bit-parallel wildcard automaton."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ONE, _TOP = np.uint64(1), np.uint64(63)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        """``*`` stands for any run without a slash, ``**`` for any run."""
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


class Automaton:
    """Shift-And over bytes, for globs packed into words of 64 bits, vectorised over the URLs of a batch.

    A glob's bits are its literal bytes plus a start and, for each wildcard, none: a wildcard lets the bit before it
    stay set while bytes pass. Bits shift over word ends, so a glob may lie across words.
    """

    def __init__(self, globs: list[str]):
        bits = 0
        spans = []
        for glob in globs:
            tokens = self._tokens(glob)
            spans.append((bits, tokens))
            bits += 1 + sum(1 for kind, _ in tokens if kind == "byte")
        self.words = max(1, -(-bits // 64))
        self.start = np.zeros(self.words, np.uint64)
        self.step = np.zeros((256, self.words), np.uint64)  # by byte: states that it may enter
        self.stay = np.zeros((256, self.words), np.uint64)  # by byte: states that it may stay in
        self.final = []
        for first, tokens in spans:
            at = first
            self._set(self.start, at)
            for kind, value in tokens:
                if kind == "byte":
                    at += 1
                    self._set(self.step[value], at)
                else:
                    for byte in range(256):
                        if kind == "any" or byte != 0x2F:
                            self._set(self.stay[byte], at)
            self.final.append((at // 64, np.uint64(at % 64)))

    @staticmethod
    def _tokens(glob: str) -> list[tuple[str, int]]:
        tokens: list[tuple[str, int]] = []
        parts = glob.split("**")
        for k, part in enumerate(parts):
            if k:
                tokens.append(("any", 0))
            for j, run in enumerate(part.split("*")):
                if j:
                    tokens.append(("segment", 0))
                tokens += [("byte", b) for b in run.encode()]
        return tokens

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << bit % 64)

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Which globs match each whole text, as (text, glob) booleans."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        width = int(lengths.max(initial=0))
        buf = np.frombuffer(b"".join(texts), np.uint8)
        base = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
        state = np.tile(self.start, (len(texts), 1))
        live = np.searchsorted(-lengths[order], -np.arange(width), "left")
        for k in range(width):
            n = live[k]
            c = buf[base[:n] + k]
            now = state[:n]
            moved = now << _ONE
            moved[:, 1:] |= now[:, :-1] >> _TOP
            state[:n] = (moved & self.step[c]) | (now & self.stay[c])
        out = np.zeros((len(texts), len(self.final)), bool)
        for g, (word, bit) in enumerate(self.final):
            out[order, g] = state[:, word] >> bit & _ONE
        return out


def split_url(url: str | None) -> tuple[str, str]:
    """(host in lower case, path); both empty where the URL is null or has no ``://``."""
    _, scheme, rest = (url or "").partition("://")
    if not scheme:
        return "", ""
    end = min((p for p in (rest.find(c) for c in "/?#") if p >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((p for p in (rest.find(c) for c in "?#") if p >= 0), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages(page_id, url)``.

    Of the rules that fit, the longest (host and path together) wins, the first of equal ones; rule is its host and
    path, null where none fits, and the verdict then is ``default``. Null and malformed URLs have an empty host and
    path and fit no rule. Repeated rows are judged one by one; no row is lost or moved. Other columns are ignored.
    """
    ranked = sorted(range(len(rules)), key=lambda k: (-len(rules[k].name), k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([g for k in ranked for g in rules[k].globs()])
        names = np.array([*(rules[k].name for k in ranked), None], object)
        verdicts = np.array([*(rules[k].verdict for k in ranked), default], object)
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                split = [split_url(u) for u in part.column(1).to_pylist()]
                hit = automaton.match([(h + p).encode("utf-8", "surrogatepass") for h, p in split])
                fits = hit.reshape(len(split), len(ranked), 2).any(axis=2)
                first = np.where(fits.any(axis=1), fits.argmax(axis=1), len(ranked)) if ranked else np.zeros(len(split), int)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s[0] for s in split], pa.string()), pa.array([s[1] for s in split], pa.string()), pa.array(names[first], pa.string()), pa.array(verdicts[first], pa.string())],
                    ["page_id", "host", "path", "rule", "verdict"],
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
