"""License scans: template fingerprints pick candidates, banded alignment reports coverage and spans.

Templates are the whole texts and headers in ``license_texts`` and one-line notices. They are winnowed where a
winnowed gram outlives all changed words that the coverage allows; else every gram counts, of fewer words where need
be. A long template is aligned only where as many of its fingerprints meet near one diagonal as must be left.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordHashes, gram_hashes

#: Well-known public notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
}
GRAM, WINDOW = 3, 2


@cache
def known_templates() -> dict[str, str]:
    """Notices, and the whole texts (``-text``) and standard headers (``-header``) that come with the package."""
    folder = Path(__file__).parent / "license_texts"
    return {**NOTICES, **{f.stem: f.read_text(encoding="utf-8") for f in sorted(folder.glob("*.txt"))}}


class _Words(WordHashes):
    """Hashes of words in lower case without the punctuation around them."""

    def __missing__(self, word: str) -> int:
        plain = word.lower().strip(".,;:!?()[]{}\"'*#/")
        value = super().__missing__(plain) if plain != word else super().__missing__(word)
        self[word] = value
        return value


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the least hash of each window, the rightmost on ties."""
    if len(grams) <= window:
        return np.array([int(len(grams) - 1 - grams[::-1].argmin())]) if len(grams) else np.zeros(0, np.int64)
    frames = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(len(frames)) + window - 1 - frames.argmin(axis=1))


def align(a: list[int], b: list[int], shift: int, band: int) -> tuple[int, int, int]:
    """Best local alignment of template ``a`` with ``b`` where b's position is within ``band`` of a's plus ``shift``.

    Returns matched words and the span of b; a match earns 2, a change or gap costs 1.
    """
    best = (0, 0, 0, 0)  # score, matched, start, end
    above: dict[int, tuple[int, int, int]] = {}
    for i, x in enumerate(a):
        row: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + shift - band), min(len(b), i + shift + band + 1)):
            score, matched, start = above.get(j - 1, (0, 0, j))
            if x == b[j]:
                cell = (score + 2, matched + 1, start if matched else j)
            else:
                cell = (score - 1, matched, start)
            for s, m, t in (above.get(j, (0, 0, j)), row.get(j - 1, (0, 0, j))):
                if s - 1 > cell[0]:
                    cell = (s - 1, m, t)
            if cell[0] <= 0:
                continue
            row[j] = cell
            if cell[0] > best[0]:
                best = (cell[0], cell[1], cell[2], j + 1)
        above = row
    return best[1:]


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float, band: int):
        self.hashes, self.names, self.words = _Words(), list(templates), []
        self.least, self.bands, self.hits = min_coverage, [], []
        index: dict[int, list[tuple[int, int, int]]] = {}
        for k, text in enumerate(templates.values()):
            words = self.hashes.array(text.split())
            self.words.append(words.tolist())
            # Changed or missing words that the coverage allows, and the run of words that they leave at least.
            edits = len(words) - math.ceil(min_coverage * len(words) - 1e-9)
            run = -(-(len(words) - edits) // (edits + 1))
            self.bands.append(max(band, min(16, len(words) // 50)))
            # A changed word breaks as many windows as it lies in; a window left is one of WINDOW with its fingerprint.
            windows = len(words) - GRAM - WINDOW + 2 - (GRAM + WINDOW - 1) * (edits + self.bands[-1])
            self.hits.append(max(1, windows // WINDOW))
            n = max(1, min(GRAM, run))
            grams = gram_hashes(words, n)
            index.setdefault(n, []).extend((int(grams[p]), k, int(p)) for p in (winnow(grams) if run >= GRAM + WINDOW - 1 else range(len(grams))))
        self.tables = []
        for n, posts in sorted(index.items()):
            posts.sort()
            keys, filter_ = np.array([g for g, _, _ in posts], np.uint64), np.zeros(1 << 16, bool)
            filter_[keys >> np.uint64(48)] = True
            self.tables.append((n, keys, [(k, p) for _, k, p in posts], filter_))

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched words, first word, word behind the last) of spans that don't overlap."""
        words = self.hashes.array(text.split())
        places: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0, 0])
        for n, keys, posts, filter_ in self.tables:
            grams = gram_hashes(words, n)
            at = np.flatnonzero(filter_[grams >> np.uint64(48)])
            low, high = np.searchsorted(keys, grams[at], "left"), np.searchsorted(keys, grams[at], "right")
            for g, s, e in zip(at.tolist(), low.tolist(), high.tolist()):
                for k, p in posts[s:e]:
                    place = places[k, (g - p) // (self.bands[k] + 1)]
                    place[0], place[1] = place[0] + 1, place[1] if place[0] else g - p
        found = set()
        for (k, b), (_, start) in list(places.items()):
            if sum(places[k, near][0] for near in range(b - 2, b + 3) if (k, near) in places) < self.hits[k]:
                continue
            a, wide = self.words[k], 2 * self.bands[k]
            left = max(0, start - wide)
            matched, s, e = align(a, words[left : start + len(a) + wide + 1].tolist(), start - left, wide)
            if matched >= self.least * len(a):
                found.add((matched, k, left + s, left + e))
        out: list[tuple[str, float, int, int, int]] = []
        taken: list[tuple[int, int]] = []
        for matched, k, s, e in sorted(found, key=lambda f: (-f[0], -f[0] / len(self.words[f[1]]), f[1], f[2])):
            if all(e <= t or s >= u for t, u in taken):
                taken.append((s, e))
                out.append((self.names[k], matched / len(self.words[k]), matched, s, e))
        return sorted(out, key=lambda x: x[3])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = 0.8, band: int = 4) -> DataFrame:
    """One row per span of a license notice: doc_id, license, coverage, matched_words, start_word, end_word.

    Words are split at white space and compared in lower case without punctuation around them. A template is
    reported where an alignment within ``2 * band`` words of a fingerprint's diagonal (more for long templates)
    matches ``min_coverage`` of its words; of overlapping spans the one with more matched words stays, of these the
    one with the higher coverage, then the first template. Null, empty and clean texts give no row,
    repeated rows are scanned one by one, other columns are ignored. Nothing is shuffled.
    """
    templates = known_templates() if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_coverage, band)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [(i, *f) for i, t in zip(part.column(0).to_pylist(), part.column(1)) if t.is_valid for f in scanner.scan(t.as_py())]
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "license", "coverage", "matched_words", "start_word", "end_word"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, license string, coverage double, matched_words long, start_word long, end_word long")
