"""Language identification by interpolated Kneser-Ney character models.

Training counts tokens per task, turns distinct tokens into character 4-grams there and sums those with one small
shuffle; all training texts count. Each model is a set of sorted hash arrays. Scoring looks distinct tokens up once
and adds their log-probabilities over the whole text. Models are cut into slices of a bounded size by the two middle
characters of their 4-grams. Shorter grams are counted by Spark and sent along, so that one task makes a slice from
its own rows; each slice scores its own grams in a pass of its own, and the sums are those of the whole model.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, released

ORDER = 4
_ALNUM = re.compile(r"[^\W\d_]+")
_PAD = " " * (ORDER - 1)


def letters(token: str) -> list[str]:
    """Runs of letters (Unicode's category L); figures like a superscript two are none."""
    if token.isalpha():
        return [token]
    return [w for run in _ALNUM.findall(token) for w in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of padded words, each ending at a letter or at the space behind a word; and the word of each.

    A character is a UTF-16 code unit, so that keys are exact: a letter beyond 16 bits counts as two, neither of which
    is a space or any other letter.
    """
    text = _PAD + _PAD.join(words) + _PAD
    chars = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint64)
    keys = (chars[:-3] << np.uint64(48)) | (chars[1:-2] << np.uint64(32)) | (chars[2:-1] << np.uint64(16)) | chars[3:]
    inside = (chars[3:] != 32) | (chars[2:-1] != 32)
    lengths = np.array([len(w) for w in words] if len(chars) == len(text) else [len(w.encode("utf-16-le", "surrogatepass")) // 2 for w in words], np.int64)
    return keys[inside], np.repeat(np.arange(len(words)), lengths + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in tokens.items():
            words: Counter = Counter()
            for token, n in counts.items():
                for w in letters(token):
                    words[w] += n
            if words:
                keys, owner = _grams(list(words))
                distinct, at = np.unique(keys, return_inverse=True)
                sums = np.bincount(at, weights=np.fromiter(words.values(), np.float64, len(words))[owner])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(distinct)), pa.array(distinct.view(np.int64)), pa.array(sums.astype(np.int64))], ["lang", "gram", "n"])
        tokens.clear()

    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            counts = tokens[lang.as_py()]
            before = len(counts)
            counts.update(text.as_py().lower().split())
            held += len(counts) - before
            if held > 80_000:
                yield from flush()
                held = 0
    yield from flush()


@dataclass
class Model:
    """``keys[o]`` are the sorted grams of order o that any language has, ``logs[o]`` the log-probability of the
    last character in each language; ``backs[o]`` are contexts of o characters with the log of what they leave
    to the shorter context in each language. Only grams whose place (see ``_place``) is in ``span`` are scored;
    ``rest`` are the numbers of the slices with the others, which ``stored`` holds."""

    langs: list[str]
    keys: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    backs: dict[int, np.ndarray]
    floor: float
    scale: float = 1.0
    limits: tuple[np.ndarray, np.ndarray] | None = None
    span: tuple[int, int] = (0, 1 << 32)
    rest: list[int] = field(default_factory=list)
    stored: DataFrame | None = None

    def words(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word in each language, and in the last column the number of characters scored."""
        keys, owner = _grams(words)
        if self.span != (0, 1 << 32):
            at = (keys & np.uint64(0xFFFF0000)) | ((keys >> np.uint64(32)) & np.uint64(0xFFFF))
            own = (at >= np.uint64(self.span[0])) & (at < np.uint64(self.span[1]))
            keys, owner = keys[own], owner[own]
        if not self.langs:  # nothing was learned
            return np.bincount(owner, minlength=len(words))[:, None].astype(float)
        got = np.zeros((len(keys), len(self.langs)))
        open_ = np.arange(len(keys))
        for o in range(ORDER, 0, -1):
            part = keys[open_] & np.uint64((1 << 16 * o) - 1)
            at = np.searchsorted(self.keys[o], part)
            at[at == len(self.keys[o])] = 0
            hit = self.keys[o][at] == part
            got[open_[hit]] += self.logs[o][at[hit]]
            open_, part = open_[~hit], part[~hit]
            if not len(open_):
                break
            if o > 1:
                context = part >> np.uint64(16)
                at = np.searchsorted(self.contexts[o - 1], context)
                at[at == len(self.contexts[o - 1])] = 0
                hit = self.contexts[o - 1][at] == context
                got[open_[hit]] += self.backs[o - 1][at[hit]]
            else:
                got[open_] += self.floor
        out = np.zeros((len(words), len(self.langs) + 1))
        np.add.at(out[:, :-1], owner, got)
        out[:, -1] = np.bincount(owner, minlength=len(words))
        return out


@dataclass
class Whole:
    """What a slice needs of all slices: by language single characters, and pairs of which the slice has the first,
    with their counts; by order and language how many grams count once and twice."""

    single: dict[str, tuple[np.ndarray, np.ndarray]]
    pairs: dict[str, tuple[np.ndarray, np.ndarray]]
    rare: dict[tuple[int, str], tuple[int, int]]


def kneser_ney(rows: dict[str, tuple[np.ndarray, np.ndarray]], whole: Whole | None = None, span: tuple[int, int] = (0, 1 << 32)) -> Model:
    """The model from each language's 4-grams and their counts; of one slice where ``whole`` is given."""
    langs = sorted(rows)
    singles = [k & np.uint64(0xFFFF) for k, _ in (whole.single if whole else rows).values()]
    vocabulary = len(np.unique(np.concatenate(singles))) + 1
    tables = {}
    for lang in langs:
        keys, counts = rows[lang]
        order = np.argsort(keys)
        by_order = {ORDER: (keys[order], counts[order].astype(np.float64))}
        for o in range(ORDER - 1, 0, -1):  # below the top, a gram counts the distinct characters before it
            k, n = np.unique(by_order[o + 1][0] & np.uint64((1 << 16 * o) - 1), return_counts=True)
            by_order[o] = (k, n.astype(np.float64))
        if whole:
            by_order[1], by_order[2] = whole.single[lang], whole.pairs[lang]
        tables[lang] = by_order
    keys = {o: np.unique(np.concatenate([tables[x][o][0] for x in langs])) for o in range(1, ORDER + 1)}
    contexts = {o: np.unique(keys[o + 1] >> np.uint64(16)) for o in range(1, ORDER)}
    probs, backs = {}, {}
    for o in range(1, ORDER + 1):
        probs[o] = np.zeros((len(keys[o]), len(langs)))
        if o > 1:
            backs[o - 1] = np.zeros((len(contexts[o - 1]), len(langs)))
        for j, lang in enumerate(langs):
            k, n = tables[lang][o]
            once, twice = whole.rare[o, lang] if whole else ((n == 1).sum(), (n == 2).sum())
            discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
            if o == 1:
                total = n.sum()
                lower = np.full(len(keys[1]), 1 / vocabulary)
                own = np.zeros(len(keys[1]))
                own[np.searchsorted(keys[1], k)] = n - discount
                probs[1][:, j] = own / total + discount * len(k) / total * lower
                continue
            context, at = np.unique(k >> np.uint64(16), return_inverse=True)
            totals, distinct = np.bincount(at, weights=n), np.bincount(at)
            left = np.ones(len(contexts[o - 1]))
            left[np.searchsorted(contexts[o - 1], context)] = discount * distinct / totals
            backs[o - 1][:, j] = left
            lower = probs[o - 1][np.searchsorted(keys[o - 1], keys[o] & np.uint64((1 << 16 * (o - 1)) - 1)), j]
            own = np.zeros(len(keys[o]))
            own[np.searchsorted(keys[o], k)] = np.maximum(n - discount, 0) / totals[at]
            probs[o][:, j] = own + left[np.searchsorted(contexts[o - 1], keys[o] >> np.uint64(16))] * lower
    logs = {o: np.log(np.maximum(p, 1e-12)).astype(np.float32) for o, p in probs.items()}
    return Model(langs, keys, logs, contexts, {o: np.log(b).astype(np.float32) for o, b in backs.items()}, float(np.log(0.5 / vocabulary)), span=span)


def _score(model, before: str | None = None, most: int = 200_000):
    """Appends log-likelihoods of each text by language and the number of characters scored, those of the column
    ``before`` included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        known: dict[str, int] = {}
        table = np.zeros((1024, len(m.langs) + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [(t.as_py() or "").lower().split() for t in part.column("text")]
                if len(known) > most:
                    known.clear()
                new = list({t for tokens in texts for t in tokens} - known.keys())
                if len(known) + len(new) > len(table):
                    table = np.concatenate([table[: len(known)], np.zeros((2 * len(new) + len(known), table.shape[1]))])
                if new:
                    runs = [letters(t) for t in new]
                    words = [w for r in runs for w in r]
                    values = np.zeros((len(new), table.shape[1]))
                    if words:
                        np.add.at(values, np.repeat(np.arange(len(new)), [len(r) for r in runs]), m.words(words))
                    table[len(known) : len(known) + len(new)] = values
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                out = np.zeros((len(texts), table.shape[1]))
                for i, tokens in enumerate(texts):
                    if tokens:
                        out[i] = table[np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))].sum(axis=0)
                if before:
                    out += part.column(before).flatten().to_numpy().reshape(out.shape)
                    part = part.drop_columns([before])
                yield part, out

    return run


def _through(docs: DataFrame, model: Model) -> tuple[DataFrame, str | None]:
    """``docs`` with a column of the sums of all slices but the first, and its name; written after each slice."""
    if not model.rest:
        return docs, None
    name = "sums"
    while name in docs.columns:
        name += "_"
    scratch, kept = Scratch(docs.sparkSession), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for k, number in enumerate(model.rest):
        part = docs.sparkSession.sparkContext.broadcast(_load(model.stored, number))
        score = _score(part, name if k else None)

        def run(batches: Iterator[pa.RecordBatch], score=score) -> Iterator[pa.RecordBatch]:
            for rows, out in score(batches):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out.tolist(), pa.list_(pa.float64()))], [*rows.schema.names, name])

        docs = scratch.save(docs.mapInArrow(released(run), f"{kept}, `{name}` array<double>"), f"slice{k}")
        part.destroy()
        if k:
            scratch.drop(f"slice{k - 1}")
    return docs, name


#: Scales of the posterior that are tried, and bins of cross-entropy per nat.
SCALES, BINS = np.geomspace(0.1, 20, 40), 4096


def _scored(model, before: str | None):
    """Rows with letters as (mark, lang, v): the digest of text and language, the language, and their ``_score``."""
    score = _score(model, before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, out in score(batches):
            at = np.flatnonzero(out[:, -1] > 0)
            yield pa.RecordBatch.from_arrays([part.column("mark").take(at), part.column("lang").take(at), pa.array(out[at].tolist(), pa.list_(pa.float64()))], ["mark", "lang", "v"])

    return run


def _measured(langs: list[str]):
    """(lang, bin, n, size, x, xx): without a language, n rows and the sum x of their losses for each of ``SCALES``; with
    one, the rows of a bin of cross-entropy, their characters, and these times entropy and its square."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            truth = pc.index_in(batch.column("lang"), pa.array(langs)).to_numpy()
            n, entropy = v[:, -1], -v[:, :-1] / v[:, -1:]
            own, loss = entropy[np.arange(len(v)), truth], np.zeros(len(SCALES))
            for k, scale in enumerate(SCALES):
                logit = -entropy * scale * np.sqrt(n)[:, None]
                logit -= logit.max(axis=1, keepdims=True)
                loss[k] = (np.log(np.exp(logit).sum(axis=1)) - logit[np.arange(len(v)), truth]).sum()
            cells, at = np.unique(np.stack([truth, np.floor(own * BINS).astype(np.int64)]), axis=1, return_inverse=True)
            sums = [np.bincount(at.ravel(), weights=w) for w in (np.ones(len(v)), n, n * own, n * own**2)]
            none = np.zeros(len(SCALES))
            columns = [np.concatenate(x) for x in zip((np.arange(len(SCALES)), none + len(v), none, loss, none), (cells[1], *sums))]
            names = pa.array([None] * len(SCALES) + [langs[j] for j in cells[0]], pa.string())
            yield pa.RecordBatch.from_arrays([names, *[pa.array(c, pa.int64() if i < 2 else pa.float64(), safe=False) for i, c in enumerate(columns)]], ["lang", "bin", "n", "size", "x", "xx"])

    return run


def _middle(cells: list) -> float:
    """Median of binned values, to half a bin."""
    cells = sorted(cells, key=lambda r: r.bin)
    upto = np.cumsum([r.n for r in cells])
    ends = [cells[int(np.searchsorted(upto, k))].bin for k in ((upto[-1] + 1) // 2, upto[-1] // 2 + 1)]
    return (sum(ends) / 2 + 0.5) / BINS


def _calibrate(model: Model, sums: list) -> None:
    """Sets the scale of the posterior and each language's limit of cross-entropy from the sums of ``_measured``."""
    losses = [r for r in sums if r.lang is None]
    if not losses:
        return
    model.scale = min((r.x / r.n, SCALES[r.bin]) for r in losses)[1]
    cells = [r for r in sums if r.lang is not None]
    mean, spread = np.zeros(len(model.langs)), np.zeros(len(model.langs))
    for j, lang in enumerate(model.langs):
        own = [r for r in cells if r.lang == lang]
        mean[j] = _middle(own or cells)
        size, x, xx, n = (sum(getattr(r, k) for r in own) for k in ("size", "x", "xx", "n"))
        spread[j] = np.sqrt(max(0.0, xx - 2 * mean[j] * x + mean[j] ** 2 * size) / n) if own else 1.0
    model.limits = (mean, spread)


def _place() -> Column:
    """A 4-gram's two middle characters as a number, the third first."""
    return F.shiftleft(_first(2), 16).bitwiseOR(_first(3))


def _first(o: int) -> Column:
    """First character of the last ``o`` of a gram."""
    return F.shiftrightunsigned("gram", 16 * (o - 1)).bitwiseAND(F.lit(0xFFFF))


def _starts(counts: DataFrame, langs: int, most_grams: int) -> list[int]:
    """Places at which slices start: each has at most ``most_grams`` rows, and four cells of the model to each.

    Slices are cut between third characters, and between second ones where a third character has more grams than
    that. The driver sees one number per character, of which there are at most 65,536, and as many for each of these.
    """
    size = F.greatest(F.sum("n"), F.floor(F.count("*") * langs / 4)).alias("size")
    grams = counts.groupBy("gram").agg(F.count("*").alias("n"))
    third = {r.c: r.size for r in grams.groupBy(_first(2).alias("c")).agg(size).collect()}
    parts = {c << 16: n for c, n in third.items() if n <= most_grams}
    large = [c for c, n in third.items() if n > most_grams]
    if large:
        parts |= {r.c: r.size for r in grams.where(_first(2).isin(large)).groupBy(_place().alias("c")).agg(size).collect()}
    starts, held = [0], 0
    for c in sorted(parts):
        if held and held + parts[c] > most_grams:
            starts.append(c)
            held = 0
        held += parts[c]
    return starts


def _slice_rows(counts: DataFrame, langs: list[str], starts: list[int], scratch: Scratch) -> tuple[DataFrame, dict[tuple[int, str], tuple[int, int]]]:
    """(slice, o, lang, gram, n): 4-grams in their slice, pairs in all slices of their first character, single
    characters in all; and by order and language how many grams count once and twice."""
    orders = {ORDER: counts}
    for o in range(ORDER - 1, 0, -1):
        shorter = orders[o + 1].groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * o) - 1)).alias("gram")).agg(F.count("*").alias("n"))
        orders[o] = scratch.save(shorter, f"grams{o}")
    rare = {(o, x): (0, 0) for o in orders for x in langs}
    for o, df in orders.items():
        rare |= {(o, r.lang): (r.once, r.twice) for r in df.groupBy("lang").agg(F.expr("count_if(n = 1)").alias("once"), F.expr("count_if(n = 2)").alias("twice")).collect()}

    def slice_of(place: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= place)) - 1 if len(starts) > 1 else F.lit(0)

    def sent(o: int, first: Column, last: Column) -> DataFrame:
        return orders[o].select(F.explode(F.sequence(first, last)).alias("slice"), F.lit(o).alias("o"), "lang", "gram", "n")

    char = F.shiftleft(_first(2), 16)
    own = slice_of(_place())
    return sent(ORDER, own, own).union(sent(2, slice_of(char), slice_of(char + 0xFFFF))).union(sent(1, F.lit(0), F.lit(len(starts) - 1))), rare


def _make(langs: list[str], starts: list[int], rare: dict[tuple[int, str], tuple[int, int]], piece: int = 1 << 22):
    """A slice's rows to its model, pickled and cut into pieces."""
    ends = [*starts[1:], 1 << 32]

    def run(rows: pa.Table) -> pa.Table:
        k = rows["slice"][0].as_py()
        o, lang = rows["o"].to_numpy(), pc.index_in(rows["lang"], pa.array(langs)).to_numpy()
        gram, n = rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy()

        def table(order: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
            out = {}
            for j, x in enumerate(langs):
                at = np.flatnonzero((o == order) & (lang == j))
                at = at[np.argsort(gram[at])]
                out[x] = (gram[at], n[at].astype(np.float64))
            return out

        data = pickle.dumps(kneser_ney(table(ORDER), Whole(table(1), table(2), rare), (starts[k], ends[k])), 5)
        schema = pa.schema([("slice", pa.int32()), ("at", pa.int64()), ("data", pa.binary())])
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at]), pa.array([data[at : at + piece]])], schema=schema) for at in range(0, len(data), piece)])

    return run


def _load(stored: DataFrame, number: int) -> Model:
    return pickle.loads(b"".join(r.data for r in sorted(stored.where(F.col("slice") == number).collect(), key=lambda r: r.at)))


def train_language_models(training: DataFrame, most_grams: int = 4_000_000) -> Model:
    """Models from ``training(doc_id, text, lang)``; null texts and languages are left out.

    All texts and all their 4-grams count. Calibration uses every distinct text of a language: all are scored, and the
    driver gets sums by scale and by bin of cross-entropy, whose number doesn't grow with the table.
    A task holds about ``most_grams`` 4-grams at once. Each slice of the model is made in a task of its own and kept
    in the shared folder; the driver passes on one at a time. Results are the same for any number of slices, but each
    past the first costs another pass over the texts.
    """
    training = training.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    spark, scratch = training.sparkSession, Scratch(training.sparkSession)
    counts = training.select("lang", "text").mapInArrow(released(_count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = scratch.save(counts, "grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([], {}, {}, {}, {}, 0.0)
    starts = _starts(counts, len(langs), most_grams)
    rows, rare = _slice_rows(counts, langs, starts, scratch)
    stored = scratch.save(rows.groupBy("slice").applyInArrow(_make(langs, starts, rare), "slice int, at long, data binary"), "slices")
    scratch.drop("grams", *[f"grams{o}" for o in range(1, ORDER)])
    model = _load(stored, 0)
    model.rest, model.stored = list(range(1, len(starts))), stored
    rows, before = _through(training.select(F.xxhash64("lang", "text").alias("mark"), "text", "lang"), model)
    shared = spark.sparkContext.broadcast(replace(model, rest=[], stored=None))
    scored = rows.mapInArrow(released(_scored(shared, before)), "mark long, lang string, v array<double>")
    once = scored.groupBy("mark", "lang").agg(F.first("v").alias("v")).select("lang", "v")
    sums = once.mapInArrow(_measured(langs), "lang string, bin long, n long, size double, x double, xx double").groupBy("lang", "bin")
    _calibrate(model, sums.agg(*[F.sum(c).alias(c) for c in ("n", "size", "x", "xx")]).collect())
    return model


def identify_language(docs: DataFrame, model: Model, reject_spreads: float = 8.0, reject_margin: float = 0.75) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy and rejected; a column of such a name is replaced.

    lang_pred has the lowest length-normalised cross-entropy, the first in order of names on ties; ``und`` where
    the text is null or has no letter (score 0). score is the calibrated posterior. A text is rejected where it is
    ``und`` or its cross-entropy is above the language's middle by more than ``reject_margin`` and
    ``reject_spreads`` spreads of its length.
    Every row gives one row, repeated ones too.
    """
    new = ["lang_pred", "score", "cross_entropy", "rejected"]
    docs = docs.drop(*new)
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, rest=[], stored=None))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, score double, cross_entropy double, rejected boolean"
    docs, before = _through(docs, model)
    score = _score(shared, before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        names = np.array([*m.langs, "und"], object)
        for part, v in score(batches):
            n = np.maximum(v[:, -1:], 1)
            if m.langs:
                entropy = -v[:, :-1] / n
                best = entropy.argmin(axis=1)
                low = entropy[np.arange(len(v)), best]
                weight = np.exp(-(entropy - low[:, None]) * m.scale * np.sqrt(n))
                certain = 1 / weight.sum(axis=1)
            else:
                best, low, certain = np.zeros(len(v), int), np.zeros(len(v)), np.zeros(len(v))
            none = (v[:, -1] == 0) if m.langs else np.ones(len(v), bool)
            away = none.copy()
            if m.limits is not None:
                away |= low > m.limits[0][best] + reject_margin + reject_spreads * m.limits[1][best] / np.sqrt(n[:, 0])
            added = [pa.array(names[np.where(none, len(m.langs), best)], pa.string()), pa.array(np.where(none, 0.0, certain)), pa.array(np.where(none, 0.0, low)), pa.array(away)]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *new])

    return docs.mapInArrow(released(run), schema)
