"""Corpus operators against brute force, round trips and held-out labels on small tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, and clashing extra columns."""
    rng = random.Random(3)
    long_text = words(rng, 40_000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n ", "en", "a", 3), (4, "one two", "en", None, 7), (4, "one two", "en", None, 7), (5, long_text, "en", "b", 1), (6, long_text + " x", None, "b", 1), (None, "no id here", "en", "a", 1)]
    schema = DOCS + ", n long, sig string, key string, c long, score double, rejected string, quality string, row long, shard int"
    return spark.createDataFrame([(*r, 1, "s", "k", 2, 0.5, "r", "q", 3, 4) for r in rows], schema)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_links(rows):
    def shingles(t):
        w = (t or "").lower().split()
        n = min(5, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets = [(d, shingles(t)) for d, t in rows]
    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(k)
    up, links = list(range(len(sets))), Counter()

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for k, (d, s) in enumerate(sets):
        for o, n in Counter(o for g in s for o in where[g] if o != k).items():
            if n / len(s | sets[o][1]) >= 0.8:
                links[k] += 1
                up[max(root(k), root(o))] = min(root(k), root(o))
    least = {}
    for k, (d, _) in enumerate(sets):
        least[root(k)] = min(d, least.get(root(k), d))
    return sorted((d, least[root(k)], links[k]) for k, (d, _) in enumerate(sets))


def test_buckets_that_cannot_improve_a_group_are_not_sent(spark, monkeypatch):
    """Long vectors settle the queries: of the buckets of short ones none is paired, and results are as by brute force."""
    from admitflow.llm import topk_search

    counted, pairs_left = [], topk_search.pairs_left

    def counting(buckets, blocks):
        pairs = pairs_left(buckets, blocks)
        counted.append((pairs.count(), buckets.count() * blocks.select("group").distinct().count()))
        return pairs

    monkeypatch.setattr(topk_search, "pairs_left", counting)
    rng = np.random.default_rng(3)
    n = 5 * topk_search.BUCKET
    vectors = rng.normal(size=(n, 6)) * np.where(np.arange(n) < 5000, 50.0, 0.02)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = topk_search.top_k_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 1000 = 0").collect()
    whole = np.floor(vectors * 256)
    for q in range(0, n, 1000):
        scores = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(n), -scores)).tolist() if i != q][:5]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) == [(k + 1, i, int(scores[i])) for k, i in enumerate(best)]
    (sent, every), = counted
    assert every >= 5 and 0 < sent <= every // 2


def test_join_of_many_texts_under_one_id(spark):
    """Classes and rows of one doc_id don't multiply: 5,000 rows, of which pairs are near copies."""
    import time

    from admitflow.llm.ngram_join import ngram_jaccard_join

    rng = random.Random(8)
    texts = []
    for _ in range(2500):
        base = words(rng, 60).split()
        texts += [" ".join(base), " ".join([*base[:-1], "other"])]
    took = []
    for ids in (range(len(texts)), [7] * len(texts)):
        began = time.perf_counter()
        got = ngram_jaccard_join(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")).collect()
        took.append(time.perf_counter() - began)
        assert len(got) == 5000 and {r.n_links for r in got} == {1}
    assert took[1] < 3 * took[0] + 10


def test_sampled_walks_are_kept_as_bits():
    from admitflow.llm.decontam import Lsh

    rng = random.Random(5)
    items = [(i, words(rng, 40).encode()) for i in range(300)]
    lsh = Lsh(items, 64, 2, 6, 16)
    assert sum(t.nbytes for _, _, seen, *_ in lsh.tables for t in seen.values()) <= 6 * 16 * 2**19
    buf = np.frombuffer(items[11][1] + bytes(97), np.uint8)
    assert any((item == 11).any() for _, item, _ in lsh.find(buf, np.array([0], np.int32)))


def test_join_finds_every_link(spark):
    from admitflow.llm.ngram_join import ngram_jaccard_join

    rng = random.Random(1)
    rows = []
    for group in range(12):
        base = words(rng, rng.randint(20, 200)).split()
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randint(0, 3))
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, "a b"), (1001, "a b"), (1002, "a b c"), (1003, ""), (1004, None)]
    got = ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block=7).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute_links(rows)


def test_join_on_odd_rows(spark, odd):
    from admitflow.llm.ngram_join import ngram_jaccard_join

    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_jaccard_join(odd).collect())
    assert got == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (4, 4, 1), (5, 5, 1), (6, 5, 1)]
    assert ngram_jaccard_join(empty(spark)).count() == 0


def test_cutoffs_keep_what_may_reach_the_threshold():
    from admitflow.llm.ngram_join import cutoffs

    steps = cutoffs(0.8, 1e-6)
    assert [n for n, _ in steps] == [32, 64, 96, 128, 160]
    assert all(0 < m < 0.8 * n for n, m in steps)


def test_top_k_equals_brute_force(spark):
    from admitflow.llm.topk_search import top_k_search

    rng = np.random.default_rng(5)
    v = rng.normal(size=(600, 8)) * rng.choice([0.2, 1, 3], (600, 1))
    v[100:160] = v[7]
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)] + [(900, None, 1), (901, [None] * 8, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (None, [1.0] * 8, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in top_k_search(table, "vec_id % 50 = 0").collect())
    q = np.floor(256 * v.astype(np.float32).astype(np.float64)).astype(np.int64)
    expected = []
    for i in range(0, 600, 50):
        s = q @ q[i]
        best = sorted((-int(s[j]), j) for j in range(600) if j != i)[:5]
        expected += [(i, r + 1, j, -n) for r, (n, j) in enumerate(best)]
    assert got == expected
    assert top_k_search(table.limit(0), "vec_id % 50 = 0").count() == 0
    # Vectors of other lengths, repeated rows and repeated queries.
    mixed = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 1.0, 5.0]), (50, [0.5, 0.5, 0.5]), (3, [0.0, 0.0]), (4, [])]
    got = sorted(tuple(r) for r in top_k_search(spark.createDataFrame(mixed, "vec_id long, embedding array<float>"), "vec_id % 50 = 0").collect())
    unit = 256 * 256
    assert got == [(0, 1, 1, 5 * unit), (0, 2, 1, 5 * unit), (0, 3, 3, 0), (50, 1, 2, 7 * unit // 2)]
    assert [tuple(r) for r in top_k_search(table.where("vec_id in (0, 1)"), "vec_id = 0").collect()] == [(0, 1, 1, int(q[0] @ q[1]))]


def test_url_rules(spark):
    from admitflow.llm.queries import url_rules
    from admitflow.llm.url_filter import Automaton, Rule, filter_urls

    rows = [
        (1, "http://A.com/en/x?q#f", "a.com", "/en/x", "com/en/", "block"),
        (2, "https://x.example.com/en/71", "x.example.com", "/en/71", "example.com/en/7", "allow"),
        (3, "http://anexample.com/en/7", "anexample.com", "/en/7", "com/en/", "block"),
        (4, "http://example.net/de/8#z", "example.net", "/de/8", "example.net/de/8", "block"),
        (5, "http://a.org/x/b.org/es/", "a.org", "/x/b.org/es/", None, "allow"),
        (6, None, "", "", None, "allow"),
        (7, "no scheme/en/", "", "", None, "allow"),
        (8, "http://com?x=/en/", "com", "", None, "allow"),
        (9, "http://é.COM/en/" + "y" * 5000, "é.com", "/en/" + "y" * 5000, "com/en/", "block"),
        (9, "", "", "", None, "allow"),
        (None, "http://b.net/de/", "b.net", "/de/", "net/de/", "allow"),
        (10, "http://a.com/en/\0x\0/y", "a.com", "/en/\0x\0/y", "com/en/", "block"),
        (11, "http://\0.org/es/", "\0.org", "/es/", "org/es/", "block"),
    ]
    table = spark.createDataFrame([(r[0], r[1], "h") for r in rows], "page_id long, url string, host string")
    got = [tuple(r) for r in filter_urls(table, url_rules()).collect()]
    assert sorted(got, key=str) == sorted([(r[0], *r[2:]) for r in rows], key=str)
    assert filter_urls(table.limit(0), url_rules()).count() == 0
    assert {r.verdict for r in filter_urls(table, [], "block").collect()} == {"block"}
    many = [f"{'x' * k}*{'y' * 40}**z" for k in range(1, 30)]
    hit = Automaton(many).match([b"xxxa" + b"y" * 40 + b"/q/z", b"xxx/" + b"y" * 40 + b"z"])
    assert hit[0].tolist() == [k <= 3 for k in range(1, 30)] and not hit[1].any()
    assert Rule("block", "a.b", "/c").globs() == ("a.b/c**", "*.a.b/c**")


def test_quality_against_labels(spark):
    from admitflow.llm.quality import score_quality, train_quality_model

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = score_quality(docs, train_quality_model(docs)).join(labels, "doc_id").select("accepted", labels["quality"].alias("gold")).collect()
    kept = [r.accepted for r in got if r.gold == 1]
    gone = [not r.accepted for r in got if r.gold == 0]
    assert sum(kept) == len(kept) and sum(gone) / len(gone) > 0.9


def test_quality_on_odd_rows(spark, odd):
    from admitflow.llm.quality import score_quality, train_quality_model

    got = score_quality(odd, train_quality_model(odd))
    assert got.count() == odd.count() and set(got.columns) == {*odd.columns, "weak_label", "accepted"}
    assert {r.doc_id for r in got.where("quality = 0").collect()} == {1, 2, 3}
    assert score_quality(empty(spark), train_quality_model(empty(spark))).count() == 0


def test_samples_are_bounded(spark):
    """A hot row counts once, a table of any size gives some rows, and a small one all its distinct rows."""
    from pyspark.sql import functions as F

    from admitflow.llm.common import bounded_sample

    rows = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("hot").alias("text"))
    got = [r.text for r in bounded_sample(rows, 1000).collect()]
    assert 800 < len(got) < 1200 and len(set(got)) == len(got)
    assert sorted(r.text for r in bounded_sample(rows.where("doc_id is null or doc_id < 10"), 1000).collect()) == ["1", "2", "4", "5", "7", "8", "hot"]
    assert bounded_sample(rows.limit(0), 1000).count() == 0


def test_quality_equals_brute_force(spark):
    """Votes counted and accuracies estimated document by document, the scorer fitted on dense rows."""
    from math import exp, log, prod

    from admitflow.llm import quality as q

    docs = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    model = q.train_quality_model(spark.read.parquet(f"{SF}/documents.parquet"), sample_rows=10**6)

    def vote(text):
        words, lines = text.split(), text.split("\n")
        n, letters = max(1, len(words)), [c for c in text if c.isascii() and c.isalpha()]
        shares = [
            (sum(c.isupper() for c in letters) / max(1, len(letters)), 0.5, 0.2, 3),
            (sum(text.count(c) for c in "#$%&*|<>{}[]^~@+=_\\/!") / max(1, len(text.encode())), 0.06, 0.02, 3),
            (sum(not w[-1].isalnum() and w[-1] not in ".,;:?)\"'" for w in words) / n, 0.4, 0.1, 3),
            (sum(a == b for a, b in zip(words, words[1:])) / n, 0.3, 0.1, 5),
            (-len(set(words)) / n, -0.15, -0.45, 40),
            (1 - len(set(lines)) / len(lines), 0.6, 0.2, 20),
            (words.count("|") / n, 0.15, -1, 5),
        ]
        return [0 if len(words) < least else -1 if x > bad else 1 if x < good else 0 for x, bad, good, least in shares]

    cast = [vote(t) for t in docs]
    caught, alarms, prior, k = [0.4] * 7, [0.01] * 7, 0.9, range(7)
    for _ in range(200):
        good = []
        for v in cast:
            bad_, good_ = (share * prod(p[i] if v[i] < 0 else 1 - p[i] for i in k if v[i]) for p, share in ((caught, 1 - prior), (alarms, prior)))
            good.append(good_ / (good_ + bad_))
        caught = [min(0.99, max(0.15, (sum(1 - g for g, v in zip(good, cast) if v[i] < 0) + 2) / (sum(1 - g for g, v in zip(good, cast) if v[i]) + 5))) for i in k]
        alarms = [min(0.1, max(1e-4, (sum(g for g, v in zip(good, cast) if v[i] < 0) + 0.1) / (sum(g for g, v in zip(good, cast) if v[i]) + 10))) for i in k]
        prior = min(0.99, max(0.3, (sum(good) + 9) / (len(cast) + 10)))
    assert np.allclose(list(model.caught.values()), caught) and np.allclose(list(model.alarms.values()), alarms) and np.isclose(model.prior, prior)

    rows = sorted({(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text is not None})
    x, soft = np.zeros((len(rows), q.DIMS)), np.zeros(len(rows))
    for i, (_, text) in enumerate(rows):
        raw = np.frombuffer(text.encode(), np.uint8)
        at, value = q.features(text, raw, q.measure(text, raw))
        np.add.at(x[i], at, value)
        v = vote(text)
        odds = log((1 - prior) / prior) + sum(log((caught[j] if v[j] < 0 else 1 - caught[j]) / (alarms[j] if v[j] < 0 else 1 - alarms[j])) for j in k if v[j])
        soft[i] = 1 / (1 + exp(odds))
    share = soft.mean()
    importance = soft * 0.5 / share + (1 - soft) * 0.5 / (1 - share)
    w, b, gw, gb = np.zeros(q.DIMS), 0.0, np.full(q.DIMS, 1e-3), 1e-3
    for _ in range(120):
        error = importance * (1 / (1 + np.exp(-(x @ w + b))) - soft) / len(rows)
        step = x.T @ error + 1e-5 * w
        gw, gb = gw + step**2, gb + error.sum() ** 2
        w, b = w - 0.3 * step / np.sqrt(gw), b - 0.3 * error.sum() / np.sqrt(gb)
    scores = {r.doc_id: r.quality for r in q.score_quality(spark.read.parquet(f"{SF}/documents.parquet").dropDuplicates(["doc_id"]), model).collect()}
    for i, (d, text) in enumerate(rows):
        if text.split():
            assert abs(scores[d] - 1 / (1 + np.exp(-(x[i] @ w + b)))) < 0.01


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_packing(spark, odd, tokenizer):
    from tokenizers import Tokenizer

    from admitflow.llm.packing import pack_sequences

    whole = Tokenizer.from_file(tokenizer)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tricky = ["a  b", " a b ", "a \n b", "\n\nx\n", "tab\tx y", "it's <|endoftext|> ok", "é ß  x", "x\x00y", "x\x1cy \x1c z", "", None, "12 34\n56", "a\r\nb", "<|endoftext|><|endoftext|> x <|endoftext", " " * 30_000 + "x", "x" + "\n " * 20_000, "a" * 50_000, "don't I'LL we're", "中文 テスト 한국어", "² ½ ① ١٢"]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + k, t) for k, t in enumerate(tricky)]
    got = pack_sequences(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer, chunk_tokens=20_000).collect()
    ids = {d: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in rows}
    seen, sequences = Counter(), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        seen.update((r.doc_id, t) for t in range(r.start, r.start + r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert max(seen.values()) == 1 and len(seen) == sum(map(len, ids.values()))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at & (at - 1) == 0 and at <= 2048
    got = pack_sequences(odd, tokenizer)
    assert got.selectExpr("sum(length)").first()[0] == sum(len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert pack_sequences(empty(spark), tokenizer).count() == 0


def test_tokens_of_every_character(tokenizer):
    from tokenizers import Tokenizer

    from admitflow.llm.packing import Encoder

    whole, own = Tokenizer.from_file(tokenizer), Encoder(tokenizer, 1)
    assert own.fast
    for c in [*range(0xD800), *range(0xE000, 0x20000, 7)]:
        text = f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}  {chr(c)}{chr(c)} b"
        assert own.ids(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), hex(c)
    rng = random.Random(11)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b1", " ", "  ", "\n", "\t", "'s", "é", "\u00a0", "\u3000", "中", "<|endoftext|>", "<|", "!", "½"]) for _ in range(rng.randint(0, 30)))
        assert own.ids(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_packing_balances_cost():
    from admitflow.llm.packing import assign

    rng = random.Random(2)
    lengths = [rng.randint(1, 400) for _ in range(600)]
    pieces, costs = assign(lengths, 2048, 1.0, 1 / 2048)
    assert sum(n for _, _, n, _ in pieces) == sum(lengths)
    assert len(pieces) < 1.2 * len(lengths)  # most documents stay whole


def test_hilbert_curve_steps_to_neighbours():
    from admitflow.llm.sharding import hilbert_index

    for bits, dims in ((3, 3), (4, 2), (2, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        at = hilbert_index(grid, bits)
        assert sorted(at) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, odd, tmp_path):
    from admitflow.llm.sharding import hilbert_shards, write_shards

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, odd):
        rows, got = table.collect(), hilbert_shards(table).collect()
        facts = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        assert Counter((r.doc_id, *facts(r.text)) for r in rows) == Counter((r.doc_id, r.size, r.text_crc32) for r in got)
        for s in {r.shard for r in got}:
            slots = sorted(r.slot for r in got if r.shard == s)
            assert 0 <= s < 16 and slots == list(range(len(slots)))
    sizes, got = Counter(), hilbert_shards(docs).collect()
    for r in got:
        sizes[r.shard] += r.size
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    assert hilbert_shards(empty(spark)).count() == 0
    write_shards(docs.dropDuplicates(["doc_id"]), str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


def test_shards_equal_brute_force(spark):
    """Cells, order, cut and slots of every row from plain Python, and how the groups of equal texts are cut."""
    import xxhash

    from admitflow.llm.sharding import BITS, hilbert_index, hilbert_shards

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()] + [(5000 + k, "copy of one text", "en", f"site{k % 3}") for k in range(60)] + [(6000, None, None, None), (6001, "", None, "a")]

    def cells(values):
        counts = Counter(v for v in values if v is not None)
        starts = sorted(sorted(counts, key=lambda v: (-counts[v], v))[: (1 << BITS) - 1])
        return lambda v: sum(v >= s for s in starts) * (63 // max(1, len(starts))) if v is not None else 0

    source_cell, lang_cell = cells([r[3] for r in rows]), cells([r[2] for r in rows])
    least = {}
    for _, text, lang, source in rows:
        for k, v in enumerate((source, lang)):
            if v is not None:
                least[text, k] = min(v, least.get((text, k), v))
    half_power = lambda text: max(k for k in range(64) if (len((text or "").encode()) + 1) ** 2 >= 2**k)
    low, high = (f(half_power(r[1]) for r in rows) for f in (min, max))
    facts = []
    for d, text, _, _ in rows:
        raw = (text or "").encode()
        size = len(raw) + 1
        scale = (half_power(text) - low) * 63 // (high - low)
        at = hilbert_index(np.array([[source_cell(least.get((text, 0))), lang_cell(least.get((text, 1))), scale]]), BITS)[0]
        facts.append((int(at), zlib.crc32(raw), np.int64(np.uint64(xxhash.xxh64_intdigest(raw, 42))) if text is not None else 42, d, size))
    total, before, slots, expected = sum(f[4] for f in facts), 0, Counter(), set()
    for curve, crc, _, d, size in sorted(facts):
        shard = (2 * before + size) * 16 // (2 * total)
        expected.add((d, size, crc, shard, slots[shard], curve))
        before, slots[shard] = before + size, slots[shard] + 1
    table = spark.createDataFrame(rows, docs.schema)
    got = hilbert_shards(table).collect()
    assert {(r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.curve) for r in got} == expected and len(got) == len(rows)
    groups = defaultdict(set)
    for r in got:
        groups[r.text_crc32, r["size"]].add(r.shard)
    assert max(map(len, groups.values())) <= 2 and sum(len(g) > 1 for g in groups.values()) <= 15


def test_shards_prune(spark, tmp_path):
    """A filter on any dimension leaves most shards unread. Texts differ, as copies lie together whatever their values."""
    from pyspark.sql import functions as F

    from admitflow.llm.sharding import write_shards

    rng = random.Random(17)
    rows = [(k, f"{k:04}" + "x" * int(2 ** rng.uniform(3, 11)), f"lang{rng.randrange(8)}", f"source{rng.randrange(8)}") for k in range(4000)]
    write_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), str(tmp_path / "p"), 64)
    stored = spark.read.parquet(str(tmp_path / "p"))
    by_shard = stored.groupBy("shard").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("lang", "source") for f in (F.min, F.max)], F.min(F.length("text")).alias("min_size"), F.max(F.length("text")).alias("max_size")).collect()
    assert len(by_shard) == 64
    for test in (lambda r: r.min_lang <= "lang3" <= r.max_lang, lambda r: r.min_source <= "source6" <= r.max_source, lambda r: r.min_size <= 50):
        assert sum(map(test, by_shard)) <= 48, sum(map(test, by_shard))


def test_licenses(spark, odd):
    from admitflow.llm.licenses import align, known_templates, scan_licenses

    rng = random.Random(4)
    texts = {
        1: words(rng, 50),
        2: words(rng, 30) + "\nLicensed under the Apache License, Version 2.0.\n" + words(rng, 9),
        3: "released UNDER the (MIT) license " + words(rng, 5) + " Licensed under CC BY-NC 4.0.",
        4: known_templates()["MIT-text"].replace("granted", "hereby given").replace("obtaining", "getting"),
        5: "This work is licensed under the GNU General Public License, version 3.",
    }
    table = spark.createDataFrame([(d, t, "x") for d, t in texts.items()], "doc_id long, text string, license string")
    got = sorted((r.doc_id, r.license, r.start_word, r.end_word) for r in scan_licenses(table).collect())
    n = len(texts[4].split())
    assert got == [(2, "Apache-2.0", 30, 37), (3, "CC-BY-NC-4.0", 10, 15), (3, "MIT", 0, 5), (4, "MIT-text", 0, n), (5, "GPL-3.0", 0, 12)]
    assert scan_licenses(odd).count() == 0 and scan_licenses(empty(spark)).count() == 0
    assert align([1, 2, 3, 4], [9, 1, 2, 8, 4], 1, 2) == (3, 1, 5)


def test_licenses_with_changed_words():
    """Each template is found with any words changed that the alignment and the coverage allow."""
    from itertools import combinations, islice

    from admitflow.llm.licenses import NOTICES, Scanner, align

    scanner = Scanner(NOTICES, 0.8, 4)
    for name, text in NOTICES.items():
        own = text.split()
        edits = len(own) // 5
        for at in islice(combinations(range(len(own)), edits), 300):
            changed = [f"changed{i}" if i in at else w for i, w in enumerate(own)]
            if align(*(scanner.hashes.array(t).tolist() for t in (own, changed)), 0, 8)[0] < 0.8 * len(own):
                continue
            got = scanner.scan("one two " + " ".join(changed) + " three four")
            assert any(len(own) - edits <= m for _, _, m, _, _ in got), (name, changed, got)
    assert [f[0] for f in scanner.scan("Released under an MIT License")] == ["MIT"]
    assert scanner.scan("") == [] and scanner.scan("licensed under") == []


def longest_common(a, b):
    """Words of a matched in an alignment that is not bound to any diagonal."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_whole_licenses_equal_brute_force():
    """Every text of up to 400 words, with words changed, dropped and put in, against full alignment of all templates."""
    from admitflow.llm.licenses import Scanner, known_templates

    rng, templates = random.Random(15), {k: v for k, v in known_templates().items() if len(v.split()) <= 400}
    scanner = Scanner(templates, 0.8, 4)
    plain = lambda t: [w.lower().strip(".,;:!?()[]{}\"'*#/") for w in t.split()]
    for name, text in templates.items():
        for share in (0, 0.05, 0.12):
            own = text.split()
            for at in rng.sample(range(len(own)), int(share * len(own))):
                own[at] = rng.choice(["", "other", own[at] + " more"]) if share < 0.1 else "other"
            document = f"{words(rng, 20)} {' '.join(own)} {words(rng, 20)}"
            got = scanner.scan(document)
            scores = {k: longest_common(plain(t), plain(document)) for k, t in templates.items()}
            best = max(scores, key=lambda k: (scores[k] if scores[k] >= 0.8 * len(plain(templates[k])) else 0, scores[k] / len(plain(templates[k]))))
            assert [g[0] for g in got] == [best] == [name], (name, share, got, best)
            assert got[0][2] >= 0.97 * scores[name] and abs(got[0][3] - 20) <= 6, (name, share, got[0], scores[name])


def test_long_licenses():
    from admitflow.llm.licenses import Scanner, known_templates

    rng, scanner = random.Random(16), Scanner(known_templates(), 0.8, 4)
    for name in ("Apache-2.0-text", "GPL-3.0-text", "BSD-2-Clause-text"):
        own = known_templates()[name].split()
        for at in rng.sample(range(len(own)), len(own) // 20):
            own[at] = "other"
        got = scanner.scan(f"{words(rng, 30)} {' '.join(own)} {words(rng, 30)}")
        assert [(g[0], g[3], g[4]) for g in got] == [(name, 30, 30 + len(own))] or (got[0][0] == name and abs(got[0][3] - 30) < 4 and len(got) == 1), got
    assert [f[0] for f in scanner.scan("see the License for the specific language governing permissions")] == []


def edit_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_exact_edit_distance():
    from admitflow.llm.decontam import Myers

    rng = random.Random(6)
    for _ in range(60):
        pattern = bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 90)))
        text = bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 120)))
        distance, end = Myers(pattern).best(text)
        assert distance == edit_within(pattern, text) == min(len(pattern), edit_within(pattern, text[:end]))


def test_contamination_recall(spark, odd):
    from admitflow.llm.decontam import decontaminate, find_contamination

    rng = random.Random(7)
    items = [(k, words(rng, rng.choice([4, 12, 25, 45]))) for k in range(60)] + [(98, None), (99, " ")]
    rows, expected = [], set()
    for d in range(240):
        text = words(rng, rng.randint(50, 300)).split()
        if d % 2:
            k, item = items[d % 60]
            copy = item.upper().split()
            if d % 4 == 3:
                for _ in range(len(copy) // 16):
                    p = rng.randrange(len(copy))
                    copy[p] = "q" * len(copy[p])
            at = rng.randrange(len(text))
            text[at:at] = copy
            if edit_within(item.lower().encode(), " ".join(copy).lower().encode()) <= 0.1 * len(item):
                expected.add((d, k))
        rows.append((d, "\n".join(text)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(table, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found & expected) >= 0.97 * len(expected)
    texts, by_item = dict(rows), dict(items)
    for r in got:
        text = texts[r.doc_id].lower().replace("\n", " ").encode()
        assert edit_within(by_item[r.item_id].encode(), text[r.start : r.end]) == r.distance <= 0.1 * r.item_bytes
    assert all(edit_within(by_item[k].encode(), texts[d].lower().replace("\n", " ").encode()) <= 0.1 * len(by_item[k]) for d, k in found - expected)
    left = {r.doc_id for r in decontaminate(table, bench).collect()}
    assert left == set(texts) - {d for d, _ in found}
    assert {(r.doc_id, r.item_id) for r in find_contamination(table, bench, most_bytes=2000).collect()} == found
    assert find_contamination(odd, bench).count() == 0 and decontaminate(odd, bench).count() == odd.count()
    assert find_contamination(table, bench.limit(0)).count() == 0 and decontaminate(empty(spark), bench).count() == 0


def test_contamination_recall_at_the_limit():
    """Recall of passages whose distance is at the limit: letters changed anywhere, and whole words, by item length."""
    from admitflow.llm.decontam import Detector, Myers, normalise

    rng = random.Random(14)
    for n_words in (3, 6, 10, 18, 39, 80):
        items = [(k, words(rng, n_words)) for k in range(100)]
        detector = Detector(items, 0.1, 6, 16)
        for whole_words in (False, True):
            texts, planted = [], []
            for k, item in items:
                limit = int(0.1 * len(item))
                if whole_words:
                    parts, changed = item.split(), list(item.split())
                    for at in rng.sample(range(n_words), n_words):
                        trial = [*changed[:at], "".join(rng.choice("klmno") for _ in parts[at]), *changed[at + 1 :]]
                        if Myers(item.encode()).best(" ".join(trial).encode())[0] <= limit:
                            changed = trial
                    copy = " ".join(changed)
                else:
                    copy = list(item)
                    for at in rng.sample(range(len(item)), limit):
                        copy[at] = rng.choice("klmno")
                    copy = "".join(copy)
                texts.append(normalise(f"{words(rng, rng.randint(20, 60))} {copy} {words(rng, rng.randint(20, 60))}"))
                planted.append(k)
            found = {(d, i) for d, i, *_ in detector.search(texts)}
            assert sum((d, k) in found for d, k in enumerate(planted)) >= 90, (n_words, whole_words)


def test_contamination_without_spaces(spark):
    """Exact copies of items without spaces, inside lines without spaces; and any white space as a space."""
    from admitflow.llm.decontam import decontaminate, find_contamination

    rng = random.Random(9)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    thai = lambda n: "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(n))
    code = lambda n: "".join(rng.choice("abcdefghij(){}=+-/.") for _ in range(n))
    cyrillic = lambda n: "".join(chr(rng.randrange(0x430, 0x450)) for _ in range(n))
    items, rows = [], []
    for script, lengths in ((han, (5, 8, 20, 33, 60)), (thai, (8, 20, 40, 80)), (code, (16, 50, 97, 150)), (cyrillic, (10, 30, 60))):
        for n in lengths:
            for copy in range(4):
                items.append((len(items), script(n)))
                rows.append((len(rows), script(rng.randint(20, 90)) + items[-1][1] + script(rng.randint(20, 90))))
    for space in ("\u3000", "\xa0", "\u2003", "\t"):
        items.append((len(items), words(rng, 3)))
        rows.append((len(rows), words(rng, 20) + space + items[-1][1].replace(" ", space) + space + words(rng, 20)))
    expected = {(d, d) for d, _ in rows}
    rows.append((len(rows), han(200)))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in find_contamination(docs, bench).collect()}
    assert not expected - got.keys() and all(got[k] == 0 for k in expected)
    assert [r.doc_id for r in decontaminate(docs, bench).collect()] == [len(rows) - 1]


def test_language_held_out(spark):
    from admitflow.llm.queries import op9_language_id

    got = op9_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    held = [r.lang == r.lang_pred for r in got if r.held_out]
    assert len(held) > 200 and sum(held) / len(held) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def test_language_on_odd_rows(spark, odd):
    from admitflow.llm.langid import identify_language, kneser_ney, train_language_models

    model = train_language_models(odd)
    got = identify_language(odd, model).collect()
    assert len(got) == odd.count()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "und", 2: "und", 3: "und", 4: "en", 5: "en", 6: "en", None: "en"}
    assert {r.lang_pred for r in identify_language(odd, train_language_models(empty(spark))).collect()} == {"und"}
    assert identify_language(empty(spark), model).count() == 0
    from admitflow.llm.langid import _grams

    keys, _ = _grams(["abab", "abc", "cab"])
    small = kneser_ney({"x": tuple(np.unique(keys, return_counts=True))})
    seen, unseen = small.words(["abc", "zzz"])[:, 0]
    assert unseen < seen < 0 and small.words(["abc", "zzz"])[:, 1].tolist() == [4, 4]


def brute_kneser_ney(texts, order=4):
    """Interpolated Kneser-Ney from dictionaries: probability of the last character of a gram."""
    counts = {o: Counter() for o in range(1, order + 1)}
    for text in texts:
        for w in text.lower().split():
            padded = " " * (order - 1) + w + " "
            counts[order].update(padded[i : i + order] for i in range(len(padded) - order + 1))
    for o in range(order - 1, 0, -1):
        counts[o] = Counter(g[1:] for g in counts[o + 1])
    rare = {o: [sum(n == k for n in c.values()) for k in (1, 2)] for o, c in counts.items()}
    discount = {o: min(0.95, max(0.05, a / max(1, a + 2 * b))) for o, (a, b) in rare.items()}

    def p(gram, alphabet):
        o = len(gram)
        if not o:
            return 1 / alphabet
        same = {g: n for g, n in counts[o].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:], alphabet)
        total = sum(same.values())
        return max(same.get(gram, 0) - discount[o], 0) / total + discount[o] * len(same) / total * p(gram[1:], alphabet)

    return p, set(counts[1])


def test_language_equals_brute_force(spark):
    """Cross-entropies of a dictionary implementation, on words seen in training."""
    from math import log

    from admitflow.llm.langid import identify_language, letters, train_language_models

    rng = random.Random(12)
    rows = [(k, words(rng, 12), "one") for k in range(6)] + [(10 + k, " ".join("".join(rng.choice("ghijklm") for _ in range(3)) for _ in range(9)), "two") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = {lang: brute_kneser_ney([t for _, t, x in rows if x == lang]) for lang in ("one", "two")}
    alphabet = len(set().union(*(a for _, a in models.values()))) + 1
    got = {r.doc_id: r for r in identify_language(docs, train_language_models(docs)).collect()}
    for d, text, lang in rows:
        grams = [g for w in text.split() for padded in ["   " + w + " "] for g in (padded[i : i + 4] for i in range(len(padded) - 3))]
        entropy = -sum(log(models[lang][0](g, alphabet)) for g in grams) / len(grams)
        assert got[d].lang_pred == lang and abs(got[d].cross_entropy - entropy) < 1e-4, (d, entropy, got[d])
    assert letters("x²y½①z3é") == ["x", "y", "z", "é"] and letters("½") == []


def test_language_rejects_and_keeps_small_ones(spark):
    """Figures alone are no letters; text of letters never learned is rejected; a language of two texts is learned."""
    from admitflow.llm.langid import identify_language, train_language_models

    rng = random.Random(13)
    rows = [(k, words(rng, 40), "hot") for k in range(80)] + [(100 + k, " ".join("".join(rng.choice("uvwxyz") for _ in range(4)) for _ in range(25)), "rare") for k in range(2)]
    model = train_language_models(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = [(200, "\u0431\u0432\u0433\u0434 " * 40), (201, "\u00b2 \u00bd \u2460 12"), (202, words(rng, 40)), (203, "uvwx zyxw vuzy xwuv " * 3)]
    got = {r.doc_id: r for r in identify_language(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert got[200].rejected and got[200].lang_pred in ("hot", "rare")
    assert (got[201].lang_pred, got[201].score, got[201].rejected) == ("und", 0.0, True)
    assert (got[202].lang_pred, got[202].rejected) == ("hot", False) and got[203].lang_pred == "rare"


def test_language_models_in_slices(spark):
    """Models past the bound on one task's size keep all grams and languages, and give the results of one piece."""
    from admitflow.llm.langid import identify_language, train_language_models

    rng = random.Random(8)
    rows = [(k, words(rng, 60), "hot") for k in range(60)]
    for lang, letters in (("rare", "klmnop"), ("other", "hijklm"), ("han", [chr(0x4E00 + k) for k in range(300)])):
        rows += [(len(rows) + k, " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(30)), lang) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, sliced = train_language_models(docs), train_language_models(docs, most_grams=2000)
    assert not whole.rest and len(sliced.rest) > 3 and sliced.langs == ["han", "hot", "other", "rare"]
    one, many = ({r.doc_id: r for r in identify_language(docs.withColumn("sums", docs.doc_id), m).collect()} for m in (whole, sliced))
    assert {k: r.lang_pred for k, r in many.items()} == {k: lang for k, _, lang in rows}
    for k, r in one.items():
        assert (r.lang_pred, r.rejected, r.sums) == (many[k].lang_pred, many[k].rejected, k)
        assert np.allclose([r.score, r.cross_entropy], [many[k].score, many[k].cross_entropy], rtol=1e-5)


def test_language_models_of_a_character_that_fills_slices(spark):
    """A character between many others is in more grams than a slice may hold: it is cut by the one before it."""
    from admitflow.llm.common import Scratch
    from admitflow.llm.langid import _first, _slice_rows, _starts, identify_language, train_language_models

    rng = random.Random(21)
    han = [chr(0x4E00 + k) for k in range(200)]
    rows = [(k, " ".join("x".join(rng.choice(han[at : at + 120]) for _ in range(3)) for _ in range(60)), lang) for k, (lang, at) in enumerate([("low", 0), ("high", 80)] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, sliced = train_language_models(docs), train_language_models(docs, most_grams=300)
    assert sum(m.span[0] >> 16 == ord("x") for m in _slices(sliced)) > 3
    assert all(len(m.keys[4]) <= 300 for m in _slices(sliced)) and sum(len(m.keys[4]) for m in _slices(sliced)) == len(whole.keys[4])
    one, many = ({r.doc_id: r for r in identify_language(docs, m).collect()} for m in (whole, sliced))
    for k, _, lang in rows:
        assert one[k].lang_pred == many[k].lang_pred == lang
        assert np.allclose([one[k].score, one[k].cross_entropy], [many[k].score, many[k].cross_entropy], rtol=1e-5)
    assert _starts(spark.createDataFrame([], "lang string, gram long, n long"), 2, 10) == [0]
    grams = spark.createDataFrame([("a", (1 << 48) | (2 << 32) | (3 << 16) | 4, 1), ("a", (1 << 48) | (5 << 32) | (3 << 16) | 4, 2)], "lang string, gram long, n long")
    sent, rare = _slice_rows(grams, ["a"], [0, (3 << 16) | 5], Scratch(spark))
    assert sorted((r["slice"], r.o, r.gram & 0xFFFFFFFF, r.n) for r in sent.collect()) == [(0, 1, 4, 1), (0, 2, (3 << 16) | 4, 2), (0, 4, (3 << 16) | 4, 1), (1, 1, 4, 1), (1, 2, (3 << 16) | 4, 2), (1, 4, (3 << 16) | 4, 2)]
    assert rare == {(4, "a"): (1, 1), (3, "a"): (2, 0), (2, "a"): (0, 1), (1, "a"): (1, 0)}
    assert grams.select(_first(2).alias("c")).distinct().collect()[0].c == 3


def _slices(model):
    from admitflow.llm.langid import _load

    return [_load(model.stored, k) for k in [0, *model.rest]]


def test_language_of_letters_beyond_16_bits(spark):
    from admitflow.llm.langid import _grams, identify_language, train_language_models

    for word in ("\U00020020\u4e00", "\u4e00\U00020020", "\U00030020", "a\U0001d400b"):
        keys, owner = _grams([word, "ab"])
        assert len(keys) == len(owner) and (owner[-3:] == 1).all() and (keys[-3:] == _grams(["ab"])[0]).all()
    assert not set(_grams(["\U0001d400"])[0].tolist()) & set(_grams(["\ud400"])[0].tolist())
    rows = [(k, "\U00020020\u4e00 \u4e00\U00020020\u4e8c " * 9, "zh") for k in range(4)] + [(4 + k, "\U0001d400\U0001d401 " * 9, "math") for k in range(4)] + [(8 + k, "\ud400\ud401 " * 9, "ko") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify_language(docs, train_language_models(docs)).collect()
    assert {r.doc_id: (r.lang_pred, r.rejected) for r in got} == {k: (lang, False) for k, _, lang in rows}


def test_archives(spark, tmp_path):
    from admitflow.llm.warc import archive_round_trip, parse, write_archives

    body = "a\r\n\r\nWARC/1.1\r\n\r\nb"
    rows = [(1, "http://a/", body), (2, "http://b/\r\nX: y", body), (3, None, body), (4, "u", None), (5, "u", ""), (6, "u", "é" * 100_000), (7, "u", "one"), (7, "u", "one"), (None, "u", "x")]
    table = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archive_round_trip(table).collect() if r.page_id)
    n = len(body)
    assert got == [(1, n, "revisit", 3), (2, n, "revisit", 3), (3, n, "response", None), (4, 0, "revisit", 5), (5, 0, "response", None), (6, 200_000, "response", None), (7, 3, "response", None), (7, 3, "revisit", 7)]
    alone = sorted((r.payload_digest, r.record_type, r.refers_to) for r in archive_round_trip(spark.createDataFrame([(None, "u", "x"), (None, "u", "x"), (None, "v", "y"), (8, "u", "y")], "page_id long, url string, html string")).collect())
    assert [(k, p) for _, k, p in alone] == [("response", None), ("revisit", 8), ("response", None), ("revisit", None)] or [(k, p) for _, k, p in alone] == [("response", None), ("revisit", None), ("response", None), ("revisit", 8)]
    import base64
    import gzip
    import hashlib

    expected = {r[0]: base64.b32encode(hashlib.sha1((r[2] or "").encode()).digest()).decode() for r in rows}
    assert all(r.payload_digest == expected[r.page_id] for r in archive_round_trip(table).collect())
    assert all(r.record_type == "response" for r in archive_round_trip(table, min_bytes=10**9).collect())
    assert archive_round_trip(table.limit(0)).count() == 0
    write_archives(table, str(tmp_path / "w"))
    records = [h for f in (tmp_path / "w").glob("*.gz") for h, _ in parse(gzip.open(f))]
    assert sorted(h["warc-type"] for h in records) == ["response"] * 5 + ["revisit"] * 4
    assert len({h["warc-record-id"] for h in records}) == len(records)
    # Files are bounded by bytes, at the least by one record.
    write_archives(table, str(tmp_path / "small"), file_bytes=1000)
    counts = [sum(1 for _ in parse(gzip.open(f))) for f in (tmp_path / "small").glob("*.gz")]
    assert sum(counts) == len(records) and max(counts) == 1


def test_every_distinct_text_calibrates(spark, monkeypatch):
    from admitflow.llm import langid

    got = []
    monkeypatch.setattr(langid, "_calibrate", lambda model, rows: got.extend(rows))
    docs = spark.range(6000).selectExpr("id as doc_id", "translate(string(id), '0123456789', 'abcdefghij') as text", "if(id % 3 = 0, 'x', 'y') as lang")
    langid.train_language_models(docs.union(docs.limit(100)))
    assert len(got) >= len(langid.SCALES) and {r.n for r in got if r.lang is None} == {6000}
    assert sum(r.n for r in got if r.lang == "x") == 2000 and sum(r.n for r in got if r.lang == "y") == 4000


def test_sums_calibrate_as_rows_do():
    from types import SimpleNamespace

    import pyarrow as pa

    from admitflow.llm import langid

    rng, langs = np.random.default_rng(3), ["a", "b", "c"]
    n, truth = rng.integers(5, 500, 999), rng.integers(0, 2, 999)
    entropy = 2 + rng.random((999, 3)) - 0.3 * np.eye(3)[truth]
    v = np.column_stack([-entropy * n[:, None], n])
    rows = pa.RecordBatch.from_arrays([pa.array([langs[j] for j in truth]), pa.array(v.tolist(), pa.list_(pa.float64()))], ["lang", "v"])
    sums = {}
    for part in langid._measured(langs)([rows.slice(0, 300), rows.slice(300), rows.slice(0, 0)]):
        for r in part.to_pylist():
            held = sums.setdefault((r["lang"], r["bin"]), dict.fromkeys(("n", "size", "x", "xx"), 0))
            for k in held:
                held[k] += r[k]
    model = SimpleNamespace(langs=langs)
    langid._calibrate(model, [SimpleNamespace(lang=a, bin=b, **x) for (a, b), x in sums.items()])
    own = entropy[np.arange(999), truth]
    loss = []
    for scale in langid.SCALES:
        logit = -entropy * scale * np.sqrt(n)[:, None]
        logit -= logit.max(axis=1, keepdims=True)
        loss.append((np.log(np.exp(logit).sum(axis=1)) - logit[np.arange(999), truth]).mean())
    assert model.scale == langid.SCALES[int(np.argmin(loss))]
    for j in range(2):
        middle = np.median(own[truth == j])
        assert abs(model.limits[0][j] - middle) < 1 / langid.BINS
        assert abs(model.limits[1][j] - np.sqrt((((own - middle) ** 2) * n)[truth == j].mean())) < 0.01
    assert abs(model.limits[0][2] - np.median(own)) < 1 / langid.BINS and model.limits[1][2] == 1.0
