"""Importance resampling, mixing and the conversation trie against brute force on small tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and extra columns with clashing names."""
    long_text = " ".join(f"w{i % 977}" for i in range(300_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n ", "en", "a", 3), (4, "one two", "en", None, 7), (4, "one two", "en", None, 7), (5, long_text, "en", "b", 1), (6, long_text + " x", None, "b", 1), (None, "no id here", "en", "a", 1)]
    extra = "n long, key string, size long, hash long, score double, rank long, row long, number long, weight double, target double, pair string"
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 0.5, 6, 7, 8, 0.5, 0.5, "p") for r in rows], f"{DOCS}, {extra}")


def folded(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def runs(text, longest):
    w = folded(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, percent=10, longest=1, buckets=10_000, least=20):
    """(doc_id, n_features, weight, score, rank) with plain sums of gains."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in runs(t, longest))
    t = Counter(bucket(f) for x in target for f in runs(x, longest))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)}
    out = []
    for d, text in docs:
        f = runs(text, longest)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = [r for r, (_, text) in zip(out, docs) if len(folded(text)) >= least]
    for k, r in enumerate(sorted(enough, key=lambda r: (-r[3], r[0]))[: percent * len(enough) // 100]):
        r[4] = k + 1
    return sorted((tuple(r) for r in out), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_plain_sums(spark, longest):
    from admitflow.llm.resample import importance_resample

    rng = random.Random(longest)
    vocabulary = ["Alpha", "beta", "GAMMA9", "ñandú", "Ärger", "x", "東京", "zz1"] + [f"t{i}" for i in range(300)]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 60, 400])))) for i in range(300)] + [(300, None)]
    target = [" ".join(rng.choices(vocabulary[:40], k=30)) for _ in range(20)] + [None, ""]
    got = importance_resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"), percent=33, longest=longest)
    assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr) == brute_resample(docs, target, 33, longest)


def test_bit_planes_add_up_exactly():
    from admitflow.llm.resample import GainSums

    rng = np.random.default_rng(2)
    gains = rng.integers(-40_000, 40_000, 1003)
    counts = rng.integers(0, 3, (9, 1003)) * rng.integers(0, 2**20, (9, 1003))
    assert GainSums(gains).of(counts).tolist() == (counts @ gains).tolist()
    assert GainSums(np.zeros(8, np.int64)).of(counts[:, :8]).tolist() == [0] * 9


def test_pieces_of_a_text_keep_words_and_runs():
    from admitflow.llm.resample import _Buckets, _features, _words

    raw = b"one TWO-three  four 5 " * 50 + b"x" * 100
    for piece in (7, 37, 1000):
        assert [w.decode() for p in _words(raw, piece) for w in p] == folded(raw.decode())
    known = _Buckets(10_000)
    whole = "ab cd " * 200_000
    found = Counter(np.concatenate(list(_features(whole.encode(), 2, known))).tolist())
    assert found == Counter(zlib.crc32(f.encode()) % 10_000 for f in runs(whole, 2))


def test_resampling_of_odd_rows_and_empty_tables(spark, odd):
    from admitflow.llm.resample import drawn_documents, importance_resample

    rows = importance_resample(odd, odd, percent=50).collect()
    assert len(rows) == 8 and [r.rank for r in rows if r.rank] == [1] and {r.weight for r in rows if not r.n_features} == {0}
    empty = spark.createDataFrame([], DOCS)
    assert importance_resample(empty, odd).count() == 0
    assert len([r for r in importance_resample(odd, empty, percent=100).collect() if r.rank]) == 2
    docs = spark.createDataFrame([(i, "some words " * 20) for i in range(40)], "doc_id long, text string")
    assert drawn_documents(docs, importance_resample(docs, empty, percent=25)).count() == 10


def test_ranks_of_repeated_ids(spark):
    from admitflow.llm.resample import importance_resample

    docs = spark.createDataFrame([(7, "word " * 30)] * 500, "doc_id long, text string").repartition(5)
    ranks = [r.rank for r in importance_resample(docs, docs, percent=20).collect() if r.rank]
    assert sorted(ranks) == list(range(1, 101))


def test_subset_sums_are_the_nearest():
    from admitflow.llm.mixing import subset_sum

    rng = random.Random(4)
    for _ in range(200):
        size = rng.sample(range(1, 30), rng.randint(1, 5))
        n = [rng.randint(0, 3) for _ in size]
        goal = rng.randint(0, 120)
        take = subset_sum(np.array(size), np.array(n), goal)
        assert all(0 <= a <= b for a, b in zip(take, n))
        near = min(abs(goal - sum(a * b for a, b in zip(size, t))) for t in itertools.product(*(range(k + 1) for k in n)))
        assert abs(goal - int((take * size).sum())) == near


def test_fits_reach_the_budget_with_a_like_share_of_all_sizes():
    from admitflow.llm.mixing import fit_copies

    rng = np.random.default_rng(1)
    sizes, n = np.arange(1, 3000), rng.integers(1, 200, 2999)
    for share in (0.01, 0.37, 0.93):
        budget = int((sizes * n).sum() * share)
        take = fit_copies(sizes, n, budget)
        assert int((sizes * take).sum()) == budget and (take <= n).all() and (take >= 0).all()
        assert abs(take[:1000].sum() / n[:1000].sum() - share) < 0.02 and abs(take[2000:].sum() / n[2000:].sum() - share) < 0.02
    # Sizes past the programme's sums, none of which needs to fit.
    huge, few = np.array([300_000, 700_000, 1_000_000]), np.array([3, 2, 2])
    take = fit_copies(huge, few, 2_100_000)
    assert abs(int((huge * take).sum()) - 2_100_000) <= 300_000 and (take <= few).all()


def brute_targets(sizes, weights, most=3):
    target, capped, total = {}, set(), sum(sizes)
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        target = {i: most * sizes[i] if i in capped else left * weights[i] / w for i in range(len(sizes))}
        over = {i for i in target if i not in capped and target[i] > most * sizes[i]}
        if not over:
            return [target[i] for i in range(len(sizes))]
        capped |= over


def test_mix_meets_its_targets(spark):
    from admitflow.llm.mixing import mix_sources, mixed_documents

    rng = random.Random(9)
    docs = []
    for source, n in (("s1", 400), ("s10", 30), ("Ω", 3), (None, 100), ("zero", 4), ("s2", 900)):
        for _ in range(n):
            docs.append((len(docs), source, None if rng.random() < 0.02 else "\n".join(["w"] * (0 if source == "zero" else rng.choice([7, 7, 7, rng.randint(1, 300)])))))
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    rows = mix_sources(df).collect()
    assert sorted((r.doc_id, r["size"]) for r in rows) == sorted((d, len((t or "").split())) for d, _, t in docs)
    names = sorted({s for _, s, _ in docs if s is not None}) + [None]
    sizes = [sum(len((t or "").split()) for _, s, t in docs if s == name) for name in names]
    targets = brute_targets(sizes, [i % 3 + 1 for i in range(len(names))])
    for name, size, target in zip(names, sizes, targets):
        mine = [r for r in rows if r.source == name]
        assert {r.source_size for r in mine} == {size} and all(abs(r.target - target) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= 1
        assert all(r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"] for r in mine)
    again = mix_sources(df.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    assert mixed_documents(df, mix_sources(df)).count() == sum(r.repeats for r in rows)


def test_mix_of_odd_rows_and_empty_tables(spark, odd):
    from admitflow.llm.mixing import mix_sources

    rows = mix_sources(odd).collect()
    assert len(rows) == 8 and all(0 <= r.taken <= 3 * r["size"] for r in rows) and {r.source for r in rows} == {"a", "b", None}
    assert sum(r.taken for r in rows) > 0
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    assert {r.taken for r in mix_sources(spark.createDataFrame([(1, "", None, "a", 0)], DOCS)).collect()} == {0}


def brute_trie(rows):
    """Nodes by prefixes as tuples; equal turns in the order of a digest of role and text."""
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[:32], role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in said.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(int(math.fmod(c, -100 if c < 0 else 100)) * -1 + c, [])[:h] + turns[h:]
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(built[c]) == len(p))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items()), key=repr)


def trie(spark, rows, **options):
    from admitflow.llm.prefix_trie import conversation_trie

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return sorted(map(tuple, conversation_trie(df, **options).collect()), key=repr)


def test_trie_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice("ua"), rng.choice(["x", "yy", "ñ€", "𝄞"])) for c in range(-20, 230) for t in range(rng.choice([1, 2, 3, 7, 12]))]
    rows += [(c, t, "u", "same") for c in range(300, 340) for t in range(20)]
    rows += [(c, t, "u", str(t)) for c in (400, 433) for t in range(50)]
    assert trie(spark, rows, most_turns=5, window=2) == trie(spark, rows) == brute_trie(rows)


def test_trie_of_odd_rows_and_empty_tables(spark):
    rows = [(500, None, None, None), (501, None, "a", "b"), (501, None, "a", "a"), (501, 0, None, "q"), (501, 0, None, "q"), (None, 0, "u", "x"), (999, 0, "a", "zz"), (2**62, 1, "", "t" * 100_000)]
    assert trie(spark, rows) == trie(spark, rows, most_turns=1, window=1) == brute_trie(rows)
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []
    # All conversations lose their only turn: the root is the only node, and a leaf.
    bare = [(c, 0, "u", "x") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6]
    assert trie(spark, bare) == brute_trie(bare) and len(trie(spark, bare)) == 1


def test_ends_of_one_node_over_many_partitions(spark):
    from admitflow.llm.prefix_trie import _ends

    ids = list(range(5000))
    random.Random(1).shuffle(ids)
    steps = spark.createDataFrame([(c, 1, 1, (5, 6)) for c in ids], "conv long, depth long, length long, node struct<hi:long,lo:long>").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _ends(steps).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()]


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_conversation_trie"])
def test_query_equals_sql(spark, name):
    from admitflow.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(expected, key=repr)


def test_mixing_query_meets_its_targets(spark):
    """Sources of about ten documents: all sums that copies can make are tried."""
    from admitflow.llm.queries import QUERIES

    sources = defaultdict(list)
    for r in QUERIES["op12_source_mixing"](spark, SF).collect():
        sources[r.source].append(r)
    for rows in sources.values():
        sums = {0}
        for r in rows:
            sums = {s + k * r["size"] for s in sums for k in range(4)}
        goal = round(rows[0].target)
        assert abs(sum(r.taken for r in rows) - goal) <= max(2, 2 * min(abs(s - goal) for s in sums))
