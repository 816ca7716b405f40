"""The corpus pipeline, stage by stage, against brute force."""

import zlib

import pytest

from .test_operators import SF, brute_links

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents and of each stage's result, every stage applied to all that the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "benchmark decontamination", "packing"]


def test_quality_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    judged = [r.doc_id for r in stages[0] if r.doc_id in labels]
    assert all(d in kept for d in judged if labels[d] == 1)
    bad = [d for d in judged if labels[d] == 0]
    assert sum(d not in kept for d in bad) >= 0.8 * len(bad)


def test_language_keeps_documents_with_letters(stages):
    assert {r.doc_id for r in stages[1] if any(c.isalpha() for c in r.text or "")} - {r.doc_id for r in stages[2]} == set()


def test_one_document_of_each_group_stays(stages):
    classes = {d: c for d, c, _ in brute_links([(r.doc_id, r.text) for r in stages[2]])}
    assert sorted(classes[r.doc_id] for r in stages[3]) == sorted(set(classes.values()))


def test_rows_of_one_id_are_told_apart(spark):
    """Repeated and null ids: each row stays unless its own text is a near copy of an earlier row's."""
    one, two = (" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta"))
    rows = [(1, one), (1, two), (2, one + " more"), (None, two + " more"), (None, "gamma " * 3 + one[::-1]), (3, one), (3, one), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[1], rows[4], rows[7], rows[8]], key=str)


def test_contaminated_documents_go(spark, stages):
    from admitflow.llm.decontam import Myers, normalise

    items = [normalise(r.text).strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    matchers = [(Myers(t), int(0.1 * len(t))) for t in items]
    clean = {r.doc_id for r in stages[3] if not any(m.best(normalise(r.text))[0] <= limit for m, limit in matchers)}
    assert {r.doc_id for r in stages[4]} == clean


def test_packing_holds_what_is_left(spark, stages):
    seen = {}
    for r in stages[5]:
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
        assert seen[r.doc_id] <= r.doc_tokens
    assert seen == {r.doc_id: r.doc_tokens for r in stages[5]} and set(seen) == {r.doc_id for r in stages[4]}


def test_run_gives_the_same_rows(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    key = lambda rows: zlib.crc32(repr(sorted((r.doc_id, r.doc_tokens) for r in rows)).encode())
    assert sum(r.length for r in got) == sum(r.length for r in stages[5])
    assert {r.doc_id for r in got} == {r.doc_id for r in stages[5]} and key({(r.doc_id, r.doc_tokens): r for r in got}.values()) == key({(r.doc_id, r.doc_tokens): r for r in stages[5]}.values())


def test_odd_documents_pass_all_stages(spark):
    long_text = "the long text " + " ".join(f"word{k % 9000}" for k in range(30_000))
    good = "A clean sentence of ordinary words that says nothing much, and goes on for a while to be one."
    rows = [(1, None, None, "a"), (2, "", "en", "b"), (3, good, "en", "c"), (3, good, "en", "c"), (4, good, "en", "d"), (None, good + " More of it follows here.", "en", "e"), (5, long_text, "en", "f")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, score string, quality string, accepted int")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == before.columns, name
    kept = sorted((r.doc_id or 0, r.score, r.quality, r.accepted) for r in docs.collect())
    assert (0, "e", "x", 1) in kept and (3, "c", "x", 1) in kept and not any(k[0] in (1, 2, 4) for k in kept) and len(kept) == len(set(kept))
    empty = before.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
