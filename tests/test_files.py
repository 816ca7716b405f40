"""Readers and writers on small folders."""

import json

from pyspark.sql import functions as F

from admitflow.operators import discovery, pages, refdata
from admitflow.sources import files, sinks


def test_binary_documents(spark, tmp_path):
    (tmp_path / "in/uj/2027").mkdir(parents=True)
    (tmp_path / "in/uj/2027/a.pdf").write_bytes(b"%PDF-1 x")
    (tmp_path / "in/uj/2027/b.pdf").write_bytes(b"nothing")
    (tmp_path / "in/uj/2027/c.txt").write_bytes(b"%PDF-1 x")
    found = files.inbox(spark, str(tmp_path / "in"))
    assert sorted(r.path.rsplit("/", 1)[-1] for r in found.collect()) == ["a.pdf", "b.pdf"]
    manifest = sinks.download_manifest(found.withColumnRenamed("path", "url")).collect()
    assert [(r.size, len(r.sha256)) for r in manifest] == [(8, 64)]
    keyed = found.select(F.col("path").alias("key"), F.sha2("content", 256).alias("sha256"))
    assert sinks.put_if_new(keyed, keyed.limit(1)).count() == 1 and sinks.put_if_new(keyed, keyed).count() == 0


def test_cached_pages(spark, tmp_path):
    (tmp_path / "cache/uj_2027").mkdir(parents=True)
    (tmp_path / "cache/uj_2027/page_0012.md").write_text("| a |\n|--|\n| b |")
    cache = files.ocr_pages(spark, str(tmp_path / "cache"))
    assert [tuple(r) for r in cache.collect()] == [("uj_2027", 12, "| a |\n|--|\n| b |")]
    asked = spark.createDataFrame([("uj_2027", 12), ("uj_2027", 13)], "doc string, page int")
    hit, rest = files.split_cached(asked, cache)
    assert hit.count() == 1 and [r.page for r in rest.collect()] == [13]
    tagged = spark.createDataFrame([("d", 1, "x <|det|>word [1, 2]<|/det|> y")], "doc string, page int, markdown string")
    assert sinks.store_markdown(tagged, str(tmp_path / "kept")) == 1
    assert files.ocr_pages(spark, str(tmp_path / "kept")).collect() == [("d", 1, "x word y")]


def test_discovery_files(spark, tmp_path):
    entry = {"source": "cards", "academic_year": 2027, "source_id": "s", "display_name": "UJ", "detail_url": "u", "institution_id": "uj", "status": "MAPPED"}
    (tmp_path / "found.json").write_text(json.dumps({"entries": [entry, {**entry, "status": "UNMAPPED", "institution_id": None}]}))
    entries = files.discovered(spark, str(tmp_path / "found.json"))
    assert entries.count() == 2 and discovery.to_fetch(entries).count() == 1 and discovery.to_fetch(entries, ["tut"]).count() == 0
    sinks.write_discovered(entries, str(tmp_path / "out"))
    assert (tmp_path / "out/source=cards/academic_year=2027").is_dir()
    details = spark.createDataFrame([("u", 'location: {url: "https://h/a.pdf"')], "detail_url string, html string")
    assert {r.pdf_url for r in discovery.resolve_documents(entries, details, "cards").collect()} == {"https://h/a.pdf"}
    profiles = spark.createDataFrame([("uj", "own")], "institution_id string, profile string")
    assert {r.profile for r in discovery.with_profile(entries, profiles, "default").collect()} == {"own", "default"}
    (tmp_path / "responses.json").write_text(json.dumps({"doc": "d", "page": 1, "model": "m", "body": "{}"}))
    assert files.model_responses(spark, str(tmp_path / "responses.json")).first().page == 1


def test_layout_and_upserts(spark, tmp_path):
    rows = spark.createDataFrame([("uj", 2027, "A", 1), ("tut", 2026, "B", 1)], "institution_id string, academic_year int, code string, v int")
    sinks.write_by_institution(rows, str(tmp_path / "t"))
    assert (tmp_path / "t/institution_id=uj/academic_year=2027").is_dir()
    batch = spark.createDataFrame([("uj", 2027, "A", 2), ("uj", 2027, "A", 3), ("uj", 2027, "C", 1)], rows.schema)
    keys = ["institution_id", "academic_year", "code"]
    got = refdata.upsert(rows, batch, keys, order="v").collect()
    assert sorted((r.code, r.v) for r in got) == [("A", 3), ("B", 1), ("C", 1)]
    stamped = refdata.upsert(rows.withColumn("updated_at", F.lit(None).cast("timestamp")), batch.withColumn("updated_at", F.lit(None).cast("timestamp")), keys, order="v", stamp="updated_at")
    assert sorted((r.code, r.updated_at is None) for r in stamped.collect()) == [("A", False), ("B", True), ("C", False)]
    same = refdata.insert_missing(rows, batch, keys).collect()
    assert sorted((r.code, r.v) for r in same if r.code != "C") == [("A", 1), ("B", 1)] and len(same) == 3


def test_repair_report(spark):
    runs = spark.createDataFrame([("d", 1, "QSAM6D"), ("d", 1, "B8BA3Q"), ("d", 2, "fine")], "doc string, page int, text string")
    got = {r.page: (r.reversed_runs, r.runs, r.passed) for r in pages.repair_report(runs, r"[A-Z]\d[A-Z0-9]{3,4}").collect()}
    assert got == {1: (1, 2, False), 2: (0, 1, True)}


def test_files_are_listed_by_tasks(spark, tmp_path):
    """At any depth, without hidden ones and other endings; no plan lists files, which the driver would do."""
    for name in ("a.pdf", "uj/2027/b #1 %20.pdf", "uj/2027/_c.pdf", "_drafts/d.pdf", "uj/.e/f.pdf", "uj/g.part"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(name.encode())
    (tmp_path / "in/empty").mkdir()
    for root in (str(tmp_path / "in"), f"file://{tmp_path}/in/"):
        got = files.inbox(spark, root)
        assert got.columns == ["path", "modificationTime", "length", "content"]
        assert "binaryFile" not in got._jdf.queryExecution().executedPlan().toString()
        rows = {r.path.split("/in/")[1]: r for r in got.collect()}
        assert {k: bytes(r.content).decode() for k, r in rows.items()} == {k: k for k in ("a.pdf", "uj/2027/b #1 %20.pdf")}
        now = (tmp_path / "in/a.pdf").stat()
        first = got.where("path like '%/a.pdf'").select(F.unix_micros("modificationTime"), "length").first()
        assert abs(first[0] - now.st_mtime * 1e6) < 1e6 and first[1] == now.st_size
    assert "Python" not in files.inbox(spark, str(tmp_path / "in")).select("length")._jdf.queryExecution().optimizedPlan().toString()
    assert files.inbox(spark, str(tmp_path / "in/empty")).count() == 0


def test_keys_of_cached_pages_are_known_without_reading_them(spark, tmp_path):
    for name in ("d/page_0001.md", "d/page_0002.md", "d/deep/page_0003.md", "page_0004.md", "_e/page_0005.md", "d/other.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"text ü of {name}\n")
    got = files.ocr_pages(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == {(d, p, f"text ü of {d}/page_000{p}.md\n") for d, p in (("d", 1), ("d", 2), ("_e", 5))}
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (got, got.select("doc", "page"))]
    assert "FileScan text" not in plans[0] and "Python" not in plans[1]
