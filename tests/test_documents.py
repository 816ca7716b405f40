"""Geometry, cells, discovery, files and streams on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from admitflow.functions import scalars as s
from admitflow.functions import vocabulary as v
from admitflow.operators import cells, discovery, ensemble, geometry, pages, refdata
from admitflow.schemas import PAGE_CHARS, PAGE_WORDS, TABLE_CELLS

PROFILE = {
    "layout": {
        "code_pattern": r"[A-Z]\d[A-Z0-9]{3,4}", "header_keywords": ["english", "code", "aps"], "rotated_headers": True, "footnote_markers": ["**"], "campus_tokens": ["APB", "DFC"],
        "not_accepted_phrases": ["Not accepted"], "alternative_phrases": ["OR"],
    }
}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def turned(text, x, advance, seq, top, step=5.0):
    """Rotated characters of one line: reading up the page, ``advance`` grows by 8 * step."""
    return [("d", 1, seq + k, c, False, 0.0, 8.0, -8.0, 0.0, x, (advance / 8) + k * step, x, x + 8, top + k, top + k + 1) for k, c in enumerate(text)]


def test_text_layer_table(spark):
    rows, seq = [], 0
    lines = [("English", 100, 4000), ("Mathematics", 150, 4000), ("OR", 180, 4000), ("Technical Science", 210, 4000), ("Code", 50, 4000), ("APS", 250, 4000)]
    for r, (code, english, maths, other, score) in enumerate([("B8BA3Q", "5 (60%+)", "4", "Not accepted", "30"), ("B8CD4Q", "4", "", "5", "28 with Mathematics")]):
        top, advance = 100 + 60 * r, 1000 + 1000 * r
        lines += [(code, 50, advance, top), (english, 100, advance, top), (maths, 150, advance, top), (other, 210, advance, top), (score, 250, advance, top)]
        if r == 1:
            lines.append(("OR", 180, advance, top))
    for text, x, advance, *top in lines:
        rows += turned(text, float(x), float(advance), seq, float(top[0] if top else 10), step=3.0 if not top else 2.0)
        seq += len(text)
    chars = spark.createDataFrame(rows, PAGE_CHARS)
    words = spark.createDataFrame([("d", 1, "Bachelor", 5.0, 20.0, 100.0), ("d", 1, "of", 21.0, 25.0, 100.0), ("d", 1, "Science", 5.0, 20.0, 110.0), ("d", 1, "Diploma", 5.0, 20.0, 161.0), ("d", 1, "APB", 300.0, 310.0, 101.0)], PAGE_WORDS)
    exclusions = spark.createDataFrame([("d", 1, ["history"])], "doc string, page int, excluded array<string>")
    got = sorted(geometry.text_layer_records(chars, words, exclusions, PROFILE).collect(), key=lambda r: r.code)
    assert [(r.code, r.name, r.campus, r.excluded) for r in got] == [("B8BA3Q", "Bachelor of Science", ["APB"], ["history", "technical_sciences"]), ("B8CD4Q", "Diploma", [], ["history"])]
    first, second = (json.loads(r.tree)["rules"] for r in got)
    assert [(n.get("language") or n.get("subject"), n["min_level"]) for n in first] == [("english", 5), ("mathematics", 4)]
    assert second == [{"kind": "any", "rules": [{"kind": "subject", "language": "english", "min_level": 4}, {"kind": "subject", "subject": "technical_sciences", "min_level": 5}]}]
    assert [[(e.min_score, e.requires_subject) for e in r.score] for r in got] == [[(30, None)], [(28, "mathematics")]]
    assert geometry.text_layer_records(chars, words, exclusions, {"layout": {**PROFILE["layout"], "rotated_headers": False}}).count() == 0


def test_runs_part_at_gaps_and_columns(spark):
    rows = turned("ab", 10.0, 0.0, 0, 0.0) + turned("cd", 10.0, 500.0, 2, 0.0) + turned("ef", 30.0, 0.0, 4, 0.0)
    got = geometry.rotated_runs(spark.createDataFrame(rows, PAGE_CHARS)).orderBy("run").collect()
    assert sorted(r.text for r in got) == ["ab", "cd", "ef"]
    page = spark.createDataFrame([("d", 1, "base"), ("d", 2, None)], "doc string, page int, text string")
    texts = {r.page: r.text for r in geometry.repaired_text(page, spark.createDataFrame(rows, PAGE_CHARS)).collect()}
    assert texts[1].startswith("base\n") and {"ab", "cd", "ef"} < set(texts[1].split("\n")) and texts[2] == ""


def test_runs_of_odd_characters(spark):
    lost = ("d", 2, 9, "z", False, 0.0, 8.0, -8.0, 0.0, 10.0, None, None, None, None, None)
    rows = turned("ab", 10.0, 0.0, 0, 1.0) + [r[:1] + (2,) + r[2:] for r in turned("ba", 10.0, 0.0, 5, 1.0)] + [lost] + [r[:4] + (True,) + r[5:] for r in turned("up", 10.0, 0.0, 0, 1.0)]
    got = {(r.page, r.text): (r.run, r.x0, r.top, r.bottom) for r in geometry.rotated_runs(spark.createDataFrame(rows, PAGE_CHARS)).collect()}
    assert got == {(1, "ab"): (0, 10.0, 1.0, 3.0), (2, "z"): (0, None, None, None), (2, "ba"): (1, 10.0, 1.0, 3.0)}
    assert geometry.rotated_runs(spark.createDataFrame([], PAGE_CHARS)).count() == 0


@pytest.mark.parametrize("name", ["rotated_runs", "repaired_pages", "prose_pages"])
def test_characters_are_not_exchanged(spark, name):
    """Texts are dealt out by page; the characters made from them stay where they are."""
    from admitflow.plans import stream_queries  # noqa: F401
    from admitflow.plans.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(plan) if "posexplode(split(" in line)
    depth = lambda k: len(plan[k]) - len(plan[k].lstrip(" +-:"))
    above, low = [], depth(at)
    for k in range(at, -1, -1):
        if depth(k) < low:
            above, low = [*above, plan[k]], depth(k)
    places = next(k for k, line in enumerate(above) if "Window " in line)
    assert not any("Exchange" in line for line in above[:places])


def test_prose_of_rows_and_of_arrays(spark):
    words = [("d", 1, "b", 9.0, 10.0, 5.0), ("d", 1, "a", 1.0, 2.0, 5.04), ("d", 3, "c", 1.0, 2.0, 1.0)]
    rows = spark.createDataFrame(words, PAGE_WORDS)
    arrays = rows.groupBy("doc", "page").agg(F.collect_list(F.struct("top", "x0", "text")).alias("words")).unionByName(spark.createDataFrame([("d", 4, [])], "doc string, page int, words array<struct<top:double,x0:double,text:string>>"))
    chars = spark.createDataFrame(turned("ab", 10.0, 0.0, 0, 0.0) + [r[:1] + (2,) + r[2:] for r in turned("cd", 10.0, 0.0, 0, 0.0)], PAGE_CHARS)
    for given, placed in ((rows, False), (arrays, False), (arrays, True)):
        got = geometry.prose_text(given, chars.repartition(3, "page") if placed else chars, placed).collect()
        assert {r.page: r.text for r in got} == {1: "a b\nab", 2: "\ncd", 3: "c"}


def grid(rows, strategy="lattice", page=1):
    return [("d", page, strategy, r, c, t, 10, 0) for r, row in enumerate(rows) for c, t in enumerate(row)]


def test_geometric_table(spark):
    header = ["Code", "Name", "English", "Physical Science", "OR", "Mathematics / Technical Mathematics", "APS", "Campus"]
    rows = grid([["stray", "", "", "", "", "", "", ""], header, [" B8BA3Q ", "Civil\nEngineering", "5", "4", "6", "3", "28 with Mathematics", "APB DFC"], ["no", "code", "4", "4", "", "4", "", ""]])
    rows += grid([["x", "B8BA3Q"]], "stream")
    empty = spark.createDataFrame([], "doc string, page int, excluded array<string>")
    got = geometric(spark, rows, empty)
    assert [(r.code, r.name, r.campus, [(e.min_score, e.requires_subject) for e in r.score]) for r in got] == [("B8BA3Q", "Civil Engineering", ["APB", "DFC"], [(28, "mathematics")])]
    rules = json.loads(got[0].tree)["rules"]
    assert rules[0]["language"] == "english" and rules[1] == {"kind": "subject", "subject": "physical_sciences", "min_level": 4}
    # The cell under the marker joins the next resolved column, whose first number is then the marker's.
    assert [r["min_level"] for r in rules[2]["rules"]] == [6, 6]


def geometric(spark, rows, exclusions, **layout):
    profile = {"layout": {**PROFILE["layout"], **layout}}
    return geometry.geometric_records(spark.createDataFrame(rows, TABLE_CELLS), exclusions, profile).orderBy("page", "row").collect()


def test_geometric_table_with_many_rows(spark):
    rows = grid([["Code", "APS", "English"], ["lost", "Mathematics", "4"], ["B8BA3Q", "Degree", "30"], ["", "English", "4 (50-59%)"], ["", "Mathematics OR\nMathematics Literacy", "4\n5"], ["", "History", "Not accepted"], ["B8CD4Q", "Other", "25"], ["", "Geography\nMusic", "4"]])
    exclusions = spark.createDataFrame([("d", 1, ["music"])], "doc string, page int, excluded array<string>")
    got = geometric(spark, rows, exclusions, rows_per_programme="many", mutually_exclusive_subjects=[["mathematics", "mathematical_literacy"]])
    assert [(r.code, r.name, r.excluded) for r in got] == [("B8BA3Q", "Degree", ["history", "music"]), ("B8CD4Q", "Other", ["music"])]
    rules = json.loads(got[0].tree)["rules"]
    assert rules[0]["kind"] == "any" and [n["min_level"] for n in rules[0]["rules"]] == [4, 5] and rules[1]["language"] == "english"
    assert json.loads(got[1].tree)["rules"] == []


@pytest.mark.parametrize(
    "text, expected",
    [("26 with Mathematics OR 28 with Mathematical Literacy", [(26, "mathematics"), (28, "mathematical_literacy")]), ("28 with Mathematics / Technical Mathematics", [(28, "mathematics"), (28, "technical_mathematics")]), ("26 OR 28 with Mathematics", None), ("3 (40%+)", None), ("30", [(30, None)]), (None, None), ("", None), ("13 or 49", None)],
)
def test_score_cells(spark, text, expected):
    got = one(spark, cells.score_cell(F.lit(text).cast("string")))
    assert (got and [(e.min_score, e.requires_subject) for e in got]) == expected


@pytest.mark.parametrize("token, expected", [("QSAM6D", True), ("B8BA3Q", False), (")+%06(", True), ("detpecca", True), ("toN", True), ("", False), (None, False)])
def test_reversed_tokens(spark, token, expected):
    assert one(spark, s.looks_reversed(F.lit(token).cast("string"), F.lit(r"[A-Z]\d[A-Z0-9]{3,4}"))) is expected


def test_scalars(spark):
    markers = F.array(F.lit("*"), F.lit("**"), F.lit("#"))
    assert one(spark, s.detect_markers(F.lit("a** b"), markers)) == ["**"]
    assert one(spark, s.detect_markers(F.lit("a** b*#"), markers)) == ["**", "#", "*"]
    assert one(spark, s.all_aliases(F.lit("Technical  Mathematics, english and Music"))) == ["technical_mathematics", "english", "music"]
    assert one(spark, s.longest_alias(F.lit("mathematics or technical mathematics"))) == "technical_mathematics"
    assert one(spark, s.resolve_header(F.lit(" Physical  Science **"), F.array(F.lit("**")))) == "physical_sciences"
    assert one(spark, s.strip_year_suffix(F.lit("Uni 2027 Prospectus "), F.lit(2027))) == "Uni" == one(spark, s.strip_year_suffix(F.lit("Uni prospectus 2027"), F.lit(2027)))
    assert one(spark, s.density(F.lit(3), F.lit(0.0), F.lit(5.0))) == 0 and one(spark, s.numeric_ratio(F.lit(""))) == 0
    assert [one(spark, s.level(F.lit(p))) for p in (-1, 0, 29, 30, 79, 80, 100, 101)] == [None, 1, 1, 2, 6, 7, 7, None]
    with pytest.raises(Exception, match="out of range"):
        one(spark, s.strict_level(F.lit(101)))
    assert one(spark, s.names_equal(F.lit("Civil  Engineering"), F.lit("bachelor of CIVIL engineering"))) and not one(spark, s.names_equal(F.lit(None).cast("string"), F.lit("x")))


def test_page_classes(spark):
    row = (0.005, 1, 1, 0.1, 10, 0.0, 1, 0)
    names = ", ".join(f"{n} {'double' if isinstance(x, float) else 'int'}" for n, x in zip(v.SIGNALS, row))
    signalled = spark.createDataFrame([("d", 1, *row), ("d", 2, 0.0, 0, 0, 0.0, 0, 0.9, 0, 0), ("d", 3, 0.0, 0, 0, 0.0, 0, 0.0, 0, 0)], f"doc string, page int, {names}")
    got = {r.page: r for r in pages.classify(signalled, v.DEFAULT_PROFILE["classification"]).collect()}
    assert got[1].score_scoring_methodology > got[1].score_programme_table and got[1].page_class == "programme_table"
    assert got[2].page_class == "decorative" and got[3].page_class == "admin"
    result = pages.classification_result(pages.classify(signalled, v.DEFAULT_PROFILE["classification"])).first()
    assert result.page_count == 3 and result.table_pages == [1] and result.stats == {"programme_table": 1, "decorative": 1, "admin": 1}


def test_triage(spark):
    table = "\n".join(["Qualification Campus", *[f"Diploma in Things {k} 30 4 5" for k in range(10, 60)]])
    rows = [("full", 1, table, 0), ("blank", 1, " \n", 0), ("blank", 2, None, 0), ("some", 1, "Summary\nB8BA3Q 30\n4 (50%-59%) 4 (50%) 3 (40%) 2 (30%)", 5)]
    got = {r.doc: r for r in pages.triage(spark.createDataFrame(rows, "doc string, page int, text string, n_rotated int")).collect()}
    assert {d: r.verdict for d, r in got.items()} == {"full": "LIKELY_FULL", "blank": "UNREADABLE", "some": "LIKELY_SUMMARY"}
    assert (got["some"].estimated_programme_rows, got["some"].rotated_pages, got["some"].self_describes_partial) == (2, 1, ["summary"])
    path = lambda p: spark.range(1).select(*pages.document_identity(F.lit(p), 2020)).first()
    assert tuple(path("/a/uj_2027.pdf")) == ("uj", 2027) and tuple(path("/a/2026/Tut.pdf")) == ("Tut", 2026) and tuple(path("x.pdf")) == ("x", 2020)


def test_votes(spark):
    columns = "method string, ordinal int, qualification_code string, name string, campus array<string>, subjects string, selection_notes array<string>"
    a = json.dumps({"kind": "any", "rules": [{"kind": "subject", "subject": "music", "min_level": 3}, {"kind": "subject", "subject": "design", "min_level": 4}]})
    b = json.dumps({"kind": "any", "rules": json.loads(a)["rules"][::-1]})
    rows = [("a", 0, "X", "one", ["p", "q"], a, ["n1"]), ("b", 0, "X", "one", ["q", "p"], b, ["n2", "n1"]), ("c", 0, "X", "two", None, None, None), ("a", 0, "Y", "one", None, None, None), ("b", 0, "Y", "two", None, None, None)]
    got = {(r.code, r.field): r for r in ensemble.vote(ensemble.votes(spark.createDataFrame(rows, columns))).collect()}
    assert (got["X", "name"].value, got["X", "name"].confidence, got["X", "name"].minority) == ("one", 0.66, {"c": "two"})
    assert got["X", "campus"].confidence == 1.0 and got["X", "subjects"].confidence == 1.0 and got["X", "subjects"].value == a
    assert (got["Y", "name"].value, got["Y", "name"].confidence, got["Y", "name"].minority) == (None, 0.0, {"a": "one", "b": "two"})
    assert (got["Y", "campus"].value, got["Y", "campus"].confidence, got["Y", "campus"].minority) == (None, 0.0, None)
    assert got["Y", "qualification_code"].confidence == 1.0
    merged = {r.code: r for r in ensemble.reconcile(spark.createDataFrame(rows, columns)).collect()}
    assert merged["X"].selection_notes == ["n1", "n2"] and merged["X"].needs_review and merged["X"].career_text is None and merged["X"].weak_fields == {"name": 0.66}


def test_gate(spark):
    columns = "method string, ordinal int, qualification_code string, name string, faculty string, campus array<string>, score array<struct<min_score:int,requires_subject:string>>, subjects string, excluded_subjects array<string>"
    rows = [("a", 0, "X", "Arts", None, ["p"], None, None, None), ("b", 0, "X", "Arts", None, ["p"], None, None, None), ("a", 0, "Y", "Law", None, ["p"], None, None, None), ("b", 0, "Y", "Law", None, ["q"], None, None, None), ("a", 0, None, "None", None, None, None, None, None)]
    truth = [("t", 0, "X", "Arts and more", None, ["q"], None, None, None), ("t", 0, "Z", "Music", None, None, None, None, None), ("t", 0, None, "None", None, None, None, None, None)]
    frame = lambda x: spark.createDataFrame(x, columns)
    one = ensemble.gate(frame(rows), frame(truth).drop("method")).first()
    # X: code, name and campus agreed, campus wrong; Y isn't in the truth and is weak in campus; faculty and the like were never tried.
    assert (one.present, one.found, one.agreed, one.wrong, one.records, one.for_review) == (3, 1, 3, 1, 3, 1)
    assert (one.recall, one.false_agreement, one.queue_fraction, one.passed) == (1 / 3, 1 / 3, 1 / 3, False)
    wrong = {r.field: (r.agreed, r.wrong) for r in ensemble.wrong_by_field(frame(rows), frame(truth).drop("method")).collect()}
    assert wrong == {"qualification_code": (1, 0), "name": (1, 0), "campus": (1, 1)}
    none = ensemble.gate(frame([]), frame([]).drop("method")).first()
    assert (none.present, none.records, none.recall, none.false_agreement, none.queue_fraction, none.passed) == (0, 0, 0.0, 0.0, 0.0, False)


def test_discovery(spark):
    html = '<h2 class="a elementor-heading-title"><a href="https://h/prospectuses/uj/">UJ &amp; friends Prospectus</a></h2><h2 class="elementor-heading-title">none</h2><h2 class="elementor-heading-title"><a href="/prospectuses/eduvos">E</a></h2>'
    listing = spark.createDataFrame([("headings", 2027, html), ("headings", 2027, None)], "source string, academic_year int, html string")
    assert [(r.source_id, r.display_name) for r in discovery.heading_listing(listing).collect()] == [("uj", "UJ & friends")]
    viewer = 'x previewFile({content: {location: { url: "https:\\/\\/h\\/a.PDF"}}})'
    assert one(spark, discovery.viewer_document(F.lit(viewer))) == "https://h/a.PDF" and one(spark, discovery.viewer_document(F.lit(viewer.replace("PDF", "doc")))) is None
    page = '<title>UJ 2027</title><a href="/no">n</a><a class="b" href="/u.pdf" download="">d</a>'
    assert one(spark, discovery.download_document(F.lit(page), F.lit(2027))) == "/u.pdf" and one(spark, discovery.download_document(F.lit(page), F.lit(2026))) is None


def test_files_round_trip(spark, tmp_path):
    from admitflow.sources import files, sinks

    tree = {"kind": "all", "rules": [{"kind": "subject", "language": "english", "min_level": 4}]}
    programme = {"institution_id": "u", "academic_year": 2027, "qualification_code": "B8BA3Q", "name": "N", "duration_years": 0, "requirements": {"nsc": {"score": [{"min_score": 30}], "subjects": tree}}}
    (tmp_path / "seeds/u").mkdir(parents=True)
    (tmp_path / "seeds/u/a.json").write_text(json.dumps([programme, {**programme, "qualification_code": "B8BA4Q"}]))
    (tmp_path / "seeds/u/b.json").write_text(json.dumps([{**programme, "name": "later"}]))
    (tmp_path / "seeds/institutions.json").write_text(json.dumps([{"id": "u", "name": "U", "scoring_strategy": "aps_best6_excl_lo"}]))
    seeds = files.seed_programmes(spark, str(tmp_path / "seeds"))
    institutions = files.institutions(spark, str(tmp_path / "seeds/institutions.json"))
    rows = seeds.orderBy("ordinal").collect()
    assert [r.name for r in rows] == ["N", "N", "later"] and json.loads(rows[0].subjects) == tree and rows[0].campus == [] and rows[0].confidence == "verified"
    errors = refdata.with_source_file(refdata.validate(seeds, institutions), seeds).collect()
    assert [(r.tag, r.error, r.source_file.rsplit("/", 1)[-1]) for r in errors] == [("u/B8BA3Q", "duplicate code for year", "b.json")]
    assert [r.error for r in refdata.validate(seeds.limit(0), institutions).collect()] == ["no programmes found"]
    out = refdata.export_view(seeds, [2027]).select("institution_id", "qualification_code", "duration_years")
    sinks.export_dataset(institutions, out, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/programmes")).count() == 3 and out.first().duration_years is None
    (tmp_path / "exported.json").write_text(json.dumps({"institutions": [{"id": "u", "name": "U", "scoring_strategy": "s"}], "programmes": [programme]}))
    i, p = files.exported(spark, str(tmp_path / "exported.json"))
    assert i.first().id == "u" and p.first().score[0].min_score == 30
    with pytest.raises(ValueError, match="refusing"):
        refdata.refuse_below(seeds, 10)
    good = {"name": "n", "layout": v.DEFAULT_PROFILE["layout"], "classification": v.DEFAULT_PROFILE["classification"]}
    (tmp_path / "registry.json").write_text(json.dumps({"u": good}))
    assert [(r.institution_id, json.loads(r.profile)) for r in files.checked_profiles(spark, str(tmp_path / "registry.json")).collect()] == [("u", good)]
    broken = {"name": "n", "layout": {**good["layout"], "code_pattern": "(", "header_keywords": [], "odd": 1}, "classification": {**good["classification"], "admin_baseline": "x"}}
    more = {"name": "n", "layout": {**good["layout"], "rotated_headers": "no", "mutually_exclusive_subjects": [["a"]], "rows_per_programme": "some"}, "classification": {**good["classification"], "weights": {**good["classification"]["weights"], "admin": {"odd": 1}}}}
    profiles = spark.createDataFrame([("u", json.dumps(broken)), ("w", '{"name": 1}'), ("x", json.dumps(good)), ("y", "[1]"), ("z", json.dumps(more))], "institution_id string, profile string")
    problems = {}
    for r in refdata.profile_problems(profiles).collect():
        problems.setdefault(r.institution_id, set()).add(r.problem)
    assert len(problems["u"]) == 4 and {p.split(":")[0] for p in problems["u"]} == {"unknown key odd in layout", "code_pattern does not compile", "header_keywords must be a list that isn't empty", "admin_baseline must be numeric"}
    assert problems["w"] == {"missing key layout in profile", "missing key classification in profile"} and "x" not in problems
    assert "not an object in profile" in problems["y"]
    assert problems["z"] == {"rotated_headers must be a boolean", "mutually_exclusive_subjects must hold groups of two or more subjects", "rows_per_programme must be one or many", "weights of admin have unknown signal odd"}
    (tmp_path / "bad.json").write_text(json.dumps({"u": broken}))
    with pytest.raises(ValueError, match="u: admin_baseline"):
        files.checked_profiles(spark, str(tmp_path / "bad.json"))
    batch = lambda *rows: spark.createDataFrame(list(rows), "id string, name string, version int")
    assert sinks.current_version(spark, str(tmp_path / "t")) is None
    sinks.merge_table(batch(("a", "one", 0), ("a", "two", 1), ("b", "b", 0)), str(tmp_path / "t"), ["id"], order="version")
    got = sinks.merge_table(batch(("b", "new", 0), ("c", "c", 0)), str(tmp_path / "t"), ["id"], order="version", stamp="changed_at")
    assert sorted((r.id, r.name) for r in got.collect()) == [("a", "two"), ("b", "new"), ("c", "c")] and sinks.current_version(spark, str(tmp_path / "t")) == 1


def test_inbox_stream(spark, tmp_path):
    from admitflow.streaming import streams

    for name, content in (("odd/0.pdf", b"%PDF-1"), ("uj/2027/a.pdf", b"%PDF-1"), ("uj/2027/b.pdf", b"%PDF-1"), ("tut/2027/c.pdf", b"%PDF-2"), ("odd/d.pdf", b"%PDF-3"), ("uj/2027/e.pdf", b"junk")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    institutions = spark.createDataFrame([("uj", "UJ", "aps_best6_excl_lo"), ("tut", "TUT", "unconfigured")], "id string, name string, scoring_strategy string")
    run = lambda: streams.run_ingestion(streams.read_inbox(spark, str(tmp_path / "in")), institutions, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.institution_id or "", r.status, r.error) for r in got) == [("", "failed", "path is not institution/year/file"), ("", "failed", "path is not institution/year/file"), ("tut", "needs_profile", None), ("uj", "failed", "not a PDF"), ("uj", "pending", None)]
    (tmp_path / "in/uj/2027/again.pdf").write_bytes(b"%PDF-2")
    (tmp_path / "in/uj/2027/new.pdf").write_bytes(b"%PDF-4")
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_hooks(spark):
    from admitflow.operators import hooks

    records = spark.createDataFrame([("u", "a"), ("w", "b"), (None, "c")], "institution_id string, name string")
    assert hooks.apply_hooks(records).count() == 3
    hooks.register_hook("u")(lambda df: df.withColumn("name", F.upper("name")))
    try:
        assert sorted(r.name for r in hooks.apply_hooks(records).collect()) == ["A", "b", "c"]
    finally:
        hooks.HOOKS.clear()


def test_known_names_and_pages(spark):
    from admitflow.functions import names

    entries = spark.createDataFrame([("University Of  Johannesburg (UJ)", "uj"), ("KwaZulu-Natal CAO", "x"), ("Some College", "y"), ("WITS", "w")], "display_name string, source_id string")
    got = {r.source_id: (r.status, r.institution_id) for r in discovery.annotate(entries, names.institution_names(spark)).collect()}
    assert got == {"uj": ("MAPPED", "uj"), "x": ("SKIPPED_MULTI_INSTITUTION", None), "y": ("UNMAPPED", None), "w": ("MAPPED", "wits")}
    known = names.table_pages(spark)
    report = ensemble.page_report(known.where("page <> 95").unionByName(spark.createDataFrame([("uj_2027", 1)], known.schema)), known).first()
    assert (report.hits, report.missed, report.extra, report.passed) == (41, 1, 1, True)


def test_tables_of_pages_are_not_sent_through_the_driver(spark):
    """However small the written tables are: they grow with the pages."""
    from admitflow.plans import stream_queries  # noqa: F401
    from admitflow.plans.queries import QUERIES

    plan = QUERIES["text_layer_records"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("name", ["score_cells", "built_trees", "row_subjects", "interpreted_cells", "display_names", "merged_headers"])
def test_rows_of_one_file_are_worked_off_by_all_cores(spark, name):
    from admitflow.plans import document_queries, more_queries  # noqa: F401
    from admitflow.plans.queries import QUERIES

    assert QUERIES[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_cells_and_characters_of_one_file_are_made_by_all_cores(spark):
    from admitflow.plans import document_queries, more_queries, stream_queries

    sf = "/root/testdata/sf0.001"
    made = [document_queries._table_cells(spark, sf), more_queries._many_rows(spark, sf), stream_queries._block(spark, sf, 0, "B2", F.lit(4), 0)]
    assert all(df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism for df in made)


def test_a_bound_value_is_worked_out_once(spark):
    from admitflow.functions.scalars import bound

    got = spark.range(20).select(bound(F.rand(), lambda x: x == x).alias("same"), bound(F.lit(None).cast("int"), lambda x: x.isNull()).alias("none"))
    assert all(r.same and r.none for r in got.collect())
