"""Registered queries of whole results: messages, merged records, decisions, malformed rules, sources and merges."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import vocabulary as v
from ..operators import cells, discovery, ensemble, geometry, hooks, pages, refdata, rules
from ..operators import qualify as q
from ..sources import sinks
from ..sources.keyed_table import KeyedTable
from ..sources.scratch import scratch_folder
from ..streaming import streams
from . import document_queries as d
from . import queries as base
from . import testviews as t
from .queries import query

# Qualification: what learners read


def _name_sql(key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{s_}'" for k, s_ in {**v.SUBJECT_NAMES, **v.LANGUAGE_NAMES}.items()) + " END"


_PCT = "CASE bar WHEN 1 THEN 0 WHEN 2 THEN 30 WHEN 3 THEN 40 WHEN 4 THEN 50 WHEN 5 THEN 60 WHEN 6 THEN 70 WHEN 7 THEN 80 END"
_LANGUAGE_SUBJECT = "CASE what WHEN 'english' THEN 'english_hl' WHEN 'afrikaans' THEN 'afrikaans_fal' WHEN 'isizulu' THEN 'isizulu_hl' ELSE what END"
_LANGUAGE_NAME = "CASE what WHEN 'english' THEN 'English Home Language' WHEN 'afrikaans' THEN 'Afrikaans First Additional Language' WHEN 'isizulu' THEN 'isiZulu Home Language' END"


@query(f"""WITH {t.QUALIFY}, f AS (SELECT learner_id, qualification_code, unnest(range(len(failures))) + 1 AS place, unnest(failures) AS f FROM judged WHERE len(failures) BETWEEN 1 AND 2
    ), p AS (SELECT learner_id, qualification_code, place, split_part(f, ':', 1) AS what, try_cast(split_part(f, ':', 2) AS INT) AS bar, try_cast(split_part(f, ':', 3) AS INT) AS has FROM f
    ), m AS (SELECT p.*, l.percentage FROM p LEFT JOIN marks l ON l.learner_id = p.learner_id AND l.subject = {_LANGUAGE_SUBJECT})
    SELECT learner_id, qualification_code, place::INT AS place, CASE
      WHEN what = 'score' AND bar IS NULL THEN 'Requires Mathematics or Mathematical Literacy to determine eligibility for this programme'
      WHEN what = 'score' THEN 'Requires an APS of ' || bar || '; you have ' || has
      WHEN what = 'additional' THEN 'Requires an additional language at level ' || bar || ' (' || ({_PCT}) || '%+); ' || CASE WHEN has IS NULL THEN 'you do not offer a second language' ELSE 'your best additional language is level ' || has END
      WHEN has IS NULL THEN 'Requires ' || ({_name_sql("what")}) || ' as a matric subject'
      ELSE 'Requires ' || coalesce({_LANGUAGE_NAME}, {_name_sql("what")}) || ' level ' || bar || ' (' || ({_PCT}) || '%+); you have level ' || has || ' (' || percentage || '%)' END AS message FROM m""")
def failure_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a learner reads about each requirement that a near miss lacks, in order."""
    near = base._judged(spark, sf_dir, ["qualification_code"]).where("bucket = 'near_miss'")
    # Messages are exploded by learner, rule and score list, before the programmes that share them.
    told = near.select("learner_id", "institution_id", "asked_year", "offered", F.posexplode("failures").alias("place", "f"))
    return q.listed(told).select("learner_id", "qualification_code", (F.col("place") + 1).alias("place"), "f.message")


_OPEN = t.qualify_sql("CROSS JOIN programmes p WHERE p.academic_year = 2025 + learner_id % 3")


@query(f"""WITH {_OPEN} SELECT learner_id, count(*) AS evaluated_count, count(*) FILTER (WHERE bucket = 'qualified') AS qualified,
    count(*) FILTER (WHERE bucket = 'near_miss' AND learner_id % 2 = 0) AS near_misses, count(DISTINCT institution_id) AS institutions FROM results GROUP BY learner_id""")
def open_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for one year at any institution; only some want near misses."""
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    k = F.col("c_custkey")
    asked = t.table(spark, sf_dir, "customer").select(k.alias("learner_id"), (2025 + k % 3).cast("int").alias("academic_year"), F.lit(None).cast("array<string>").alias("institutions"), (k % 2 == 0).alias("include_near_misses"))
    got = q.count_pairs(valid, asked, q.offer_of(t.programmes(spark, sf_dir), t.institutions(spark, sf_dir)))
    return q.summarise_counts(got).drop("score")


@query(f"""WITH {t.MARKS}, m AS (SELECT o_custkey AS learner_id, CASE WHEN l_partkey % 97 = 0 THEN 'alchemy' ELSE 'music' END AS subject, CASE WHEN l_suppkey % 89 = 0 THEN 101 WHEN l_suppkey % 83 = 0 THEN NULL ELSE 50 END AS percentage FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ), g AS (SELECT learner_id, count(*) AS n, count(*) FILTER (WHERE subject = 'alchemy') AS unknown, count(*) FILTER (WHERE percentage IS NULL OR percentage > 100) AS outside FROM m GROUP BY 1)
    SELECT learner_id, concat_ws('; ', CASE WHEN n NOT BETWEEN 6 AND 9 THEN 'number of subjects' END, CASE WHEN unknown > 0 THEN 'unknown subject' END, CASE WHEN outside > 0 THEN 'percentage out of range' END) AS reasons FROM g WHERE n NOT BETWEEN 6 AND 9 OR unknown > 0 OR outside > 0""")
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reason for which a request is turned down."""
    lines = t.table(spark, sf_dir, "lineitem").join(t.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    subject = F.when(F.col("l_partkey") % 97 == 0, "alchemy").otherwise("music")
    percentage = F.when(F.col("l_suppkey") % 89 == 0, 101).when(F.col("l_suppkey") % 83 == 0, F.lit(None).cast("int")).otherwise(50)
    return q.validate_requests(lines.select(F.col("o_custkey").alias("learner_id"), F.lit(0).alias("ordinal"), subject.alias("subject"), percentage.alias("percentage")))[1]


_BAD_RULES = [
    ({"kind": "subject", "subject": "music", "language": "english", "min_level": 3}, "subject", "Malformed rule: set exactly one of subject/language"),
    ({"kind": "subject", "min_level": 3}, "subject", "Malformed rule: set exactly one of subject/language"),
    ({"kind": "subject", "subject": "music", "min_level": 9}, "subject", "Malformed rule: invalid min_level 9"),
    ({"kind": "subject", "language": "latin", "min_level": 3}, "subject", "Malformed rule: unknown language family 'latin'"),
    ({"kind": "any_additional_language"}, "any_additional_language", "Malformed rule: invalid min_level None"),
    ({"kind": "riddle"}, "riddle", "Unknown rule kind 'riddle'"),
    ({"kind": "any", "rules": []}, "any", "Malformed rule: 'any' node has no branches"),
    ("text", "unknown", "Malformed rule: expected an object, got str"),
]


def _cases(column: str, texts: list[str]) -> str:
    quoted = [x.replace("'", "''") for x in texts]
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(quoted)) + " END"


@query(f"""SELECT p_partkey, place::INT AS place, CASE place WHEN 0 THEN {_cases(f"p_partkey % {len(_BAD_RULES)}", [x[1] for x in _BAD_RULES])} ELSE 'subject' END AS kind,
    CASE place WHEN 0 THEN {_cases(f"p_partkey % {len(_BAD_RULES)}", [x[2] for x in _BAD_RULES])} ELSE 'Requires Music as a matric subject' END AS message FROM part, (SELECT unnest(range(2)) AS place)""")
def malformed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed rules fail with a message, never with an error; the rules beside them are judged."""
    trees = F.element_at(F.array(*[F.lit(json.dumps({"kind": "all", "rules": [tree, {"kind": "subject", "subject": "music", "min_level": 3}]})) for tree, _, _ in _BAD_RULES]), (F.col("p_partkey") % len(_BAD_RULES) + 1).cast("int"))
    part = t.table(spark, sf_dir, "part").select("p_partkey", trees.alias("subjects"))
    marks = F.create_map(F.lit("history"), F.lit(70))
    none = F.array().cast("array<string>")
    judged = part.join(rules.flatten_trees(part), "subjects").withColumn("failures", rules.evaluate(F.col("nodes"), marks, F.transform_values(marks, lambda _, p: s.level(p)), none))
    return judged.select("p_partkey", F.posexplode("failures").alias("place", "f")).select("p_partkey", "place", "f.kind", "f.message")


# Reference data


@query(f"""WITH {t.PROGRAMMES}, tagged AS (SELECT *, institution_id || '/' || qualification_code AS tag FROM programmes)
    SELECT tag, 'no nsc requirements' AS error, 'file' || ordinal % 7 AS source_file FROM tagged WHERE ordinal % 30 = 1
    UNION ALL SELECT tag, 'empty score thresholds', 'file' || ordinal % 7 FROM tagged WHERE ordinal % 30 = 2
    UNION ALL SELECT tag, 'implausible APS ' || (least + 2), 'file' || ordinal % 7 FROM tagged WHERE conditional AND least + 2 > 48 AND ordinal % 30 NOT IN (1, 2)""")
def errors_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems with the file that each programme came from; programmes without any requirement are not checked further."""
    p, n = t.programmes(spark, sf_dir), F.col("ordinal")
    broken = p.withColumns({"score": F.when(n % 30 > 2, F.col("score")).when(n % 30 == 0, F.col("score")), "subjects": F.when(n % 30 != 1, F.col("subjects")), "excluded_subjects": F.when(n % 30 == 1, F.array(F.lit("alchemy"))).otherwise(F.col("excluded_subjects"))})
    broken = broken.withColumn("source_file", F.concat(F.lit("file"), (n % 7).cast("string")))
    return refdata.with_source_file(refdata.validate(broken, t.institutions(spark, sf_dir)), broken)


@query("SELECT 'dataset' AS tag, 'no programmes found' AS error FROM part GROUP BY ALL HAVING max(p_size) < 1000")
def empty_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset without programmes is an error of its own."""
    return refdata.validate(t.programmes(spark, sf_dir).where("academic_year > 3000"), t.institutions(spark, sf_dir))


_PROFILES = [
    ('{"name":"n"}', ["missing key layout in profile", "missing key classification in profile"]),
    ({}, []),
    ({"layout": {"code_pattern": "(", "header_keywords": [], "odd": 1}}, ["unknown key odd in layout", "header_keywords must be a list that isn't empty", "PATTERN"]),
    ({"layout": {"rotated_headers": "no", "mutually_exclusive_subjects": [["a"]], "rows_per_programme": "some"}}, ["rotated_headers must be a boolean", "mutually_exclusive_subjects must hold groups of two or more subjects", "rows_per_programme must be one or many"]),
    ({"classification": {"admin_baseline": "x", "overinclusion_margin": True}}, ["admin_baseline must be numeric", "overinclusion_margin must be numeric"]),
    ({"classification": {"weights": {"admin": {"odd": 1}}}}, ["missing key programme_table in weights", "missing key requirements_prose in weights", "missing key scoring_methodology in weights", "missing key decorative in weights", "missing key alternative_admission in weights", "weights of admin have unknown signal odd"]),
    ("[1]", ["not an object in profile"]),
]


def _profile(change) -> str:
    if isinstance(change, str):
        return change
    whole = {k: v.DEFAULT_PROFILE[k] for k in ("name", "layout", "classification")}
    return json.dumps({**whole, **{part: {**whole[part], **new} for part, new in change.items()}})


@query("SELECT doc_id AS institution_id, unnest(CASE doc_id % 7 " + " ".join(f"WHEN {k} THEN {[x.replace(chr(39), chr(39) * 2) for x in e if x != 'PATTERN']!r}".replace('"', "'") + (" || ['code_pattern does not compile']" if "PATTERN" in e else "") for k, (_, e) in enumerate(_PROFILES) if e) + " END) AS problem FROM documents WHERE doc_id % 7 <> 1")
def profile_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems of layout profiles: keys, keywords, groups, patterns, weights and numbers."""
    text = F.element_at(F.array(*[F.lit(_profile(p)) for p, _ in _PROFILES]), (F.col("doc_id") % 7 + 1).cast("int"))
    found = refdata.profile_problems(t.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("institution_id"), text.alias("profile")))
    return found.withColumn("problem", F.regexp_replace("problem", "^(code_pattern does not compile).*", "$1"))


@query("""SELECT doc_id AS row_id, unnest(['missing key code', 'unknown key x', 'confidence has unknown value maybe', 'score has fewer than 1 items', 'missing key min in nsc', 'unknown key odd in nsc']) AS error FROM documents WHERE doc_id % 4 = 1
    UNION ALL SELECT doc_id, 'not an object' FROM documents WHERE doc_id % 4 = 2 UNION ALL SELECT doc_id, 'not an object in nsc' FROM documents WHERE doc_id % 4 = 3""")
def nested_structural_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, values, numbers of items and nested keys of JSON rows."""
    k = F.col("doc_id") % 4
    body = F.when(k == 0, '{"code":"a","confidence":"sure","score":[1],"nsc":{"min":1}}').when(k == 1, '{"x":1,"confidence":"maybe","score":[],"nsc":{"odd":1}}').when(k == 2, "7").otherwise('{"code":"a","nsc":"text"}')
    rows = t.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), body.alias("body"))
    return refdata.structural_errors(rows, ["code"], ["code", "confidence", "score", "nsc"], {"confidence": ["sure", "open"]}, {"score": 1}, {"nsc": (["min"], ["min", "max"])})


@query(f"""WITH {t.PROGRAMMES}, batch AS ({base._PROGRAMME_BATCH})
    SELECT institution_id, academic_year, qualification_code, name, false AS stamped FROM programmes ANTI JOIN batch USING (institution_id, academic_year, qualification_code) UNION ALL SELECT *, true FROM batch""")
def merged_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes as stored after two merges into a table; the second sets the time of its rows."""
    keys = ["institution_id", "academic_year", "qualification_code"]
    p, table = t.programmes(spark, sf_dir), f"{scratch_folder(spark)}/programmes"
    first = p.select(*keys, "name").withColumn("changed_at", F.timestamp_seconds(F.lit(0)))
    sinks.merge_table(first, table, keys)
    newer = p.where("ordinal % 4 = 1").select(*keys, F.concat("name", F.lit(" (new)")).alias("name"))
    sinks.merge_table(newer, table, keys, stamp="changed_at")
    return KeyedTable(spark, table).read().select(*keys, "name", (F.col("changed_at") > F.timestamp_seconds(F.lit(1))).alias("stamped"))


@query(f"""WITH {t.PROGRAMMES} SELECT institution_id, qualification_code, (row_number() OVER (ORDER BY institution_id, faculty NULLS LAST, qualification_code))::INT AS place FROM programmes WHERE academic_year = 2026""")
def export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each exported programme: by institution, faculty (none last) and code."""
    rows = refdata.export_view(t.programmes(spark, sf_dir), [2026])
    return _placed(rows, "institution_id", "qualification_code")


def _placed(ordered: DataFrame, *columns: str) -> DataFrame:
    """Rows of a sorted table with their place from 1: by partition and what the partitions before it hold."""
    at = F.monotonically_increasing_id()
    part = ordered.select(*columns, F.shiftrightunsigned(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    before = part.groupBy("part").agg(F.count("*").alias("n"))
    starts = before.alias("x").join(before.alias("y"), F.expr("y.part < x.part"), "left").groupBy("x.part").agg(F.coalesce(F.sum("y.n"), F.lit(0)).alias("start")).select(F.col("part").alias("p"), "start")
    return part.join(F.broadcast(starts), F.col("part") == F.col("p")).select(*columns, (F.col("start") + F.col("at") + 1).cast("int").alias("place"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'x' END AS campus, doc_id % 3 = 1 AS extended, CASE WHEN doc_id % 5 = 0 THEN 'flagged' ELSE 'verified' END AS confidence FROM documents")
def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing arrays, flags and confidences filled in."""
    k = F.col("doc_id")
    rows = t.table(spark, sf_dir, "documents").select("doc_id", F.when(k % 2 == 1, F.array(F.lit("x"))).alias("campus"), F.when(k % 3 == 1, True).alias("extended"), F.when(k % 5 == 0, "flagged").alias("confidence"))
    return refdata.with_defaults(rows).withColumn("campus", F.array_join("campus", ","))


# Ensemble


def _with_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = base._candidates(spark, sf_dir), F.col("ordinal")
    note = lambda m: F.when(F.col("method") == m, F.array(F.lit(f"note {m}"), F.lit("shared")))
    marks = F.when((F.col("method") == "b") & (n % 5 == 0), F.array(F.lit("**"))).when((F.col("method") == "a") & (n % 10 == 0), F.array(F.lit("*"), F.lit("**")))
    return c.withColumns({"selection_notes": F.coalesce(note("a"), note("b"), note("c")), "unresolved_footnotes": F.coalesce(marks, F.array().cast("array<string>"))})


@query(f"""WITH {base._CANDIDATES}, x AS (SELECT code, any_value(n) AS n, list(method ORDER BY method) AS ms FROM cand GROUP BY code
    ), mins AS (SELECT c.code, c.field, string_agg(c.method || '=' || c.value, ',' ORDER BY c.method) AS against FROM cast_votes c JOIN voted v USING (code, field)
      WHERE c.value IS NOT NULL AND votes > 1 AND (most = 1 OR (most < votes AND c.value <> v.value)) GROUP BY ALL
    ), m AS (SELECT code, string_agg(field || ':' || against, ';' ORDER BY field) AS disagreements FROM mins GROUP BY code
    ), v AS (SELECT code, max(value) FILTER (WHERE field = 'name') AS name, max(value) FILTER (WHERE field = 'faculty') AS faculty, max(value) FILTER (WHERE field = 'campus') AS campus, max(value) FILTER (WHERE field = 'extended') AS extended,
      max(confidence) FILTER (WHERE field = 'name') AS name_confidence, max(confidence) FILTER (WHERE field = 'faculty') AS faculty_confidence FROM voted GROUP BY code)
    SELECT code, name, faculty, campus, extended, name_confidence, faculty_confidence, coalesce(disagreements, '') AS disagreements,
      CASE WHEN list_contains(ms, 'a') THEN 'note a,shared' || CASE WHEN list_contains(ms, 'b') THEN ',note b' ELSE '' END || CASE WHEN list_contains(ms, 'c') THEN ',note c' ELSE '' END
        WHEN list_contains(ms, 'b') THEN 'note b,shared' || CASE WHEN list_contains(ms, 'c') THEN ',note c' ELSE '' END ELSE 'note c,shared' END AS notes,
      CASE WHEN list_contains(ms, 'a') AND n % 10 = 0 THEN '*,**' WHEN list_contains(ms, 'b') AND n % 5 = 0 THEN '**' ELSE '' END AS footnotes FROM v JOIN x USING (code) LEFT JOIN m USING (code)""")
def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciled records with voted values, what disagrees, and notes and footnotes of all methods in order."""
    r = ensemble.reconcile(_with_notes(spark, sf_dir))
    value = lambda f: F.element_at("values", f)
    shown = F.transform(F.array_sort(F.map_keys("disagreements")), lambda f: F.when(f.isin("name", "faculty", "campus", "extended"), F.concat(f, F.lit(":"), F.array_join(F.transform(F.array_sort(F.map_entries(F.element_at("disagreements", f))), lambda e: F.concat(e["key"], F.lit("="), F.when(f == "campus", F.get_json_object(e["value"], "$[0]")).otherwise(e["value"]))), ","))))
    return r.select(
        "code", value("name").alias("name"), value("faculty").alias("faculty"), F.get_json_object(value("campus"), "$[0]").alias("campus"), value("extended").alias("extended"),
        F.element_at("confidence", "name").alias("name_confidence"), F.element_at("confidence", "faculty").alias("faculty_confidence"), F.coalesce(F.array_join(F.array_compact(shown), ";"), F.lit("")).alias("disagreements"),
        F.array_join("selection_notes", ",").alias("notes"), F.array_join("unresolved_footnotes", ",").alias("footnotes"),
    )


_DECIDED = base._GATE.replace("SELECT (SELECT count(*) FROM truth) AS present", ", counted AS (SELECT (SELECT count(*) FROM truth) AS present")
_DECIDED += f"""), methods AS (SELECT code, count(DISTINCT method) AS m FROM cand GROUP BY code), sure AS (SELECT code, bool_or(confidence < 1) AS weak FROM voted GROUP BY code
), queue AS (SELECT count(*) AS records, count(*) FILTER (WHERE weak OR m = 1) AS for_review FROM sure JOIN methods USING (code))
SELECT round(found / present, 9) AS recall, round(wrong / agreed, 9) AS false_agreement, round(for_review / records, 9) AS queue_fraction, found / present > 0.98 AND wrong / agreed < 0.02 AS passed FROM counted, queue"""


@query(_DECIDED)
def gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall, share of agreed fields that are wrong, share of records for review, and the decision."""
    truth = t.programmes(spark, sf_dir).where("ordinal % 2 = 0")
    one = ensemble.gate(base._candidates(spark, sf_dir), truth.drop("institution_id", "academic_year"))
    return one.select(*[F.round(c, 9).alias(c) for c in ("recall", "false_agreement", "queue_fraction")], "passed")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence FROM part""")
def score_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes on score lists: order and a null or absent subject don't matter, numbers do."""
    k, n = F.col("p_partkey"), (14 + F.col("p_size") % 30).cast("int")
    entry = lambda score, subject: F.struct(score.alias("min_score"), F.lit(subject).cast("string").alias("requires_subject"))
    a = F.when(k % 3 == 2, F.array(entry(n, "mathematics"), entry(n + 1, "music"))).otherwise(F.array(entry(n, None)))
    b = F.when(k % 3 == 2, F.array(entry(n + 1, "music"), entry(n, "mathematics"))).when(k % 3 == 1, F.array(entry(n + 1, ""))).otherwise(F.array(entry(n, "")))
    part = t.table(spark, sf_dir, "part")
    both = part.select("p_partkey", F.lit("a").alias("method"), a.alias("score")).unionByName(part.select("p_partkey", F.lit("b").alias("method"), b.alias("score")))
    voted = ensemble.vote(ensemble.votes(both.withColumn("qualification_code", F.col("p_partkey").cast("string"))))
    return voted.where("field = 'score'").select(F.col("code").cast("long").alias("p_partkey"), "confidence")


@query(f"""WITH {t.PROGRAMMES} SELECT institution_id, count(*) FILTER (WHERE institution_id = 'NATION_1') AS hooked, count(*) AS records FROM programmes GROUP BY 1""")
def hooked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after the step that one institution adds; the others are left as they are."""
    before = dict(hooks.HOOKS)
    hooks.register_hook("NATION_1")(lambda df: df.withColumn("name", F.concat(F.lit("hooked "), "name")))
    try:
        out = hooks.apply_hooks(t.programmes(spark, sf_dir))
    finally:
        hooks.HOOKS.clear()
        hooks.HOOKS.update(before)
    return out.groupBy("institution_id").agg(F.count_if(F.startswith("name", F.lit("hooked "))).alias("hooked"), F.count("*").alias("records"))


# Pages


@query(base._class_sql().join(["WITH classed AS (", """), c AS (SELECT doc, page_class, count(*) AS n FROM classed GROUP BY ALL)
    SELECT doc, count(*) AS page_count, coalesce(string_agg(page, ',' ORDER BY page) FILTER (WHERE page_class = 'programme_table'), '') AS table_pages,
      (SELECT string_agg(page_class || '=' || n, ',' ORDER BY page_class) FROM c WHERE c.doc = k.doc) AS stats FROM classed k GROUP BY doc"""]))
def classification_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pages, table pages in order and pages by class."""
    out = pages.classification_result(pages.classify(pages.signals(base._primitives(spark, sf_dir), base.PROFILE["layout"]), base.PROFILE["classification"]))
    stats = F.array_join(F.transform(F.map_entries("stats"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("doc", "page_count", F.array_join(F.transform("table_pages", lambda p: p.cast("string")), ",").alias("table_pages"), stats.alias("stats"))


@query(f"""WITH {t.PAGES}, w AS (SELECT doc, page, unnest(list_distinct(list_filter({base._WORDS}, lambda x: regexp_full_match(x, '[A-Z]{{2,4}}')))) AS word FROM page_text),
    c AS (SELECT doc, word, count(*) AS page_count FROM w WHERE word NOT IN ({", ".join(repr(x) for x in v.CAPITAL_STOPWORDS)}) GROUP BY ALL)
    SELECT doc, word, page_count, (row_number() OVER (PARTITION BY doc ORDER BY page_count DESC, word))::INT AS rank FROM c WHERE page_count >= 2 QUALIFY rank <= 15""")
def campus_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short capital tokens on two or more pages, fifteen at most."""
    return pages.campus_evidence(t.pages(spark, sf_dir))


@query(f"""WITH {t.PAGES}, r AS (SELECT doc, sum(n_chars)::BIGINT AS total_chars, sum(page % 2)::BIGINT AS rotated_chars FROM page_text GROUP BY doc
    ), f AS ({base._SHAPES}), k AS (SELECT doc, label, sum(len(found))::BIGINT AS n FROM f GROUP BY ALL), codes AS (SELECT doc, string_agg(label || '=' || n, ';' ORDER BY label) AS code_patterns FROM k GROUP BY doc
    ), w AS (SELECT doc, page, unnest(list_distinct(list_filter({base._WORDS}, lambda x: regexp_full_match(x, '[A-Z]{{2,4}}')))) AS word FROM page_text
    ), c AS (SELECT doc, word, count(*) AS n FROM w WHERE word NOT IN ({", ".join(repr(x) for x in v.CAPITAL_STOPWORDS)}) GROUP BY doc, word HAVING count(*) >= 2
    ), first AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n DESC, word) AS place FROM c
    ), campus AS (SELECT doc, string_agg(word, ',' ORDER BY place) AS campus_tokens FROM first WHERE place <= 15 GROUP BY doc), p AS (SELECT doc, string_agg(page, ',' ORDER BY page) AS pages_sampled FROM page_text GROUP BY doc)
    SELECT doc, pages_sampled, code_patterns, coalesce(campus_tokens, '') AS campus_tokens, total_chars, rotated_chars, rotated_chars / total_chars > 0.01 AS likely_rotated_headers FROM p JOIN r USING (doc) JOIN codes USING (doc) LEFT JOIN campus USING (doc)""")
def draft_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All evidence for a draft profile of each document, written as JSON and read back."""
    p = t.pages(spark, sf_dir)
    found = pages.profile_evidence(p.select("doc", "page", "text"), p.select("doc", "page", "n_chars", (F.col("page") % 2).alias("n_rotated")))
    folder = scratch_folder(spark)
    found.write.json(f"{folder}/drafts")
    back = spark.read.schema(found.schema).json(f"{folder}/drafts")
    listed = lambda c, f: F.array_join(F.transform(c, f), ",")
    return back.select(
        "doc", listed("pages_sampled", lambda x: x.cast("string")).alias("pages_sampled"), F.array_join(F.transform("code_patterns", lambda c: F.concat(c["label"], F.lit("="), c["total_matches"].cast("string"))), ";").alias("code_patterns"),
        F.coalesce(listed("campus_tokens", lambda c: c["word"]), F.lit("")).alias("campus_tokens"), "rotation.total_chars", "rotation.rotated_chars", "rotation.likely_rotated_headers",
    )


@query(f"""WITH {t.PAGES}, n AS (SELECT doc, count(*) AS total, count(*) FILTER (WHERE page % 9 = 0) AS rotated FROM page_text GROUP BY doc) SELECT doc, (row_number() OVER (ORDER BY rotated DESC, doc))::INT AS place FROM n""")
def triage_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each document in a report, most first, in order of names on ties."""
    found = pages.triage(base._triage_pages(spark, sf_dir)).withColumn("estimated_programme_rows", F.col("rotated_pages"))
    return _placed(pages.triage_report(found), "doc")


@query("""WITH p AS (SELECT 'n' || c_nationkey AS doc, c_custkey % 7 + c_custkey % 3 // 2 + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS n FROM customer
    ), d AS (SELECT doc, count(*) AS page_count, sum(n)::BIGINT AS estimated_programme_rows FROM p GROUP BY doc)
    SELECT doc, page_count, estimated_programme_rows, CASE WHEN estimated_programme_rows >= 50 THEN 'LIKELY_FULL' ELSE 'LIKELY_SUMMARY' END AS verdict, (row_number() OVER (ORDER BY estimated_programme_rows DESC, doc))::INT AS place FROM d""")
def triage_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents placed by their estimated programmes: lines of names and numbers, lines of codes and scores, level cells by four."""
    k = F.col("c_custkey")
    lines = F.concat(F.repeat(F.lit("Bachelor of Arts  5 4 30\n"), (k % 7).cast("int")), F.when(k % 3 == 2, "B8BA3Q: from 28 on\n").otherwise("no score here\n"), F.when(k % 5 == 0, "| 5 (60%+) 4 (50%) 3(40-49%) 5 (60%) 4 ( 50 ) |").otherwise("| 5 (60%) 4 (50%) |"))
    p = t.table(spark, sf_dir, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("doc"), k.alias("page"), lines.alias("text"), F.lit(0).alias("n_rotated"))
    return _placed(pages.triage_report(pages.triage(p)), "doc", "page_count", "estimated_programme_rows", "verdict")


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'uj' WHEN 1 THEN 'prospectus' WHEN 2 THEN 'tut-' || page_id ELSE 'x' END AS institution_id, CASE page_id % 4 WHEN 0 THEN 2025 + page_id % 3 WHEN 1 THEN 2026 WHEN 2 THEN 2020 ELSE 2020 END::INT AS academic_year FROM pages""")
def document_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institution and year from the paths of documents."""
    k = F.col("page_id")
    path = F.when(k % 4 == 0, F.concat(F.lit("/in/uj_"), (2025 + k % 3).cast("string"), F.lit(".pdf"))).when(k % 4 == 1, "/in/2026/prospectus.pdf").when(k % 4 == 2, F.concat(F.lit("/in/tut-"), k.cast("string"), F.lit(".pdf"))).otherwise("x.pdf")
    identity, year = pages.document_identity(path, 2020)
    return t.table(spark, sf_dir, "pages").select("page_id", identity.alias("institution_id"), year.alias("academic_year"))


@query("""SELECT 'd' AS doc, (p_partkey // 10)::INT AS page, count(*) AS runs, count(*) FILTER (WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0) AS reversed_runs, count(*) FILTER (WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0) = 0 AS passed FROM part GROUP BY 2""")
def reversed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that still read backwards, by page: codes, percentages and known words."""
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, "9AB8B").when(k % 5 == 0, ")+%06(").when(k % 7 == 0, "detpecca ton").otherwise(F.concat(F.lit("B8BA"), (k % 10).cast("string")))
    runs = t.table(spark, sf_dir, "part").select(F.lit("d").alias("doc"), F.floor(k / 10).cast("int").alias("page"), text.alias("text"))
    return pages.repair_report(runs, v.DEFAULT_PROFILE["layout"]["code_pattern"])


# Table methods


def _many_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with two programmes of several rows, subjects as data."""
    k = F.col("p_partkey")
    code = lambda n: F.concat(F.lit(f"B{n}"), F.lpad((k % 10000).cast("string"), 4, "0"))
    row = lambda *c: F.array(*[x if hasattr(x, "cast") else F.lit(x) for x in c])
    name = F.element_at(F.split("p_name", " "), 1)
    level = (k % 7 + 1).cast("string")
    rows = F.array(
        row("Code", "Programme", "Subject", "APS", ""),
        row(code(2), F.concat(name, F.lit(" first")), F.lit("Mathematics\nEnglish"), F.concat(level, F.lit("\n4")), (14 + F.col("p_size") % 30).cast("string")),
        row("", "", "Geography", "5", ""),
        row(code(3), F.concat(name, F.lit(" second APB")), F.lit("History\nMusic"), "4", "31"),
    )
    part = t.spread(t.table(spark, sf_dir, "part")).select(F.lit("d").alias("doc"), k.cast("int").alias("page"), F.posexplode(rows).alias("row", "cells"))
    out = part.select("doc", "page", F.lit("lattice").alias("strategy"), "row", F.posexplode("cells").alias("col", "text"))
    return out.withColumns({"n_chars": F.lit(4), "n_rotated": F.lit(0)})


def _page_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.lit("d").alias("doc"), F.col("p_partkey").cast("int").alias("page"), F.array(F.lit("technical_mathematics")).alias("excluded"))


_MANY = {"layout": {**d._METHOD_PROFILE["layout"], "rows_per_programme": "many", "header_keywords": ["code", "programme", "subject"]}}


@query("""SELECT page::INT AS page, code, name, campus, score, tree, excluded FROM (
      SELECT p_partkey AS page, 'B2' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS code, split_part(p_name, ' ', 1) || ' first' AS name, '' AS campus, (14 + p_size % 30)::INT AS score,
        '{"kind":"all","rules":[{"kind":"subject","subject":"mathematics","min_level":' || (p_partkey % 7 + 1) || '},{"kind":"subject","language":"english","min_level":4},{"kind":"subject","subject":"geography","min_level":5}]}' AS tree,
        CASE WHEN p_partkey % 2 = 0 THEN 'technical_mathematics' ELSE '' END AS excluded FROM part
      UNION ALL SELECT p_partkey, 'B3' || lpad((p_partkey % 10000)::VARCHAR, 4, '0'), split_part(p_name, ' ', 1) || ' second APB', 'APB', 31, '{"kind":"all","rules":[]}', CASE WHEN p_partkey % 2 = 0 THEN 'technical_mathematics' ELSE '' END FROM part)""")
def many_row_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes over several rows, subjects as data, with the exclusions of their pages."""
    got = geometry.geometric_records(_many_rows(spark, sf_dir), _page_exclusions(spark, sf_dir), _MANY)
    return got.select("page", "code", "name", F.array_join("campus", ",").alias("campus"), F.col("score")[0]["min_score"].alias("score"), "tree", F.array_join("excluded", ",").alias("excluded"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'mathematics,mathematical_literacy' WHEN 1 THEN 'physical_sciences' WHEN 2 THEN '' ELSE 'english' END AS slugs FROM part""")
def merged_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects of column headers, several where slashes divide them."""
    k = F.col("p_partkey") % 4
    text = F.when(k == 0, "Mathematics* / Mathematics  Literacy").when(k == 1, "physical SCIENCE").when(k == 2, "Campus / other").otherwise("x/English")
    return t.spread(t.table(spark, sf_dir, "part")).select("p_partkey", F.array_join(s.resolve_merged_header(text, F.array(F.lit("*"))), ",").alias("slugs"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'mathematics=4,english=5' WHEN 1 THEN 'history=3' ELSE '' END AS found FROM part""")
def row_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects and levels in neighbouring cells of a row, line by line; unequal numbers of lines say nothing."""
    k = F.col("p_partkey") % 3
    lit = lambda *x: F.array(*[F.lit(c) for c in x])
    row = F.when(k == 0, lit("B2ABC", "Mathematics\nEnglish", "4 (50%)\n5", "4")).when(k == 1, lit("History", "3", "Music", "")).otherwise(lit("History\nMusic", "3", "x"))
    found = cells.row_subject_cells(row, lit("*"), lit("Not accepted"), lit("OR"))
    return t.spread(t.table(spark, sf_dir, "part")).select("p_partkey", F.array_join(F.transform(found, lambda c: F.concat(c["slug"], F.lit("="), c["cell"]["level"].cast("string"))), ",").alias("found"))


# Discovery and ingestion


@query("""SELECT (2023 + c_custkey % 5)::INT AS academic_year, 's' || c_custkey AS source_id, c_name || ' & Co' AS display_name FROM customer WHERE c_custkey % 10 <> 3""")
def heading_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of listings made of headings; excluded ones are left out."""
    k = F.col("c_custkey")
    slug = F.when(k % 10 == 3, "eduvos").otherwise(F.concat(F.lit("s"), k.cast("string")))
    html = F.concat(F.lit('<h2 class="a elementor-heading-title"><a href="https://h/prospectuses/'), slug, F.lit('/">'), "c_name", F.lit(' &amp; Co Prospectus</a></h2><h2 class="elementor-heading-title">none</h2>'))
    listing = t.table(spark, sf_dir, "customer").select(F.lit("headings").alias("source"), (2023 + k % 5).cast("int").alias("academic_year"), html.alias("html"))
    return discovery.heading_listing(listing).select("academic_year", "source_id", "display_name")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://h/' || page_id || '.PDF' END AS viewer, CASE WHEN page_id % 2 = 0 THEN '/u' || page_id || '.pdf' END AS download FROM pages""")
def document_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that detail pages show in a viewer or offer to download."""
    k = F.col("page_id").cast("string")
    ending = F.when(F.col("page_id") % 3 == 0, "PDF").otherwise("doc")
    viewer = F.concat(F.lit('<script>x({content: {location: { url: "https:\\/\\/h\\/'), k, F.lit("."), ending, F.lit('"}}})</script>'))
    title = F.when(F.col("page_id") % 2 == 0, "UJ 2027").otherwise("UJ 2026")
    download = F.concat(F.lit("<title>"), title, F.lit('</title><a href="/no">n</a><a class="b" href="/u'), k, F.lit('.pdf" download="">d</a>'))
    entries = t.table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("detail_url"), F.lit(2027).alias("academic_year"), viewer.alias("viewer"), download.alias("download"))
    shown = discovery.resolve_documents(entries.drop("viewer", "download"), entries.select("detail_url", F.col("viewer").alias("html")), "cards").withColumnRenamed("pdf_url", "viewer")
    return discovery.resolve_documents(shown, entries.select("detail_url", F.col("download").alias("html")), "headings").select("page_id", "viewer", F.col("pdf_url").alias("download"))


@query(f"""WITH {d._ENTRIES} SELECT k, institution_id, institution_id IN ('NATION_2', 'NATION_4') AS own_profile FROM entries WHERE status = 'MAPPED' AND institution_id IN ('NATION_1', 'NATION_2', 'NATION_4')""")
def documents_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped entries of the institutions asked for, with the profile of each or the default."""
    chosen = discovery.to_fetch(d._annotated(spark, sf_dir), ["NATION_1", "NATION_2", "NATION_4"])
    profiles = t.table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("institution_id"), F.lit("own").alias("profile"))
    return discovery.with_profile(chosen, profiles, "default").select("k", "institution_id", (F.col("profile") == "own").alias("own_profile"))


@query("""SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE doc_id % 3 <> 1 AND doc_id % 4 <> 0""")
def contents_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a store lacks or holds with other contents; what isn't a PDF is not stored."""
    k = F.col("doc_id")
    rows = t.table(spark, sf_dir, "documents").select(k.cast("string").alias("key"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"), F.when(k % 4 == 0, F.lit(b"junk")).otherwise(F.lit(b"%PDF-1")).alias("content"), "doc_id")
    stored = rows.where(k % 3 != 2).select("key", F.when(k % 3 == 1, F.col("sha256")).otherwise(F.lit("other")).alias("sha256"))
    return sinks.put_if_new(rows.where(sinks.is_pdf()), stored).select("doc_id", "sha256")


@query("""WITH p AS (SELECT doc_id, text, CASE WHEN doc_id % 10 = 3 THEN NULL ELSE 'nation' || doc_id % 4 END AS inst, doc_id % 10 = 7 AS junk FROM documents WHERE text IS NOT NULL
    ), c AS (SELECT *, CASE WHEN inst IS NULL THEN 'path is not institution/year/file' WHEN junk THEN 'not a PDF' END AS error FROM p
    ) SELECT status, error, count(*) AS n FROM (SELECT 'failed' AS status, error FROM c WHERE error IS NOT NULL UNION ALL
      SELECT CASE WHEN best IN ('nation0', 'nation1') THEN 'pending' ELSE 'needs_profile' END, NULL FROM (SELECT text, min(inst) AS best FROM c WHERE error IS NULL GROUP BY text)) GROUP BY ALL""")
def stream_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of a stream of documents that arrives twice: bad paths and files fail, equal contents count once."""
    folder = scratch_folder(spark)
    source = spark.readStream.schema(t.table(spark, sf_dir, "documents").schema).parquet(f"{sf_dir}/documents.parque[t]").where("text is not null")
    k = F.col("doc_id")
    path = F.when(k % 10 == 3, F.concat(F.lit("/in/odd/"), k.cast("string"))).otherwise(F.concat(F.lit("/in/nation"), (k % 4).cast("string"), F.lit("/2027/"), F.lpad(k.cast("string"), 12, "0"), F.lit(".pdf")))
    content = F.concat(F.when(k % 10 == 7, F.lit(b"junk")).otherwise(F.lit(b"%PDF-")), F.col("text").cast("binary"))
    documents = source.select(path.alias("path"), content.alias("content"))
    institutions = spark.createDataFrame([("nation0", "s"), ("nation1", "s"), ("nation2", "unconfigured")], "id string, scoring_strategy string")
    streams.run_ingestion(documents, institutions, f"{folder}/out", f"{folder}/first").awaitTermination()
    # The same documents under a second checkpoint: failures are told again, contents are not taken twice.
    streams.run_ingestion(documents, institutions, f"{folder}/out", f"{folder}/second").awaitTermination()
    told = spark.read.parquet(f"{folder}/out").select("path", "status", "error")
    return told.where("error is null").unionByName(told.where("error is not null").distinct()).groupBy("status", "error").agg(F.count("*").alias("n"))
