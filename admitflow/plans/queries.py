"""Registered queries of the engine's own operators, with DuckDB SQL for each that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary
from ..operators import ensemble, pages, refdata
from ..operators import qualify as q
from . import testviews as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with its SQL."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    return q.qualify(valid, t.requests(spark, sf_dir), t.programmes(spark, sf_dir), t.institutions(spark, sf_dir))


def _judged(spark: SparkSession, sf_dir: str, columns: list[str], told: bool = True, **by_rule: Column) -> DataFrame:
    """What ``_results`` lists, by learner, rule and score list, with ``columns`` of the programmes."""
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    return q.judge(valid, t.requests(spark, sf_dir), q.offer_of(t.programmes(spark, sf_dir), t.institutions(spark, sf_dir)), columns, by_rule, told)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    return q.count_pairs(valid, t.requests(spark, sf_dir), q.offer_of(t.programmes(spark, sf_dir), t.institutions(spark, sf_dir)))


def _missing(failures: str = "failures") -> Column:
    """Failures as text: what, required and actual level of each."""
    what = lambda f: F.when(f["kind"] == "any_additional_language", "additional").when(f["kind"] == "score", "score").otherwise(f["subject"])
    number = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    return F.array_join(F.transform(failures, lambda f: F.concat_ws(":", what(f), number(f["required"]), number(f["actual"]))), "; ")


_PAIR = ["learner_id", "institution_id", "academic_year", "qualification_code", "score_required", "score_actual", "margin", "n_failures", "bucket"]


@query(f"WITH {t.QUALIFY} SELECT {', '.join(_PAIR)}, CASE WHEN n_failures > 0 THEN missing END AS missing FROM results WHERE bucket <> 'none'")
def qualify_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualified programmes and near misses of every learner, with what is missing."""
    return _listed(_judged(spark, sf_dir, ["academic_year", "qualification_code"], told=False, **_rule_missing()))


def _rule_missing() -> dict[str, Column]:
    return {"rule_missing": F.nullif(_missing("rule_failures"), F.lit(""))}


def _listed(judged: DataFrame) -> DataFrame:
    """Qualified programmes and near misses of ``judged``, which has ``rule_missing``, with what is missing."""
    judged = judged.where("bucket <> 'none'")
    # The score is the first failure; the others' text is made once per learner and rule.
    low = F.when(F.col("score_required").isNull() | (F.col("margin") < 0), F.concat_ws(":", F.lit("score"), F.coalesce(F.col("score_required").cast("string"), F.lit("-")), F.col("score_actual").cast("string")))
    return q.listed(judged.withColumn("missing", F.nullif(F.concat_ws("; ", low, "rule_missing"), F.lit("")))).select(*_PAIR, "missing")


@query(f"WITH {t.QUALIFY} SELECT learner_id, qualification_code, margin, rank FROM (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY margin DESC, ordinal)::INT AS rank FROM results WHERE bucket = 'qualified')")
def qualify_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualified programmes in the order shown to the learner."""
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    return q.qualified_in_order(valid, t.requests(spark, sf_dir), q.offer_of(t.programmes(spark, sf_dir), t.institutions(spark, sf_dir)))


@query(f"WITH {t.QUALIFY} SELECT learner_id, count(*) AS evaluated_count, count(*) FILTER (WHERE bucket = 'qualified') AS qualified, count(*) FILTER (WHERE bucket = 'near_miss') AS near_misses, max(score_actual) AS score FROM results GROUP BY learner_id")
def qualify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluated, qualified and nearly missed programmes per learner."""
    return q.summarise_counts(_counts(spark, sf_dir)).drop("institutions")


@query(f"WITH {t.QUALIFY} SELECT learner_id, qualification_code, rank FROM (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY ordinal)::INT AS rank FROM results WHERE bucket = 'near_miss')")
def qualify_near_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near misses in the programmes' order."""
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    return q.listed_in_order(valid, t.requests(spark, sf_dir), q.offer_of(t.programmes(spark, sf_dir), t.institutions(spark, sf_dir)), "near_miss").drop("margin")


@query(f"""WITH {t.QUALIFY}, f AS (SELECT learner_id, qualification_code, unnest(failures) AS f FROM judged WHERE len(failures) BETWEEN 1 AND 2)
    SELECT split_part(f, ':', 1) AS what, count(*) AS n FROM f GROUP BY 1""")
def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each requirement keeps a near miss from qualifying."""
    what = F.when(F.col("kind") == "any_additional_language", "additional").when(F.col("kind") == "score", "score").otherwise(F.col("subject"))
    return q.count_reasons(_counts(spark, sf_dir)).groupBy(what.alias("what")).agg(F.sum("n").alias("n"))


@query(f"WITH {t.MARKS} SELECT learner_id, subject, percentage FROM last_marks")
def last_mark_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mark per learner and subject, the last by order."""
    return q.last_marks(t.raw_marks(spark, sf_dir)).select("learner_id", "subject", "percentage")


@query(f"WITH {t.MARKS} SELECT learner_id, 'number of subjects' AS reasons FROM taken GROUP BY learner_id HAVING count(*) NOT BETWEEN 6 AND 9")
def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that fail validation, with the reasons."""
    return q.validate_requests(t.marks(spark, sf_dir))[1]


@query(f"""WITH {t.MARKS}, n AS (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY level DESC) AS n FROM marks WHERE subject <> 'life_orientation')
    SELECT learner_id, sum(level)::INT AS score FROM n WHERE n <= 6 GROUP BY learner_id""")
def score_best_six(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every learner."""
    valid, _ = q.validate_requests(t.marks(spark, sf_dir))
    return q.learner_maps(valid).select("learner_id", q.SCORERS["aps_best6_excl_lo"](F.col("marks")).alias("score"))


@query(f"WITH {t.PROGRAMMES} SELECT institution_id, string_agg(DISTINCT academic_year, ',' ORDER BY academic_year) AS years, count(*) AS programmes FROM programmes GROUP BY 1")
def institution_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years and number of programmes of each institution."""
    return q.metadata(t.programmes(spark, sf_dir)).withColumn("years", F.array_join(F.transform("years", lambda y: y.cast("string")), ","))


# Reference data


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes with faults put in by arithmetic on their number."""
    p, n = t.programmes(spark, sf_dir), F.col("ordinal")
    entry = F.array(F.struct(F.lit(9).alias("min_score"), F.lit("alchemy").alias("requires_subject")))
    return p.withColumns(
        {
            "institution_id": F.when(n % 50 == 7, F.concat("institution_id", F.lit("?"))).otherwise(F.col("institution_id")),
            "qualification_code": F.when(n % 100 == 75, F.concat(F.lit("P"), (n - 75).cast("string"))).otherwise(F.col("qualification_code")),
            "academic_year": F.when(n % 100 == 75, (2025 + (n - 75) % 3).cast("int")).otherwise(F.col("academic_year")),
            "score": F.when(n % 40 == 3, F.array().cast("array<struct<min_score:int,requires_subject:string>>")).when(n % 40 == 4, entry).otherwise(F.col("score")),
            "excluded_subjects": F.when(n % 60 == 5, F.array(F.lit("alchemy"))).otherwise(F.col("excluded_subjects")),
            "subjects": F.when(n % 80 == 6, F.lit('{"kind":"all","rules":[{"kind":"subject","subject":"alchemy","min_level":3},{"kind":"nothing"}]}')).otherwise(F.col("subjects")),
        }
    )


@query(
    f"""WITH {t.PROGRAMMES}, b AS (
      SELECT *, CASE WHEN ordinal % 50 = 7 THEN institution_id || '?' ELSE institution_id END AS inst,
        CASE WHEN ordinal % 100 = 75 THEN 'P' || (ordinal - 75) ELSE qualification_code END AS code,
        CASE WHEN ordinal % 100 = 75 THEN 2025 + (ordinal - 75) % 3 ELSE academic_year END AS year FROM programmes
    ), g AS (SELECT *, inst || '/' || code AS tag FROM b)
    SELECT tag, 'unknown institution' AS error FROM g WHERE ordinal % 50 = 7
    UNION ALL SELECT tag, 'duplicate code for year' FROM (SELECT *, row_number() OVER (PARTITION BY inst, year, code ORDER BY ordinal) AS n FROM g) WHERE n > 1
    UNION ALL SELECT tag, 'empty score thresholds' FROM g WHERE ordinal % 40 = 3
    UNION ALL SELECT tag, unnest(['implausible APS 9', 'unknown requires_subject ''alchemy''']) FROM g WHERE ordinal % 40 = 4
    UNION ALL SELECT tag, 'implausible APS ' || (least + 2) FROM g WHERE conditional AND least + 2 > 48 AND ordinal % 40 NOT IN (3, 4)
    UNION ALL SELECT tag, 'unknown excluded subject ''alchemy''' FROM g WHERE ordinal % 60 = 5
    UNION ALL SELECT tag, unnest([tag || '.all[0]: unknown subject ''alchemy''', tag || '.all[1]: unknown rule kind ''nothing''']) FROM g WHERE ordinal % 80 = 6"""
)
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every problem of a dataset with faults."""
    return refdata.validate(_broken(spark, sf_dir), t.institutions(spark, sf_dir))


@query(f"WITH {t.PROGRAMMES} SELECT institution_id, faculty, qualification_code, academic_year, nullif(duration_years, 0) AS duration_years FROM programmes WHERE academic_year IN (2025, 2027) AND confidence = 'verified'")
def export_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verified programmes of two years as exported."""
    rows = refdata.export_view(refdata.refuse_below(t.programmes(spark, sf_dir), 10), [2025, 2027], verified_only=True)
    return rows.select("institution_id", "faculty", "qualification_code", "academic_year", "duration_years")


@query(f"""WITH {t.PROGRAMMES}, e AS (SELECT * FROM (VALUES ('NATION_0'), ('NATION_3'), ('NATION_99')) v(g)), c AS (
      SELECT institution_id AS g, count(*) FILTER (WHERE confidence = 'verified') AS verified, count(*) FILTER (WHERE confidence = 'extracted') AS extracted, count(*) FILTER (WHERE confidence = 'flagged') AS flagged
      FROM programmes GROUP BY 1)
    SELECT coalesce(e.g, c.g) AS "group", e.g IS NOT NULL AS expected, coalesce(verified, 0) AS verified, coalesce(extracted, 0) AS extracted, coalesce(flagged, 0) AS flagged,
      coalesce(verified, 0) + coalesce(extracted, 0) + coalesce(flagged, 0) AS total FROM e FULL JOIN c ON e.g = c.g""")
def seed_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes per expected group and confidence."""
    expected = spark.createDataFrame([("NATION_0",), ("NATION_3",), ("NATION_99",)], "group string")
    return refdata.seed_statistics(t.programmes(spark, sf_dir).withColumnRenamed("institution_id", "group"), expected)


_PROGRAMME_BATCH = "SELECT institution_id, academic_year, qualification_code, name || ' (new)' AS name FROM programmes WHERE ordinal % 4 = 1"


@query(f"""WITH {t.PROGRAMMES}, batch AS ({_PROGRAMME_BATCH} UNION ALL SELECT institution_id, academic_year + 10, qualification_code, name FROM programmes WHERE ordinal % 9 = 2)
    SELECT institution_id, academic_year, qualification_code, name FROM programmes ANTI JOIN batch USING (institution_id, academic_year, qualification_code) UNION ALL SELECT * FROM batch""")
def upsert_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes after an upsert whose batch holds an older version of some rows."""
    columns = ["institution_id", "academic_year", "qualification_code", "name"]
    p = t.programmes(spark, sf_dir)
    n = F.col("ordinal")
    old = p.where(n % 8 == 1).select(*columns, F.lit(0).alias("version"))
    new = p.where(n % 4 == 1).withColumn("name", F.concat("name", F.lit(" (new)"))).select(*columns, F.lit(1).alias("version"))
    added = p.where(n % 9 == 2).withColumn("academic_year", F.col("academic_year") + 10).select(*columns, F.lit(1).alias("version"))
    return refdata.upsert(p.select(*columns), old.unionByName(new).unionByName(added), columns[:3], order="version")


@query("SELECT n_name AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'aps_best6_excl_lo' ELSE 'unconfigured' END AS scoring_strategy FROM nation")
def insert_stub_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institutions after stubs are put in for those that are missing."""
    nation = t.table(spark, sf_dir, "nation")
    have = nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("id"), F.lit("aps_best6_excl_lo").alias("scoring_strategy"))
    return refdata.insert_missing(have, nation.select(F.col("n_name").alias("id"), F.lit("unconfigured").alias("scoring_strategy")), ["id"])


# Ensemble


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three methods' records of each programme, with gaps and errors by arithmetic on its number."""
    p, n = t.programmes(spark, sf_dir).drop("institution_id", "academic_year"), F.col("ordinal")
    empty = lambda c, when: F.when(~when, F.col(c))
    a = p.where(n % 13 != 0).withColumns({"method": F.lit("a"), "name": F.when(n % 10 == 1, F.concat("name", F.lit(" x"))).otherwise(empty("name", n % 10 == 2)), "duration_years": F.lit(None).cast("double"), "campus": empty("campus", n % 6 == 1)})
    b = p.where(n % 17 != 0).withColumns({"method": F.lit("b"), "name": F.when(n % 15 == 1, F.lit("other")).otherwise(F.col("name")), "faculty": empty("faculty", n % 4 == 1), "extended": F.when(n % 8 == 1, ~F.col("extended")).otherwise(F.col("extended")), "duration_years": F.lit(None).cast("double")})
    c = p.where(n % 3 == 0).withColumns({"method": F.lit("c"), "name": F.when(n % 30 == 21, F.lit("third")).otherwise(F.col("name")), "faculty": F.lit(None).cast("string"), "duration_years": F.lit(None).cast("double")})
    return a.unionByName(b).unionByName(c)


_CANDIDATES = f"""{t.PROGRAMMES}, cand AS (
  SELECT 'a' AS method, qualification_code AS code, ordinal AS n, CASE WHEN ordinal % 10 = 1 THEN name || ' x' WHEN ordinal % 10 <> 2 THEN name END AS name, faculty,
    CASE WHEN ordinal % 6 <> 1 THEN campus END AS campus, extended::VARCHAR AS extended FROM programmes WHERE ordinal % 13 <> 0
  UNION ALL SELECT 'b', qualification_code, ordinal, CASE WHEN ordinal % 15 = 1 THEN 'other' ELSE name END, CASE WHEN ordinal % 4 <> 1 THEN faculty END, campus,
    (CASE WHEN ordinal % 8 = 1 THEN NOT extended ELSE extended END)::VARCHAR FROM programmes WHERE ordinal % 17 <> 0
  UNION ALL SELECT 'c', qualification_code, ordinal, CASE WHEN ordinal % 30 = 21 THEN 'third' ELSE name END, NULL, campus, extended::VARCHAR FROM programmes WHERE ordinal % 3 = 0
), cast_votes AS (
  SELECT code, method, 'name' AS field, name AS value FROM cand UNION ALL SELECT code, method, 'faculty', faculty FROM cand
  UNION ALL SELECT code, method, 'campus', campus FROM cand UNION ALL SELECT code, method, 'extended', extended FROM cand
), by_key AS (SELECT code, field, value, count(value) AS n, min(method) AS first FROM cast_votes GROUP BY ALL
), agg AS (SELECT code, field, sum(n) AS votes, max(n) AS most, arg_max(value, n * 10 - (ascii(first) - 97)) FILTER (WHERE value IS NOT NULL) AS best FROM by_key GROUP BY ALL
), voted AS (
  SELECT code, field, CASE WHEN votes > 0 AND (votes = 1 OR most > 1) THEN best END AS value,
    CASE WHEN votes = 0 THEN 0.0 WHEN votes = 1 THEN 0.5 WHEN most = votes THEN 1.0 WHEN most > 1 THEN 0.66 ELSE 0.0 END::DOUBLE AS confidence,
    votes, most FROM agg
)"""


@query(f"WITH {_CANDIDATES} SELECT code, field, value, confidence FROM voted")
def field_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote of the three methods on four fields."""
    voted = ensemble.vote(ensemble.votes(_candidates(spark, sf_dir)))
    value = F.when(F.col("field") == "campus", F.get_json_object("value", "$[0]")).otherwise(F.col("value"))
    return voted.where("field in ('name', 'faculty', 'campus', 'extended')").select("code", "field", value.alias("value"), "confidence")


@query(f"""WITH {_CANDIDATES} SELECT code, method, value FROM cast_votes c JOIN voted v USING (code, field)
    WHERE field = 'name' AND c.value IS NOT NULL AND votes > 1 AND (most = 1 OR (most < votes AND c.value <> v.value))""".replace("SELECT code, method, value FROM", "SELECT code, method, c.value AS value FROM"))
def vote_minorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that were outvoted or undecided, by method."""
    voted = ensemble.vote(ensemble.votes(_candidates(spark, sf_dir))).where("field = 'name' and minority is not null")
    return voted.select("code", F.explode("minority").alias("method", "value"))


@query(f"""WITH {_CANDIDATES} SELECT DISTINCT p.source_page AS page FROM cand a JOIN cand b ON a.code = b.code AND a.method = 'a' AND b.method = 'b' JOIN programmes p ON p.qualification_code = a.code
    WHERE (a.name IS NOT NULL AND b.name IS NOT NULL AND NOT contains(lower(a.name), lower(b.name)) AND NOT contains(lower(b.name), lower(a.name)))""")
def conflict_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages on which the first two methods contradict each other."""
    c = _candidates(spark, sf_dir)
    return ensemble.conflict_pages(c.where("method = 'a'"), c.where("method = 'b'"))


@query(f"""WITH {_CANDIDATES}, pages AS (SELECT DISTINCT p.source_page FROM cand a JOIN cand b ON a.code = b.code AND a.method = 'a' AND b.method = 'b' JOIN programmes p ON p.qualification_code = a.code
      WHERE a.name IS NOT NULL AND NOT contains(lower(a.name), lower(b.name)) AND NOT contains(lower(b.name), lower(a.name)))
    SELECT method, count(*) AS n FROM cand JOIN programmes p ON p.qualification_code = code WHERE method <> 'c' OR p.source_page IN (SELECT source_page FROM pages) GROUP BY 1""")
def ensemble_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that enter the vote: the third method only on pages in conflict."""
    return ensemble.run_ensemble(_candidates(spark, sf_dir)).groupBy("method").agg(F.count("*").alias("n"))


_GATE = f"""WITH {_CANDIDATES}, truth AS (SELECT qualification_code AS code, name, campus FROM programmes WHERE ordinal % 2 = 0
), found AS (SELECT DISTINCT code FROM cand), agreed AS (SELECT v.*, t.name AS true_name, t.campus AS true_campus FROM voted v JOIN truth t USING (code) WHERE confidence = 1.0 AND field IN ('name', 'campus')
), wrong AS (SELECT count(*) FILTER (WHERE (field = 'name' AND NOT contains(lower(true_name), lower(value)) AND NOT contains(lower(value), lower(true_name))) OR (field = 'campus' AND value <> true_campus)) AS wrong FROM agreed
), others AS (SELECT count(DISTINCT method) AS m, code FROM cand SEMI JOIN truth USING (code) GROUP BY code
), fixed AS (SELECT 4 * count(*) FILTER (WHERE m > 1) AS fixed FROM others)
SELECT (SELECT count(*) FROM truth) AS present, (SELECT count(*) FROM truth SEMI JOIN found USING (code)) AS found, (SELECT count(*) FROM agreed) + fixed AS agreed, wrong FROM wrong, fixed"""


@query(_GATE)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall and agreed errors of the vote against half of the programmes as truth."""
    truth = t.programmes(spark, sf_dir).where("ordinal % 2 = 0")
    return ensemble.gate(_candidates(spark, sf_dir), truth.drop("institution_id", "academic_year")).select("present", "found", "agreed", "wrong")


@query(f"WITH {_CANDIDATES}, u AS (SELECT field FROM voted GROUP BY field HAVING NOT bool_or(confidence > 0 OR votes > 1)) SELECT field FROM u UNION ALL SELECT 'duration_years'")
def unpopulated_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that no method ever filled."""
    return ensemble.unpopulated_fields(ensemble.vote(ensemble.votes(_candidates(spark, sf_dir))))


@query("""WITH known AS (SELECT doc_id FROM labels WHERE quality = 0), predicted AS (SELECT doc_id FROM documents WHERE n_chars % 3 = 0),
    b AS (SELECT k.doc_id AS k, p.doc_id AS p FROM known k FULL JOIN predicted p ON k.doc_id = p.doc_id),
    c AS (SELECT count(*) FILTER (WHERE k IS NOT NULL AND p IS NOT NULL) AS hits, count(*) FILTER (WHERE p IS NULL) AS missed, count(*) FILTER (WHERE k IS NULL) AS extra FROM b)
    SELECT hits, missed, extra, hits / (hits + extra) AS precision, hits / (hits + missed) AS recall, hits / (hits + missed) > 0.95 AS passed FROM c""")
def page_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of a page prediction against known pages."""
    as_page = lambda df: df.select(F.lit("all").alias("doc"), F.col("doc_id").alias("page"))
    return ensemble.page_report(as_page(t.table(spark, sf_dir, "documents").where("n_chars % 3 = 0")), as_page(t.table(spark, sf_dir, "labels").where("quality = 0")))


# Pages

PROFILE = {
    "name": "test",
    "layout": {"code_pattern": r"\b[A-Z][a-z]{5}\b", "header_keywords": ["the", "und", "qui", "haha"], "rotated_headers": False},
    "classification": {**vocabulary.DEFAULT_PROFILE["classification"], "table_evidence_ruled_line_floor": 40},
}


def _primitives(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t.pages(spark, sf_dir)
    return p.select("doc", "page", "text", F.col("n_chars").cast("int").alias("char_count"), F.lit(600.0).alias("width"), F.when(F.col("page") % 50 == 0, 0.0).otherwise(800.0).alias("height"), (F.col("page") % 90).cast("int").alias("line_count"), (F.col("page") % 7 / 10).alias("image_area_ratio"))


_SIGNALS = f"""{t.PAGES}, signals AS (
  SELECT doc, page, CASE WHEN page % 50 = 0 THEN 0.0 ELSE n_chars / 480000.0 END AS text_density,
    len(regexp_extract_all(text, '\\b[A-Z][a-z]{{5}}\\b'))::INT AS code_matches,
    contains(lower(text), 'the')::INT + contains(lower(text), 'und')::INT + contains(lower(text), 'qui')::INT + contains(lower(text), 'haha')::INT AS keyword_hits,
    coalesce(length(regexp_replace(text, '[^\\p{{Nd}}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{{Nd}}\\p{{L}}]', '', 'g')), 0), 0.0) AS numeric_ratio,
    (page % 90)::INT AS ruled_line_count, page % 7 / 10 AS image_coverage,
    contains(lower(text), 'ncv')::INT + contains(lower(text), 'nasca')::INT + contains(lower(text), 'rpl')::INT + contains(lower(text), 'mature age')::INT + contains(lower(text), 'sc(a)')::INT AS alt_hits
  FROM page_text
)"""


_WORDS = "regexp_split_to_array(text, '[^\\p{L}\\p{M}\\p{Nd}_]+')"  # whole words, as word boundaries cut them
_whole = lambda pattern: f"list_filter({_WORDS}, lambda x: regexp_full_match(x, '{pattern}'))"
_hits = lambda phrases: " + ".join(f"contains(lower(text), '{p}')::INT" for p in phrases)
_ALL_SIGNALS = f"""{t.PAGES}, signals AS (
  SELECT doc, page, CASE WHEN page % 50 = 0 THEN 0.0 ELSE n_chars / 480000.0 END::DOUBLE AS text_density, len({_whole("[A-Z][a-z]{5}")})::INT AS code_matches,
    {_hits(["the", "und", "qui", "haha"])} AS keyword_hits,
    coalesce(length(regexp_replace(text, '[^\\p{{Nd}}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{{Nd}}\\p{{L}}]', '', 'g')), 0), 0.0)::DOUBLE AS numeric_ratio,
    (page % 90)::INT AS ruled_line_count, (page % 7 / 10)::DOUBLE AS image_coverage, {_hits(vocabulary.SCORING_PHRASES)} AS scoring_phrase_hits, {_hits(vocabulary.ALTERNATIVE_PHRASES)} AS alt_admission_phrase_hits
  FROM page_text
)"""


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


@query(f"WITH {_ALL_SIGNALS} SELECT * REPLACE (round(text_density, 9) AS text_density, round(numeric_ratio, 9) AS numeric_ratio, round(image_coverage, 9) AS image_coverage) FROM signals")
def page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight signals of every page."""
    return _rounded(pages.signals(_primitives(spark, sf_dir), PROFILE["layout"]), 9)


def _class_sql() -> str:
    c = PROFILE["classification"]
    score = lambda k: " + ".join([f"{n} * {w}::DOUBLE" for n, w in c["weights"][k].items()] + [f"{c['admin_baseline'] if k == 'admin' else 0.0}::DOUBLE"])
    names = vocabulary.PAGE_CLASSES
    best = "greatest(" + ", ".join(f"score_{k}" for k in names) + ")"
    first = " ".join(f"WHEN score_{k} = best THEN '{k}'" for k in names)
    return f"""WITH {_ALL_SIGNALS}, scored AS (SELECT *, {", ".join(f"round({score(k)}, 6) AS score_{k}" for k in names)} FROM signals), top AS (SELECT *, {best} AS best FROM scored)
      SELECT doc, page, {", ".join(f"score_{k}" for k in names)}, CASE WHEN (code_matches >= 1 OR ruled_line_count >= {c["table_evidence_ruled_line_floor"]}) AND best - score_programme_table <= {c["overinclusion_margin"]} THEN 'programme_table' {first} END AS page_class FROM top"""


@query(f"""WITH {_SIGNALS} SELECT doc, page, round(text_density, 9) AS text_density, keyword_hits, round(numeric_ratio, 9) AS numeric_ratio, alt_hits AS alt_admission_phrase_hits, ruled_line_count, round(image_coverage, 9) AS image_coverage FROM signals""")
def page_signal_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals that RE2 counts in the same way."""
    rounded = lambda c: F.round(F.col(c), 9).alias(c)
    return pages.signals(_primitives(spark, sf_dir), PROFILE["layout"]).select("doc", "page", rounded("text_density"), "keyword_hits", rounded("numeric_ratio"), "alt_admission_phrase_hits", "ruled_line_count", rounded("image_coverage"))


@query(_class_sql())
def page_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every page with the score of each class."""
    scored = pages.classify(pages.signals(_primitives(spark, sf_dir), PROFILE["layout"]), PROFILE["classification"])
    return _rounded(scored, 6).drop(*vocabulary.SIGNALS)


@query(f"WITH {t.PAGES} SELECT doc, count(*) AS page_count FROM page_text GROUP BY doc")
def classification_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each classified document."""
    out = pages.classification_result(pages.classify(pages.signals(_primitives(spark, sf_dir), PROFILE["layout"]), PROFILE["classification"]))
    return out.select("doc", "page_count")


def _triage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.pages(spark, sf_dir).withColumn("n_rotated", F.when(F.col("page") % 9 == 0, 3).otherwise(0))


@query(f"""WITH {t.PAGES} SELECT doc, count(*) AS page_count, count(*) FILTER (WHERE page % 9 = 0) AS rotated_pages FROM page_text GROUP BY doc""")
def triage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and rotated pages of each document."""
    return pages.triage(_triage_pages(spark, sf_dir)).select("doc", "page_count", "rotated_pages")


def _triage_sql() -> str:
    shapes = [p.replace("\\b", "") for p in vocabulary.CODE_SHAPES.values()]
    shown = "regexp_split_to_array(line, '[^\\p{L}\\p{M}\\p{Nd}_]+')"
    has = lambda pattern: f"len(list_filter({shown}, lambda x: regexp_full_match(x, '{pattern}'))) > 0"
    named = vocabulary.NAME_AND_NUMBERS.replace("'", "''")
    score = vocabulary.SCORE_NUMBER.replace("\\b", "")
    partial = ", ".join(f"CASE WHEN bool_or(contains(lower(text), '{m}')) THEN '{m}' END" for m in vocabulary.PARTIAL_MARKERS)
    return f"""WITH {t.PAGES}, lines AS (SELECT doc, page, trim(unnest(string_split(text, chr(10)))) AS line FROM page_text
      ), rows AS (SELECT doc, page, count(*) FILTER (WHERE regexp_matches(line, '{named}') OR (({" OR ".join(has(p) for p in shapes)}) AND {has(score)})) AS n FROM lines GROUP BY ALL
      ), facts AS (SELECT p.*, coalesce(r.n, 0) + len(regexp_extract_all(text, '(^|[^\\p{{L}}\\p{{Nd}}_]){vocabulary.LEVEL_CELL[2:]}')) // 4 AS n,
        greatest({", ".join(f"len({_whole(p)})" for p in shapes)}) >= 3 AND ({_hits(vocabulary.HEADER_VOCABULARY)}) > 0 AS is_table FROM page_text p LEFT JOIN rows r USING (doc, page)
      ), d AS (SELECT doc, count(*) AS page_count, count(*) FILTER (WHERE is_table) AS plausible_table_pages, sum(n)::BIGINT AS estimated_programme_rows, count(*) FILTER (WHERE page % 9 = 0) AS rotated_pages,
        concat_ws(',', {partial}) AS self_describes_partial, bool_or(trim(text) <> '') AS has_text FROM facts GROUP BY doc)
      SELECT * EXCLUDE (has_text), CASE WHEN NOT has_text THEN 'UNREADABLE' WHEN estimated_programme_rows >= 50 OR plausible_table_pages >= 10 THEN 'LIKELY_FULL' ELSE 'LIKELY_SUMMARY' END AS verdict FROM d"""


@query(_triage_sql())
def triage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage of every document, most estimated rows first."""
    return pages.triage_report(pages.triage(_triage_pages(spark, sf_dir))).withColumn("self_describes_partial", F.array_join("self_describes_partial", ","))


@query(f"""WITH {t.PAGES}, w AS (SELECT doc, page, unnest(list_distinct(list_filter(regexp_split_to_array(text, '[^\\p{{L}}\\p{{M}}\\p{{Nd}}_]+'), lambda x: regexp_full_match(x, '[A-Z]{{2,20}}')))) AS word FROM page_text),
    c AS (SELECT doc, word, count(*) AS page_count FROM w WHERE word NOT IN ({", ".join(repr(x) for x in vocabulary.CAPITAL_STOPWORDS)}) GROUP BY ALL), n AS (SELECT doc, count(*) AS pages FROM page_text GROUP BY doc)
    SELECT doc, word, page_count, (row_number() OVER (PARTITION BY doc ORDER BY page_count DESC, word))::INT AS rank FROM c JOIN n USING (doc) WHERE page_count >= greatest(2, floor(pages * 0.05)) QUALIFY rank <= 20""")
def recurring_capital_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capital words that recur on a twentieth of a document's pages ."""
    ascii_pages = t.pages(spark, sf_dir)
    return pages.recurring_words(ascii_pages, r"\b[A-Z]{2,20}\b", 2, 0.05, 20)


_SHAPES = " UNION ALL ".join(f"SELECT doc, page, '{k}' AS label, {_whole(p.replace(chr(92) + 'b', ''))} AS found FROM page_text" for k, p in vocabulary.CODE_SHAPES.items())


@query(f"""WITH {t.PAGES}, f AS ({_SHAPES}), t AS (SELECT doc, label, sum(len(found))::BIGINT AS total_matches, count(*) FILTER (WHERE len(found) > 0) AS pages_with_matches FROM f GROUP BY ALL
    ), c AS (SELECT doc, label, code, count(*) AS n FROM (SELECT doc, label, unnest(found) AS code FROM f) GROUP BY ALL
    ), w AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc, label ORDER BY n DESC, code) <= 10
    ), s AS (SELECT doc, label, string_agg(code, ',' ORDER BY n DESC, code) AS samples FROM w GROUP BY ALL) SELECT doc, label, total_matches, pages_with_matches, coalesce(samples, '') AS samples FROM t LEFT JOIN s USING (doc, label)""")
def code_shape_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of each candidate code shape with samples."""
    return pages.code_shape_evidence(t.pages(spark, sf_dir)).withColumn("samples", F.array_join("samples", ","))


@query(f"""WITH {t.PAGES}, r AS (SELECT doc, sum(n_chars)::BIGINT AS total_chars, sum(page % 9 % 2)::BIGINT AS rotated_chars, count(*) FILTER (WHERE page % 9 % 2 > 0) AS rotated_pages, count(*) AS pages FROM page_text GROUP BY doc)
    SELECT *, round(rotated_chars / total_chars, 9) AS ratio, rotated_chars / total_chars > 0.01 AS likely_rotated_headers FROM r""")
def rotation_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of rotated characters of each document."""
    p = t.pages(spark, sf_dir).withColumn("n_rotated", F.col("page") % 9 % 2)
    return pages.rotation_evidence(p).withColumn("ratio", F.round("ratio", 9))


@query(f"""WITH {t.PAGES}, n AS (SELECT doc, count(*) AS total FROM page_text GROUP BY doc), i AS (SELECT unnest(range(12)) AS i)
    SELECT DISTINCT doc, (CASE WHEN total <= 12 THEN i + 1 ELSE floor(i * (total / 12)) + 1 END)::INT AS page FROM n, i WHERE total > 12 OR i < total""")
def sampled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve evenly spaced pages of each document."""
    return pages.sample_pages(t.pages(spark, sf_dir).groupBy("doc").agg(F.count("*").cast("int").alias("total")), 12)


@query(f"""WITH {_CANDIDATES}, others AS (SELECT code, count(DISTINCT method) AS m FROM cand GROUP BY code
    ), sure AS (SELECT code, bool_and(confidence = 1.0) AS all_sure, count(*) FILTER (WHERE confidence < 1.0) AS weak FROM voted GROUP BY code)
    SELECT code, true AS needs_review, (weak + 1 + CASE WHEN m = 1 THEN 4 ELSE 0 END)::INT AS weak_fields FROM sure JOIN others USING (code)""")
def reconciled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records reconciled from three methods: whether they need review, and in how many fields (the duration, which no
    method fills, always; code, score, tree and exclusions where only one method has the record)."""
    merged = ensemble.reconcile(_candidates(spark, sf_dir))
    return merged.select("code", "needs_review", F.size("weak_fields").alias("weak_fields"))
