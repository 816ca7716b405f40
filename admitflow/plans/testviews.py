"""Tables of the domain derived from the driver's tables, for Spark and, as common table expressions, for DuckDB."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUBJECTS = ["english_hl", "afrikaans_fal", "mathematics", "life_orientation", "physical_sciences", "life_sciences", "geography", "accounting", "isizulu_hl", "mathematical_literacy", "technical_mathematics", "history"]
_LAST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

_s = lambda subject, m: {"kind": "subject", "subject": subject, "min_level": m}
_l = lambda language, m, **fal: {"kind": "subject", "language": language, "min_level": m, **fal}
_more = lambda m: {"kind": "any_additional_language", "min_level": m}
_all = lambda *rules: {"kind": "all", "rules": list(rules)}
_any = lambda *rules: {"kind": "any", "rules": list(rules)}
TREES = {
    "ECONOMY": _all(_l("english", 4), _s("mathematics", 4)),
    "LARGE": _all(_l("english", 5, min_level_fal=6), _any(_s("mathematics", 5), _s("mathematical_literacy", 6)), _s("physical_sciences", 4)),
    "MEDIUM": _any(_s("mathematics", 6), _s("technical_mathematics", 5)),
    "PROMO": _all(_l("afrikaans", 4, min_level_fal=5), _more(4)),
    "SMALL": _all(_l("english", 4), _more(5), _any(_all(_s("life_sciences", 4), _s("geography", 4)), _s("history", 6))),
    "STANDARD": _all(_l("isizulu", 3), _any(_l("english", 4), _l("afrikaans", 5)), _s("accounting", 4)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores: a given table is one file, which one task would read and work off."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def raw_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks with repeated subjects; ``ordinal`` orders them."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    subject = F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), (F.col("l_partkey") % 12 + 1).cast("int"))
    return lines.select(F.col("o_custkey").alias("learner_id"), F.struct(*_LAST).alias("ordinal"), subject.alias("subject"), (2 * F.col("l_quantity")).cast("int").alias("percentage"), (F.col("l_partkey") % 12).alias("idx"))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request's marks: the last of each subject, for the subjects that the learner takes."""
    from ..operators.qualify import last_marks

    # A learner's lines are of many orders, so there is little to sum up before they are exchanged.
    kept = last_marks(raw_marks(spark, sf_dir).where((F.col("learner_id") + F.col("idx")) % 4 != 0).repartition("learner_id"))
    return kept.withColumn("ordinal", F.lit(0))


MARKS = f"""
raw_marks AS (
  SELECT o_custkey AS learner_id, {_LAST[2]} % 12 AS idx, ([{", ".join(repr(s) for s in SUBJECTS)}])[(l_partkey % 12 + 1)::INT] AS subject,
    (2 * l_quantity)::INT AS percentage, {", ".join(_LAST)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), last_marks AS (
  SELECT learner_id, idx, subject, percentage FROM raw_marks
  QUALIFY row_number() OVER (PARTITION BY learner_id, subject ORDER BY {", ".join(c + " DESC" for c in _LAST)}) = 1
), taken AS (SELECT * FROM last_marks WHERE (learner_id + idx) % 4 <> 0
), levelled AS (
  SELECT *, CASE WHEN percentage >= 80 THEN 7 WHEN percentage >= 70 THEN 6 WHEN percentage >= 60 THEN 5 WHEN percentage >= 50 THEN 4
    WHEN percentage >= 40 THEN 3 WHEN percentage >= 30 THEN 2 ELSE 1 END AS level FROM taken
), valid AS (SELECT learner_id FROM taken GROUP BY learner_id HAVING count(*) BETWEEN 6 AND 9
), marks AS (SELECT levelled.* FROM levelled SEMI JOIN valid USING (learner_id)
)"""


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"), F.col("n_name").alias("name"), F.lit("aps_best6_excl_lo").alias("scoring_strategy"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each learner asks for the institution of their own nation, in any year, with near misses."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("learner_id"), "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    both = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return both.select("learner_id", F.lit(None).cast("int").alias("academic_year"), F.array("n_name").alias("institutions"), F.lit(True).alias("include_near_misses"))


def programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, nation = spread(table(spark, sf_dir, "part")), table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    tree = F.element_at(F.create_map(*[F.lit(x) for k, t in TREES.items() for x in (k, json.dumps(t))]), F.col("p_type"))
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 5
    none = F.array().cast("array<string>")
    excluded = F.when(brand == 0, F.array(F.lit("technical_mathematics"))).when(brand == 1, F.array(F.lit("mathematical_literacy"))).when(brand == 2, F.array(F.lit("geography"), F.lit("history"))).otherwise(none)
    least = 10 + F.col("p_size") % 39
    entry = lambda score, subject: F.struct(score.cast("int").alias("min_score"), F.lit(subject).cast("string").alias("requires_subject"))
    score = F.when(F.col("p_partkey") % 3 == 0, F.array(entry(least, "mathematics"), entry(least + 2, "mathematical_literacy"))).otherwise(F.array(entry(least, None)))
    return part.join(nation, F.col("n_nationkey") == F.col("p_partkey") % 25).select(
        F.col("n_name").alias("institution_id"),
        (2025 + F.col("p_partkey") % 3).cast("int").alias("academic_year"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("qualification_code"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("faculty"),
        F.array(F.element_at(F.split("p_name", " "), 1)).alias("campus"),
        F.when(F.col("p_partkey") % 5 != 0, (F.col("p_partkey") % 4).cast("double")).alias("duration_years"),
        (F.col("p_partkey") % 11 == 0).alias("extended"),
        score.alias("score"),
        tree.alias("subjects"),
        excluded.alias("excluded_subjects"),
        none.alias("selection_notes"),
        F.lit(None).cast("string").alias("career_text"),
        F.lit("part").alias("source_doc"),
        (F.col("p_partkey") % 50).cast("int").alias("source_page"),
        F.when(F.col("p_partkey") % 6 == 0, "flagged").when(F.col("p_partkey") % 2 == 0, "extracted").otherwise("verified").alias("confidence"),
        F.col("p_partkey").alias("ordinal"),
    )


PROGRAMMES = """
programmes AS (
  SELECT n_name AS institution_id, (2025 + p_partkey % 3)::INT AS academic_year, 'P' || p_partkey AS qualification_code, p_name AS name,
    CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS faculty, split_part(p_name, ' ', 1) AS campus,
    CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey % 4)::DOUBLE END AS duration_years, p_partkey % 11 = 0 AS extended, p_type, p_partkey AS ordinal,
    10 + p_size % 39 AS least, p_partkey % 3 = 0 AS conditional, (p_partkey % 50)::INT AS source_page,
    CASE (substr(p_brand, 7)::INT) % 5 WHEN 0 THEN ['technical_mathematics'] WHEN 1 THEN ['mathematical_literacy'] WHEN 2 THEN ['geography', 'history'] ELSE []::VARCHAR[] END AS excl,
    CASE WHEN p_partkey % 6 = 0 THEN 'flagged' WHEN p_partkey % 2 = 0 THEN 'extracted' ELSE 'verified' END AS confidence
  FROM part JOIN nation ON n_nationkey = p_partkey % 25
)"""


def qualify_sql(candidates: str) -> str:
    """Results by learner and programme; ``candidates`` joins the programmes (as p) that a request asks for."""
    has = lambda s: f"(CASE WHEN list_contains(excl, '{s}') THEN NULL ELSE {s} END)"
    fail = lambda name, bar, level: f"['{name}:{bar}:' || coalesce(({level})::VARCHAR, '-')]"
    none = "[]::VARCHAR[]"
    families = {"english": "english_hl", "afrikaans": "afrikaans_fal", "isizulu": "isizulu_hl"}

    def leaf(rule: dict, used: str | None) -> str:
        if rule["kind"] == "any_additional_language":
            levels = ", ".join(f"CASE WHEN {used or 'false'} AND '{f}' = '{rule['used']}' THEN NULL ELSE {has(s)} END" if rule.get("used") == f else has(s) for f, s in families.items())
            return f"CASE WHEN coalesce(greatest({levels}) >= {rule['min_level']}, false) THEN {none} ELSE {fail('additional', rule['min_level'], f'greatest({levels})')} END"
        if "language" in rule:
            level = has(families[rule["language"]])
            bar = rule.get("min_level_fal", rule["min_level"]) if families[rule["language"]].endswith("_fal") else rule["min_level"]
            return f"CASE WHEN coalesce({level} >= {bar}, false) THEN {none} WHEN {level} IS NULL THEN {fail(rule['language'], rule['min_level'], 'NULL')} ELSE {fail(rule['language'], bar, level)} END"
        return f"CASE WHEN coalesce({has(rule['subject'])} >= {rule['min_level']}, false) THEN {none} ELSE {fail(rule['subject'], rule['min_level'], has(rule['subject']))} END"

    def sql(rule: dict) -> str:
        if rule["kind"] == "all":
            parts, used, family = [], None, None
            for child in rule["rules"]:
                if child["kind"] == "any_additional_language":
                    parts.append(leaf({**child, "used": family}, used))
                else:
                    parts.append(sql(child))
                if "language" in child:
                    family, used = child["language"], f"len({sql(child)}) = 0"
            return " || ".join(f"({p})" for p in parts)
        if rule["kind"] == "any":
            a, b = (sql(r) for r in rule["rules"])
            return f"CASE WHEN len({b}) < len({a}) THEN {b} ELSE {a} END"
        return leaf(rule, None)

    cases = " ".join(f"WHEN '{k}' THEN {sql(t)}" for k, t in TREES.items())
    wide = ", ".join(f"max(CASE WHEN subject = '{s}' THEN level END) AS {s}" for s in SUBJECTS)
    return f"""{MARKS}, {PROGRAMMES}, wide AS (
  SELECT learner_id, {wide},
    list_sum(list_slice(list_reverse(list_sort(list(level) FILTER (WHERE subject <> 'life_orientation'))), 1, 6))::INT AS score_actual
  FROM marks GROUP BY learner_id
), pairs AS (
  SELECT w.*, p.*, CASE WHEN NOT conditional OR mathematics IS NOT NULL THEN least WHEN mathematical_literacy IS NOT NULL THEN least + 2 END::INT AS score_required
  FROM wide w {candidates}
), judged AS (
  SELECT *, (CASE WHEN score_required IS NULL THEN ['score:-:' || score_actual] WHEN score_actual < score_required THEN ['score:' || score_required || ':' || score_actual] ELSE {none} END)
    || (CASE p_type {cases} END) AS failures FROM pairs
), results AS (
  SELECT learner_id, institution_id, academic_year, qualification_code, ordinal, score_required, score_actual, score_actual - score_required AS margin,
    len(failures)::INT AS n_failures, CASE WHEN len(failures) = 0 THEN 'qualified' WHEN len(failures) <= 2 THEN 'near_miss' ELSE 'none' END AS bucket,
    list_aggregate(failures, 'string_agg', '; ') AS missing FROM judged
)"""


QUALIFY = qualify_sql("JOIN customer ON c_custkey = w.learner_id JOIN nation ON n_nationkey = c_nationkey JOIN programmes p ON p.institution_id = n_name")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages: the source is the document, pages are numbered by doc_id; texts are not sorted with them."""
    from pyspark.sql import Window

    d = table(spark, sf_dir, "documents")
    numbers = d.select("doc_id", F.col("source").alias("doc"), F.row_number().over(Window.partitionBy("source").orderBy("doc_id")).alias("page"))
    return spread(d.select("doc_id", "text", "n_chars")).join(numbers, "doc_id").select("doc", "page", "text", "doc_id", "n_chars")


PAGES = """
page_text AS (SELECT source AS doc, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INT AS page, text, doc_id, n_chars FROM documents)"""
