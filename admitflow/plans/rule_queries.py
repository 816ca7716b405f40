"""Registered queries of rule trees taken apart in SQL, of scorers by percentages, and of the ensemble's end product."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..operators import ensemble, trees
from ..operators import qualify as q
from . import more_queries as more
from . import queries as base
from . import testviews as t
from .queries import query

# Rule trees

_ODD = [json.dumps(rule) for rule, _, _ in more._BAD_RULES]
_TREE = """'{"kind": "all", "rules": [{"kind": "subject", "language": "english", "min_level": ' || (p_size % 7 + 1) || '}, {"kind": "any", "rules": [{"kind": "any_additional_language", "min_level": ' || (p_partkey % 9)
  || '}, {"kind": "all", "rules": [{"kind": "subject", "language": "isizulu", "min_level": 3}, ' || odd || ', {"kind": "any_additional_language", "min_level": 4}]}]}, {"kind": "any_additional_language", "min_level": 2}]}'"""


@query(f"""WITH RECURSIVE odd(k, odd) AS (VALUES {", ".join(f"({k}, '{x.replace(chr(39), chr(39) * 2)}')" for k, x in enumerate(_ODD))}
    ), p AS (SELECT p_partkey, {_TREE} AS tree FROM part JOIN odd ON p_partkey % {len(_ODD)} = k
    ), n(p_partkey, path, place, node) AS (
      SELECT p_partkey, '$', []::BIGINT[], tree::JSON FROM p
      UNION ALL SELECT p_partkey, path || '.' || (json_extract_string(node, '$.kind')) || '[' || i || ']', list_append(place, i), json_extract(node, '$.rules[' || i || ']')
      FROM (SELECT *, unnest(range(json_array_length(json_extract(node, '$.rules'))::BIGINT)) AS i FROM n WHERE json_type(node) = 'OBJECT' AND json_extract_string(node, '$.kind') IN ('all', 'any'))
    ), k AS (SELECT p_partkey, path, place, CASE WHEN json_type(node) <> 'OBJECT' THEN 'malformed' WHEN json_extract_string(node, '$.kind') = 'any' AND json_array_length(json_extract(node, '$.rules')) = 0 THEN 'malformed' WHEN json_extract_string(node, '$.kind') IN ('all', 'any') THEN json_extract_string(node, '$.kind')
        WHEN json_extract_string(node, '$.kind') = 'any_additional_language' AND try_cast(json_extract_string(node, '$.min_level') AS INT) BETWEEN 1 AND 7 THEN 'additional' WHEN json_extract_string(node, '$.kind') <> 'subject' OR (json_extract(node, '$.subject') IS NULL) = (json_extract(node, '$.language') IS NULL) THEN 'malformed'
        WHEN json_extract_string(node, '$.language') NOT IN ({", ".join(f"'{x}'" for x in v.FAMILIES)}) OR NOT try_cast(json_extract_string(node, '$.min_level') AS INT) BETWEEN 1 AND 7 THEN 'malformed' WHEN json_extract(node, '$.language') IS NOT NULL THEN 'language' ELSE 'subject' END AS kind FROM n
    ), o AS (SELECT *, (row_number() OVER (PARTITION BY p_partkey ORDER BY list_append(place, 1000)) - 1)::INT AS i FROM k
    ), c AS (SELECT u.p_partkey, u.i, string_agg(x.i, ',' ORDER BY x.i) AS children FROM o u JOIN o x ON x.p_partkey = u.p_partkey AND len(x.place) = len(u.place) + 1 AND x.place[:len(u.place)] = u.place WHERE u.kind IN ('all', 'any') GROUP BY ALL
    ), s AS (SELECT m.p_partkey, m.i, string_agg(x.i, ',' ORDER BY len(a.place) DESC, x.i DESC) AS consumers FROM o m
      JOIN o a ON a.p_partkey = m.p_partkey AND a.kind = 'all' AND len(a.place) < len(m.place) AND m.place[:len(a.place)] = a.place
      JOIN o x ON x.p_partkey = m.p_partkey AND x.kind = 'language' AND len(x.place) = len(a.place) + 1 AND x.place[:len(a.place)] = a.place AND x.place[len(x.place)] < m.place[len(x.place)] WHERE m.kind = 'additional' GROUP BY ALL)
    SELECT p_partkey, i AS place, path, len(place)::INT AS depth, kind, coalesce(children, '') AS children, coalesce(consumers, '') AS consumers FROM o LEFT JOIN c USING (p_partkey, i) LEFT JOIN s USING (p_partkey, i)""")
def flattened_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of rule trees in the order of evaluation, with children and the languages that may be used up before."""
    odd = F.element_at(F.array(*[F.lit(x) for x in _ODD]), (F.col("p_partkey") % len(_ODD) + 1).cast("int"))
    part = t.table(spark, sf_dir, "part").withColumn("odd", odd).select("p_partkey", F.expr(_TREE).alias("subjects"))
    flat = trees.flatten_trees_sql(part).select("subjects", F.posexplode("nodes").alias("place", "n"))
    numbers = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    depth = F.size(F.split("n.path", r"\[")) - 1
    # Dealt out by tree to a set number of tasks, as a join of few bytes would be put in one.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    part = part.repartition(tasks, "subjects")
    return part.join(flat, "subjects").select("p_partkey", "place", "n.path", depth.alias("depth"), "n.kind", numbers(F.col("n.children")).alias("children"), numbers(F.col("n.consumers")).alias("consumers"))


# Scorers by percentages

_TESTED = f"""{t.MARKS}, tests AS (SELECT c_custkey AS learner_id, (c_custkey * 7 % 101)::INT AS a, (c_custkey * 13 % 101)::INT AS b, (c_custkey * 29 % 101)::INT AS c FROM customer WHERE c_custkey % 5 <> 0)"""


def _scored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scores of valid learners, four in five of whom took three tests as well."""
    k = F.col("c_custkey")
    tests = t.table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(k.alias("learner_id"), F.explode(F.array(*[F.struct(F.lit(x).alias("subject"), (k * n % 101).cast("int").alias("percentage")) for x, n in zip(v.TESTS, (7, 13, 29))])).alias("m"))
    marks = t.marks(spark, sf_dir)
    tests = tests.join(marks.select("learner_id").distinct(), "learner_id", "left_semi").select("learner_id", "m.subject", "m.percentage", F.lit(0).alias("ordinal"))
    valid, _ = q.validate_requests(marks.unionByName(tests))
    return q.learner_maps(valid).select("learner_id", q.SCORERS[name](F.col("marks")).alias("score"))


@query(f"""WITH {t.MARKS}, p AS (SELECT learner_id, percentage * CASE WHEN subject IN ('mathematics', 'physical_sciences') THEN 2 ELSE 1 END AS p FROM marks WHERE subject <> 'life_orientation'
    ), n AS (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY p DESC) AS n FROM p) SELECT learner_id, sum(p)::INT AS score FROM n WHERE n <= 6 GROUP BY 1""")
def score_science_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best six percentages with mathematics and physical sciences doubled."""
    return _scored(spark, sf_dir, "percent_best6_science_doubled")


@query(f"""WITH {t.MARKS}, n AS (SELECT learner_id, percentage, row_number() OVER (PARTITION BY learner_id ORDER BY percentage DESC) AS n FROM marks WHERE subject <> 'life_orientation')
    SELECT learner_id, floor(sum(percentage) / 10)::INT AS score FROM n WHERE n <= 6 GROUP BY 1""")
def score_percentage_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the sum of the best six percentages."""
    return _scored(spark, sf_dir, "percent_best6_tenth")


@query(f"""WITH {_TESTED}, w AS (SELECT learner_id, max(percentage) FILTER (WHERE subject = 'english_hl') AS e, max(percentage) FILTER (WHERE subject = 'mathematics') AS m, max(percentage) FILTER (WHERE subject = 'physical_sciences') AS ph, max(percentage) FILTER (WHERE subject = 'life_sciences') AS li FROM marks GROUP BY 1
    ), o AS (SELECT marks.learner_id, percentage, row_number() OVER (PARTITION BY marks.learner_id ORDER BY percentage DESC) AS n FROM marks JOIN w USING (learner_id)
      WHERE subject NOT IN ('life_orientation', 'english_hl', 'mathematics') AND NOT (subject = 'physical_sciences' AND ph >= coalesce(li, -1)) AND NOT (subject = 'life_sciences' AND li > coalesce(ph, -1))
    ), s AS (SELECT learner_id, sum(percentage) AS two FROM o WHERE n <= 2 GROUP BY 1)
    SELECT learner_id, floor(round((coalesce(e, 0) + coalesce(m, 0) + coalesce(greatest(ph, li), 0) + coalesce(two, 0)) / 5 * 0.6::DOUBLE + (coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / 3 * 0.4::DOUBLE, 9))::INT AS score
    FROM w LEFT JOIN s USING (learner_id) LEFT JOIN tests USING (learner_id)""")
def score_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tenths of five subjects' mean and four tenths of three tests' mean; who took no test has 0 there."""
    return _scored(spark, sf_dir, "composite_60_40")


# The ensemble's end product


def _nine_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The methods' records with gaps and errors in all voted fields."""
    n, is_ = F.col("ordinal"), lambda m: F.col("method") == m
    higher = F.transform("score", lambda e: F.struct((e["min_score"] + 1).alias("min_score"), e["requires_subject"].alias("requires_subject")))
    odd = json.dumps({"kind": "subject", "subject": "music", "min_level": 7})
    return base._candidates(spark, sf_dir).withColumns({
        "duration_years": F.when(is_("b") & (n % 21 == 5), F.lit(9.0)).when(~is_("c"), (n % 4).cast("double")),
        "score": F.when(is_("b") & (n % 9 == 4), higher).otherwise(F.col("score")),
        "subjects": F.when(is_("b") & (n % 14 == 3), odd).otherwise(F.col("subjects")),
        "excluded_subjects": F.when(~(is_("a") & (n % 5 == 2)), F.col("excluded_subjects")),
    })


_NINE = f"""WITH {base._CANDIDATES.split("cast_votes AS (")[0].rstrip().rstrip(",")}, full_cand AS (
      SELECT method, code, c.name, c.faculty, c.campus, c.extended, CASE WHEN method = 'b' AND n % 21 = 5 THEN '9' WHEN method <> 'c' THEN (n % 4)::VARCHAR END AS duration_years,
        p.least || p.conditional::VARCHAR || CASE WHEN method = 'b' AND n % 9 = 4 THEN '+' ELSE '' END AS score, CASE WHEN method = 'b' AND n % 14 = 3 THEN 'odd' ELSE p_type END AS subjects,
        CASE WHEN NOT (method = 'a' AND n % 5 = 2) THEN p.excl::VARCHAR END AS excluded_subjects, p.source_page
      FROM cand c JOIN programmes p ON p.qualification_code = code
    ), pages AS (SELECT DISTINCT a.source_page FROM full_cand a JOIN full_cand b ON a.code = b.code AND a.method = 'a' AND b.method = 'b'
      WHERE (a.name IS NOT NULL AND NOT contains(lower(a.name), lower(b.name)) AND NOT contains(lower(b.name), lower(a.name))) OR a.campus <> b.campus OR a.score <> b.score OR a.subjects <> b.subjects OR a.excluded_subjects <> b.excluded_subjects
    ), member AS (SELECT * FROM full_cand WHERE method <> 'c' OR source_page IN (SELECT source_page FROM pages)
    ), cast_votes AS (SELECT code, method, 'qualification_code' AS field, code AS value FROM member {" ".join(f"UNION ALL SELECT code, method, '{f}', {f} FROM member" for f in ensemble.KEYS if f != "qualification_code")}
    ), by_key AS (SELECT code, field, value, count(value) AS n, min(method) AS first FROM cast_votes GROUP BY ALL
    ), agg AS (SELECT code, field, sum(n) AS votes, max(n) AS most, arg_max(value, n * 10 - (ascii(first) - 97)) FILTER (WHERE value IS NOT NULL) AS best FROM by_key GROUP BY ALL
    ), voted AS (SELECT code, field, CASE WHEN votes > 0 AND (votes = 1 OR most > 1) THEN best END AS value,
      CASE WHEN votes = 0 THEN '0.0' WHEN votes = 1 THEN '0.5' WHEN most = votes THEN '1.0' WHEN most > 1 THEN '0.66' ELSE '0.0' END AS confidence FROM agg)"""


@query(f"""{_NINE} SELECT code, string_agg(field || '=' || confidence, ';' ORDER BY field) AS confidence, bool_or(confidence <> '1.0') AS needs_review, count(*) FILTER (WHERE confidence <> '1.0') AS weak_fields,
    max(value) FILTER (WHERE field = 'name') AS name, max(value) FILTER (WHERE field = 'faculty') AS faculty, max(value) FILTER (WHERE field = 'extended') AS extended, (max(value) FILTER (WHERE field = 'duration_years'))::DOUBLE AS duration_years FROM voted GROUP BY code""")
def ensemble_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records reconciled over nine fields from two methods, and from a third on the pages where these conflict."""
    r = ensemble.ensemble_records(_nine_fields(spark, sf_dir))
    value = lambda f: F.element_at("values", f)
    shown = F.array_join(F.transform(F.map_entries("confidence"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return r.select("code", shown.alias("confidence"), "needs_review", F.size("weak_fields").cast("long").alias("weak_fields"), value("name").alias("name"), value("faculty").alias("faculty"), value("extended").alias("extended"), value("duration_years").cast("double").alias("duration_years"))


@query(base._GATE.split("SELECT (SELECT count(*) FROM truth) AS present")[0] + """SELECT field, count(*) AS agreed, count(*) FILTER (WHERE (field = 'name' AND NOT contains(lower(true_name), lower(value)) AND NOT contains(lower(value), lower(true_name))) OR (field = 'campus' AND value <> true_campus)) AS wrong FROM agreed GROUP BY field
    UNION ALL SELECT unnest(['qualification_code', 'score', 'subjects', 'excluded_subjects']), fixed // 4, 0 FROM fixed""")
def wrong_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields on which the methods agree, and how often they are all wrong."""
    truth = t.programmes(spark, sf_dir).where("ordinal % 2 = 0").drop("institution_id", "academic_year")
    return ensemble.wrong_by_field(base._candidates(spark, sf_dir), truth)


@query(f"""WITH {t.PAGES}, k AS (SELECT doc, page FROM page_text SEMI JOIN (SELECT * FROM labels WHERE quality = 0) l ON page_text.doc_id = l.doc_id), p AS (SELECT doc, page FROM page_text WHERE n_chars % 3 = 0
    ), m AS (SELECT doc, page, 'missed' AS what FROM k ANTI JOIN p USING (doc, page) UNION ALL SELECT doc, page, 'extra' FROM p ANTI JOIN k USING (doc, page))
    SELECT doc, coalesce(string_agg(page, ',' ORDER BY page) FILTER (WHERE what = 'missed'), '') AS missed_pages, coalesce(string_agg(page, ',' ORDER BY page) FILTER (WHERE what = 'extra'), '') AS extra_pages FROM m GROUP BY doc""")
def page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the pages that a prediction missed and of those in excess, per document."""
    p = t.pages(spark, sf_dir).select("doc", "page", "doc_id", "n_chars")
    known = p.join(t.table(spark, sf_dir, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_semi").select("doc", "page")
    shown = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return ensemble.page_lists(p.where("n_chars % 3 = 0").select("doc", "page"), known).select("doc", shown("missed_pages"), shown("extra_pages"))
