"""Rule trees against a plain evaluator, and the cases that decide their meaning."""

import json
import random

import pytest
from pyspark.sql import functions as F

from admitflow.functions import vocabulary as v
from admitflow.operators import qualify as q
from admitflow.operators.rules import _display, evaluate, flatten_trees, tree_key


def subject(key, level):
    return {"kind": "subject", "subject": key, "min_level": level}


def language(name, level, **more):
    return {"kind": "subject", "language": name, "min_level": level, **more}


def extra(level):
    return {"kind": "any_additional_language", "min_level": level}


def both(*rules):
    return {"kind": "all", "rules": list(rules)}


def either(*rules):
    return {"kind": "any", "rules": list(rules)}


def level_of(pct):
    if pct is None or not 0 <= pct <= 100:
        return None
    return max(n for n, least in v.LEVEL_FROM.items() if pct >= least)


def plain(rule, marks, shut, used=None):
    """(failures as (subject or kind, required, actual), family used): the meaning, written without a fold."""
    level = lambda key: None if key in shut else level_of(marks.get(key))
    if rule["kind"] == "all":
        out = []
        for child in rule["rules"]:
            failed, family = plain(child, marks, shut, used)
            out += failed
            used = family or used
        return out, None
    if rule["kind"] == "any":
        if not rule["rules"]:
            return [("any", None, None)], None
        return min((plain(c, marks, shut, used)[0] for c in rule["rules"]), key=len), None
    if rule["kind"] == "any_additional_language":
        found = [x for f in v.FAMILIES if f != used for x in map(level, v.FAMILIES[f]) if x is not None]
        best = max(found, default=None)
        return ([] if best is not None and best >= rule["min_level"] else [("additional", rule["min_level"], best)]), None
    if "subject" in rule:
        has = level(rule["subject"])
        return ([] if has is not None and has >= rule["min_level"] else [(rule["subject"], rule["min_level"], has)]), None
    name, low = rule["language"], rule["min_level"]
    low_fal = rule.get("min_level_fal", low)
    hl, fal = map(level, v.FAMILIES[name])
    if (hl or 0) >= low or (fal or 0) >= low_fal:
        return [], name
    options = [(low - hl, 0, low, hl)] if hl is not None else []
    options += [(low_fal - fal, 1, low_fal, fal)] if fal is not None else []
    _, _, need, has = min(options, default=(0, 0, low, None))
    return [(name, need, has)], None


def failures(spark, cases):
    """Failures of (tree, marks, excluded) cases, in order."""
    rows = [(k, json.dumps(t), m, x) for k, (t, m, x) in enumerate(cases)]
    df = spark.createDataFrame(rows, "k int, subjects string, marks map<string,int>, excluded array<string>")
    from admitflow.functions.scalars import level

    df = df.join(flatten_trees(df), "subjects").withColumn("levels", F.transform_values("marks", lambda _, p: level(p)))
    got = df.select("k", evaluate(F.col("nodes"), F.col("marks"), F.col("levels"), F.col("excluded")).alias("f")).collect()
    return [r.f for r in sorted(got)]


def short(found):
    return [({"any_additional_language": "additional", "any": "any"}.get(f.kind, f.subject), f.required, f.actual) for f in found]


def random_tree(rng, depth):
    if depth and rng.random() < 0.6:
        return rng.choice([both, either])(*[random_tree(rng, depth - 1) for _ in range(rng.randint(0 if depth < 3 else 1, 4))])
    pick = rng.random()
    if pick < 0.4:
        return language(rng.choice(["english", "afrikaans", "isizulu"]), rng.randint(1, 7), **({"min_level_fal": rng.randint(1, 7)} if rng.random() < 0.3 else {}))
    return extra(rng.randint(1, 7)) if pick < 0.65 else subject(rng.choice(["mathematics", "history", "music"]), rng.randint(1, 7))


def test_random_trees(spark):
    rng = random.Random(11)
    keys = ["mathematics", "history", "music", "english_hl", "english_fal", "afrikaans_hl", "afrikaans_fal", "isizulu_hl"]
    cases = []
    for _ in range(400):
        marks = {k: rng.randint(0, 110) for k in keys if rng.random() < 0.6}
        cases.append((random_tree(rng, 3), marks, rng.sample(keys, rng.randint(0, 2))))
    for found, (tree, marks, shut) in zip(failures(spark, cases), cases):
        assert short(found) == plain(tree, marks, shut)[0], (tree, marks, shut)


def test_messages_and_malformed_rules(spark):
    marks = {"mathematics": 45, "english_hl": 55, "english_fal": 62}
    cases = [
        (subject("mathematics", 5), marks, []),
        (subject("life_sciences", 4), marks, []),
        (language("english", 5, min_level_fal=6), marks, []),
        (language("sesotho", 4), marks, []),
        (extra(6), marks, []),
        (both(language("english", 4), extra(4)), marks, []),
        ({"kind": "nothing"}, marks, []),
        ("text", marks, []),
        ({"kind": "subject", "subject": "a", "language": "english", "min_level": 3}, marks, []),
        ({"kind": "subject", "subject": "mathematics"}, marks, []),
        ({"kind": "subject", "language": "latin", "min_level": 3}, marks, []),
        (either(), marks, []),
        (both(), marks, []),
        (subject("mathematics", 3), marks, ["mathematics"]),
    ]
    got = [[f.message for f in found] for found in failures(spark, cases)]
    assert got == [
        ["Requires Mathematics level 5 (60%+); you have level 3 (45%)"],
        ["Requires Life Sciences as a matric subject"],
        ["Requires English Home Language level 5 (60%+); you have level 4 (55%)"],
        ["Requires Sesotho as a matric subject"],
        ["Requires an additional language at level 6 (70%+); your best additional language is level 5"],
        ["Requires an additional language at level 4 (50%+); you do not offer a second language"],
        ["Unknown rule kind 'nothing'"],
        ["Malformed rule: expected an object, got str"],
        ["Malformed rule: set exactly one of subject/language"],
        ["Malformed rule: invalid min_level None"],
        ["Malformed rule: unknown language family 'latin'"],
        ["Malformed rule: 'any' node has no branches"],
        [],
        ["Requires Mathematics as a matric subject"],
    ]


def test_order_of_children_does_not_change_the_key():
    a, b = subject("mathematics", 3), language("english", 4)
    assert tree_key(json.dumps(both(a, either(a, b)))) == tree_key(json.dumps(both(either(b, a), a)))
    assert tree_key(json.dumps(both(a))) != tree_key(json.dumps(either(a)))


@pytest.mark.parametrize("key, name", [("english_hl", "English Home Language"), ("isizulu_fal", "isiZulu First Additional Language"), ("music", "Music"), ("odd_subject", "Odd Subject"), ("sesotho", "Sesotho")])
def test_display_names(spark, key, name):
    from admitflow.functions.scalars import subject_name

    assert _display(key) == name == spark.range(1).select(subject_name(F.lit(key))).first()[0]


def test_qualification_of_one_learner(spark):
    from admitflow.operators import qualify as q

    tree = json.dumps(both(language("english", 4), subject("mathematics", 4)))
    alternatives = [{"min_score": 25, "requires_subject": "mathematics"}, {"min_score": 26, "requires_subject": "mathematical_literacy"}]
    from admitflow.schemas import PROGRAMMES

    fields = ["institution_id", "academic_year", "qualification_code", "name", "faculty", "campus", "duration_years", "extended", "score", "subjects", "excluded_subjects", "selection_notes", "career_text", "source_doc", "source_page", "confidence", "ordinal"]
    make = lambda i, code, score, excluded=(): ("u", 2027, code, code, None, [], 3.0, False, score, tree, list(excluded), [], None, None, 1, "verified", i)
    rows = [make(1, "OPEN", [{"min_score": 30, "requires_subject": None}]), make(2, "TIGHT", [{"min_score": 41, "requires_subject": None}]), make(3, "EITHER", alternatives), make(4, "SHUT", alternatives, ["mathematics"])]
    programmes = spark.createDataFrame(rows, PROGRAMMES + ", ordinal int").select(fields)
    marks = {"english_hl": 87, "afrikaans_fal": 85, "mathematics": 88, "life_orientation": 88, "geography": 92, "life_sciences": 87, "physical_sciences": 73}
    given = spark.createDataFrame([(1, k, s, p) for k, (s, p) in enumerate(marks.items())], "learner_id long, ordinal int, subject string, percentage int")
    asked = spark.createDataFrame([(1, None, None, True)], "learner_id long, academic_year int, institutions array<string>, include_near_misses boolean")
    institutions = spark.createDataFrame([("u", "U", "aps_best6_excl_lo")], "id string, name string, scoring_strategy string")
    got = {r.qualification_code: r for r in q.qualify(given, asked, programmes, institutions).collect()}
    assert {c: (r.score_actual, r.score_required, r.margin, r.bucket) for c, r in got.items()} == {"OPEN": (41, 30, 11, "qualified"), "TIGHT": (41, 41, 0, "qualified"), "EITHER": (41, 25, 16, "qualified"), "SHUT": (41, 25, 16, "near_miss")}
    ranked = q.rank_qualified(q.qualify(given, asked, programmes, institutions)).orderBy("rank").collect()
    assert [r.qualification_code for r in ranked] == ["EITHER", "OPEN", "TIGHT"]
    none = given.where("subject <> 'mathematics'").unionByName(spark.createDataFrame([(1, 9, "history", 50)], given.schema))
    r = {x.qualification_code: x for x in q.qualify(none, asked, programmes, institutions).collect()}["EITHER"]
    assert r.score_required is None and r.margin is None and r.failures[0].message == "Requires Mathematics or Mathematical Literacy to determine eligibility for this programme"
    with pytest.raises(ValueError, match="nope"):
        q.check_strategies(spark.createDataFrame([("x", "X", "nope")], "id string, name string, scoring_strategy string"))
    bad = spark.createDataFrame([(2, 0, "alchemy", 50), (2, 1, "music", 101)], given.schema)
    assert q.validate_requests(bad)[1].first().reasons == "number of subjects; unknown subject; percentage out of range"


def test_problems_of_trees(spark):
    from admitflow.operators.refdata import tree_errors

    tree = both(subject("alchemy", 3), either(), language("latin", 9, min_level_fal=0), {"kind": "subject", "min_level": 3}, extra(8), {"kind": "x"}, both(subject("music", 3), "text"), subject("music", "4"))
    got = tree_errors(spark.createDataFrame([(json.dumps(tree),), (json.dumps(tree),), (None,)], "subjects string")).collect()
    assert sorted((r.path, r.problem) for r in got) == [
        ("$.all[0]", "unknown subject 'alchemy'"),
        ("$.all[1]", "empty any node"),
        ("$.all[2]", "min_level 9 out of range 1-7"),
        ("$.all[2]", "min_level_fal 0 out of range 1-7"),
        ("$.all[2]", "unknown language family 'latin'"),
        ("$.all[3]", "set exactly one of subject/language"),
        ("$.all[4]", "min_level out of range"),
        ("$.all[5]", "unknown rule kind 'x'"),
        ("$.all[6].all[1]", "not an object"),
        ("$.all[7]", "min_level 4 out of range 1-7"),
    ]


def test_counts_are_those_of_the_failures(spark):
    """Random trees, marks and exclusions: the count without messages is the number of failures."""
    import random

    from admitflow.functions.scalars import level
    from admitflow.operators.rules import count_failures, usable_levels

    rng = random.Random(5)
    keys = ["english_hl", "english_fal", "afrikaans_hl", "afrikaans_fal", "isizulu_hl", "mathematics", "music", "history"]

    def tree(depth):
        kind = rng.choice(["subject", "language", "extra", "odd"] + ["all", "any"] * (2 if depth else 0))
        if kind in ("all", "any"):
            return (both if kind == "all" else either)(*[tree(depth - 1) for _ in range(rng.randint(0, 4))])
        if kind == "subject":
            return subject(rng.choice(keys[5:]), rng.randint(1, 7))
        if kind == "language":
            return language(rng.choice(["english", "afrikaans", "isizulu"]), rng.randint(1, 7), **({"min_level_fal": rng.randint(1, 7)} if rng.random() < 0.5 else {}))
        return extra(rng.randint(1, 7)) if kind == "extra" else {"kind": "riddle"}

    rows = [(json.dumps(tree(3)), {k: rng.randint(0, 100) for k in rng.sample(keys, rng.randint(0, 6))}, rng.sample(keys, rng.randint(0, 2))) for _ in range(150)]
    df = spark.createDataFrame(rows, "subjects string, marks map<string,int>, excluded array<string>")
    df = df.join(flatten_trees(df), "subjects").withColumn("levels", F.transform_values("marks", lambda _, p: level(p)))
    usable, spoken = usable_levels(F.col("levels"), F.col("excluded"))
    got = df.select(F.size(evaluate(F.col("nodes"), F.col("marks"), F.col("levels"), F.col("excluded"))).alias("n"), count_failures(F.col("nodes"), usable, spoken).alias("c")).collect()
    assert len(got) >= 150 and all(r.n == r.c for r in got) and len({r.n for r in got}) > 3


def test_trees_in_sql_have_the_nodes_of_python(spark):
    """Random trees, and everything that can be wrong with one."""
    import json
    import random

    from admitflow.operators.rules import flatten_tree
    from admitflow.operators.trees import flatten_trees_sql

    rng = random.Random(3)
    leaves = [{"kind": "subject", "subject": s, "min_level": m} for s in ("music", "english_hl", "klingon_fal", None, 5) for m in (1, 9, "4", None, True, 4.5, 4.0)]
    leaves += [{"kind": "subject", "language": x, "min_level": 2, "min_level_fal": f} for x in ("english", "isizulu", "latin", None, 7) for f in (4, 9, None)] + [{"kind": "subject", "language": "english", "min_level": 0}]
    leaves += [{"kind": "any_additional_language", "min_level": m} for m in (3, 8)] + [{"kind": "any_additional_language"}, {"kind": "riddle"}, {"x": 1}, "text", 5, None, True, [1], 2.5, {"kind": "subject"}, {"kind": "subject", "subject": "music", "language": "english", "min_level": 3}, {"kind": None}, {"kind": 7}]

    def tree(depth):
        if not depth or rng.random() < 0.3:
            return rng.choice(leaves)
        return {"kind": rng.choice(["all", "any"]), "rules": rng.choice([[tree(depth - 1) for _ in range(rng.randint(1, 4))]] * 8 + [[], None, "x", {"a": 1}])}

    texts = {json.dumps(tree(4)) for _ in range(400)} | {json.dumps(x) for x in leaves} | {"{oops", "", "null", "[]", '{"kind":"all"}', '{"kind":"any"}'}
    rows = spark.createDataFrame([(x,) for x in texts] + [(None,)], "subjects string")
    got = {r.subjects: [n.asDict() for n in r.nodes] for r in flatten_trees_sql(rows).collect()}
    assert got == {x: flatten_tree(x) for x in texts}


def test_scorers_by_percentages(spark):
    from admitflow.operators import qualify as q

    marks = {"english_hl": 60, "mathematics": 75, "physical_sciences": 51, "life_sciences": 52, "history": 90, "music": 41, "geography": 40, "life_orientation": 99, "nbt_mathematics": 33, "nbt_academic_literacy": 66, "nbt_quantitative_literacy": 51}
    row = spark.createDataFrame([(marks,)], "marks map<string,int>").select(*[b(F.col("marks")).alias(n) for n, b in q.SCORERS.items()]).first()
    assert row.percent_best6_science_doubled == 150 + 102 + 90 + 60 + 52 + 41
    assert row.percent_best6_tenth == (90 + 75 + 60 + 52 + 51 + 41) // 10
    # English, mathematics, life sciences, then history and physical sciences.
    assert row.composite_60_40 == int(0.6 * (60 + 75 + 52 + 90 + 51) / 5 + 0.4 * 50)
    assert row.aps_best6_excl_lo == 7 + 6 + 5 + 4 + 4 + 3
    tests = spark.createDataFrame([(1, 0, s, p) for s, p in marks.items()], "learner_id long, ordinal long, subject string, percentage int")
    valid, rejected = q.validate_requests(tests)
    assert valid.count() == len(marks) and rejected.count() == 0


def test_levels_given_as_text_are_no_numbers(spark):
    from admitflow.operators.refdata import node_problems

    levels = {'"4"': False, "4": True, "4.5": True, "8": False, "true": False, "null": False}
    rows = spark.createDataFrame([(f'{{"kind":{space}"subject","subject":"music","min_level":{space}{x}}}', ok) for x, ok in levels.items() for space in ("", " ")], "node string, ok boolean")
    assert all((not r.problems) == r.ok for r in rows.select("ok", node_problems(F.col("node")).alias("problems")).collect())


def test_pairs_are_counted_without_rows(spark):
    """Counts equal those of the rows, for requests with and without a year, institutions, repeats and near misses."""
    from admitflow.plans import testviews as t

    sf = "/root/testdata/sf0.001"
    valid, _ = q.validate_requests(t.marks(spark, sf))
    k = F.col("learner_id")
    year = F.when(k % 3 > 0, 2024 + k % 3).cast("int")
    asked = t.requests(spark, sf).select(
        "learner_id", year.alias("academic_year"), F.when(k % 4 == 0, F.lit(None).cast("array<string>")).when(k % 4 == 1, F.array(F.lit("PERU"), F.lit("nowhere"), F.lit(None).cast("string"), F.lit("PERU"), F.lit(""))).when(k % 4 == 2, F.lit([]).cast("array<string>")).otherwise(F.col("institutions")).alias("institutions"), (k % 5 > 0).alias("include_near_misses")
    )
    offer = q.offer_of(t.programmes(spark, sf), t.institutions(spark, sf)).kept()
    rows, counts = q.qualify_offer(valid, asked, offer), q.count_pairs(valid, asked, offer)
    want = q.summarise(rows).join(rows.groupBy("learner_id").agg(F.countDistinct("institution_id").alias("institutions")), "learner_id")
    assert sorted(map(tuple, q.summarise_counts(counts).collect())) == sorted(map(tuple, want.collect()))
    told = rows.where("bucket = 'near_miss'").select(F.explode("failures").alias("f")).groupBy("f.kind", "f.subject").count()
    assert sorted(map(tuple, q.count_reasons(counts).collect()), key=repr) == sorted(map(tuple, told.collect()), key=repr)
    assert "qualification_code" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_counted_failures_have_no_messages(spark):
    from admitflow.plans.queries import QUERIES

    plan = QUERIES["failure_reasons"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "you have level" not in plan and "n_rule_failures" in plan


def test_programmes_that_share_rules_and_scores_are_judged_once(spark):
    """Judged rows are far fewer than pairs, and list the same rows as qualification, years and other requests included."""
    from admitflow.plans import testviews as t

    sf = "/root/testdata/sf0.001"
    valid, _ = q.validate_requests(t.marks(spark, sf))
    k = F.col("learner_id")
    asked = t.requests(spark, sf).withColumns({"academic_year": F.when(k % 3 > 0, 2024 + k % 3).cast("int"), "institutions": F.when(k % 4 == 0, F.lit(None).cast("array<string>")).otherwise(F.col("institutions"))})
    copies = t.programmes(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5)))).withColumn("qualification_code", F.concat_ws("-", "qualification_code", "copy")).drop("copy")
    offer = q.offer_of(copies, t.institutions(spark, sf)).kept()
    judged = q.judge(valid, asked, offer, ["qualification_code"])
    rows = q.listed(judged)
    assert rows.columns[:3] == ["learner_id", "institution_id", "qualification_code"]
    assert judged.count() * 2 < rows.count()
    of = ["learner_id", "qualification_code", "n_failures", "bucket"]
    pairs = asked.join(valid.select("learner_id").distinct(), "learner_id").crossJoin(copies.select("institution_id", "academic_year", "qualification_code").withColumnRenamed("academic_year", "year"))
    pairs = pairs.where("(academic_year is null or academic_year = year) and (institutions is null or array_contains(institutions, institution_id))")
    assert sorted(map(tuple, rows.select("learner_id", "qualification_code").collect())) == sorted(map(tuple, pairs.select("learner_id", "qualification_code").collect()))
    assert sorted(map(tuple, rows.select(*of).collect())) == sorted(map(tuple, q.qualify_offer(valid, asked, offer).select(*of).collect()))


def test_flattened_nodes_are_joined_by_more_than_one_task(spark):
    from admitflow.plans import rule_queries

    # As for tables too large to be sent to all tasks.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = rule_queries.flattened_nodes(spark, "/root/testdata/sf0.001")
        assert got.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_near_misses_are_ranked_without_an_exchange_of_pairs(spark):
    from admitflow.plans import queries
    from admitflow.plans import testviews as t

    sf = "/root/testdata/sf0.001"
    got = queries.qualify_near_misses(spark, sf)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = q.near_misses(queries._results(spark, sf)).select(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_qualified_in_order_are_those_that_a_window_ranks(spark):
    """Requests with and without a year; the query sorts no pairs."""
    from admitflow.plans import testviews as t
    from admitflow.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    marks, _ = q.validate_requests(t.marks(spark, sf))
    asked = t.requests(spark, sf).withColumn("academic_year", F.when(F.col("learner_id") % 2 == 0, 2026).cast("int"))
    offer = q.offer_of(t.programmes(spark, sf), t.institutions(spark, sf))
    columns = ["learner_id", "qualification_code", "margin", "rank"]
    expected = q.rank_qualified(q.qualify_offer(marks, asked, offer)).select(columns).collect()
    got = q.qualified_in_order(marks, asked, offer).select(columns).collect()
    assert len(got) > 30 and sorted(map(tuple, got)) == sorted(map(tuple, expected))
    assert "Window" not in QUERIES["qualify_ranked"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["failure_reasons", "qualify_results", "failure_messages", "qualify_near_misses", "qualify_ranked"])
def test_marks_are_worked_out_once(spark, name):
    from admitflow.plans import more_queries  # noqa: F401  it registers failure_messages
    from admitflow.plans.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "l_quantity" in line for line in plan.splitlines()) == 1


def test_valid_marks_keep_their_columns_and_repeats(spark):
    rows = [(1, i, "history", 50) for i in range(6)] + [(2, i, "history", 50) for i in range(5)] + [(3, 0, "alchemy", 101)] * 6 + [(None, i, "history", 50) for i in range(6)]
    marks = spark.createDataFrame(rows, "learner_id long, ordinal int, subject string, percentage int")
    valid, rejected = q.validate_requests(marks)
    assert valid.columns == marks.columns and sorted(map(tuple, valid.collect())) == rows[:6]
    assert sorted(map(tuple, rejected.collect())) == [(2, "number of subjects"), (3, "unknown subject; percentage out of range")]


def test_rules_of_a_learner_are_not_put_together_again(spark):
    from admitflow.plans.queries import QUERIES

    plan = QUERIES["qualify_near_misses"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Aggregate [learner_id" in line and "institution_id" in line.split("],")[0] for line in plan.splitlines())


@pytest.mark.parametrize("name", ["qualify_results", "failure_messages", "qualify_ranked"])
def test_tables_that_hold_programmes_are_not_sent_to_all(spark, name):
    from admitflow.plans import more_queries  # noqa: F401  it registers failure_messages
    from admitflow.plans.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert any("SortMergeJoin [institution_id" in line and "dealt" in line for line in plan.splitlines())
