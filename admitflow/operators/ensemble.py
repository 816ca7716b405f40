"""Ensemble of extraction methods: per-field vote, record reconciliation and the quality gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import names_equal, score_key, set_key
from .rules import tree_keys

METHODS = ["a", "b", "c"]
#: Text that is equal for values that agree, by voted field; the tree's key comes joined as ``tree_key``.
KEYS: dict[str, Callable[[], Column]] = {
    "qualification_code": lambda: F.col("qualification_code"),
    "name": lambda: F.col("name"),
    "faculty": lambda: F.col("faculty"),
    "campus": lambda: set_key(F.col("campus")),
    "duration_years": lambda: F.col("duration_years").cast("string"),
    "extended": lambda: F.col("extended").cast("string"),
    "score": lambda: score_key(F.col("score")),
    "subjects": lambda: F.col("tree_key"),
    "excluded_subjects": lambda: set_key(F.col("excluded_subjects")),
}
GATED = ["qualification_code", "name", "campus", "score", "subjects", "excluded_subjects"]


def last_per_code(candidates: DataFrame) -> DataFrame:
    """The last record by ordinal of each method and code."""
    last = Window.partitionBy("method", "qualification_code").orderBy(F.desc("ordinal"))
    return candidates.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def votes(candidates: DataFrame) -> DataFrame:
    """(code, method, field, value, key): the values cast; null is no vote. Values are JSON text of the field."""
    keyed = candidates.join(tree_keys(candidates, "subjects"), "subjects", "left") if "subjects" in candidates.columns else candidates.withColumn("tree_key", F.lit(None).cast("string"))
    kinds = dict(keyed.dtypes)
    value = lambda f: F.to_json(F.col(f)) if kinds[f].startswith(("array", "struct", "map")) else F.col(f).cast("string")
    fields = [f for f in KEYS if f in candidates.columns]
    entries = F.array(*[F.struct(F.lit(f).alias("field"), value(f).alias("value"), KEYS[f]().alias("key")) for f in fields])
    return keyed.select(F.col("qualification_code").alias("code"), "method", F.explode(entries).alias("v")).select("code", "method", "v.*")


def vote(cast: DataFrame) -> DataFrame:
    """(code, field, value, confidence, minority, key) from ``votes``; ``key`` is that of the value.

    No vote: null, 0. One: its value, 0.5. All agree: 1. More agree than on any other value: 0.66 and the others as
    minority. Else null and 0, all as minority. The value is that of the first method that agrees.
    """
    by_key = cast.groupBy("code", "field", "key").agg(F.count("value").alias("n"), F.min(F.when(F.col("value").isNotNull(), F.struct("method", "value"))).alias("first"), F.collect_list(F.when(F.col("value").isNotNull(), F.struct("method", "value"))).alias("all"))
    top = by_key.groupBy("code", "field").agg(
        F.sum("n").alias("votes"),
        F.max("n").alias("most"),
        F.min_by(F.struct("key", "first", "n"), F.struct(-F.col("n"), F.col("first.method"))).alias("win"),
        F.flatten(F.collect_list(F.transform("all", lambda x: F.struct(x["method"].alias("method"), x["value"].alias("value"), F.col("key").alias("key"))))).alias("entries"),
    )
    settled = (F.col("votes") == 1) | (F.col("most") > 1)
    confidence = F.when(F.col("votes") == 0, 0.0).when(F.col("votes") == 1, 0.5).when(F.col("most") == F.col("votes"), 1.0).when(F.col("most") > 1, 0.66).otherwise(0.0)
    against = F.filter("entries", lambda e: ~settled | ~e["key"].eqNullSafe(F.col("win.key")))
    minority = F.map_from_entries(F.array_sort(F.transform(against, lambda e: F.struct(e["method"], e["value"]))))
    return top.select("code", "field", F.when(settled & (F.col("votes") > 0), F.col("win.first.value")).alias("value"), confidence.alias("confidence"), F.when((F.col("votes") > 1) & (F.size(against) > 0), minority).alias("minority"), F.when(settled & (F.col("votes") > 0), F.col("win.key")).alias("key"))


def reconcile(candidates: DataFrame) -> DataFrame:
    """One record per code: voted ``values`` by field, ``confidence``, ``disagreements``, notes and footnotes in the
    order of methods without repeats, and needs_review. Prose is never taken over."""
    fields = vote(votes(candidates)).groupBy("code").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("values"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "confidence")))).alias("confidence"),
        F.map_from_entries(F.collect_list(F.when(F.col("minority").isNotNull(), F.struct("field", "minority")))).alias("disagreements"),
        F.bool_or(F.col("confidence") < 1).alias("unsure"),
    )
    ordered = lambda c: F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("method", c)))), lambda x: x[c])))
    listed = [c for c in ("selection_notes", "unresolved_footnotes") if c in candidates.columns]
    for c in listed:
        notes = candidates.groupBy(F.col("qualification_code").alias("code")).agg(ordered(c).alias(c))
        fields = fields.join(notes, "code", "left")
    footnotes = F.coalesce(F.size("unresolved_footnotes") > 0, F.lit(False)) if "unresolved_footnotes" in listed else F.lit(False)
    weak = F.map_filter("confidence", lambda _, x: x < 1)
    return fields.withColumn("career_text", F.lit(None).cast("string")).withColumn("needs_review", footnotes | F.col("unsure")).withColumn("weak_fields", weak).drop("unsure")


def _same(key: str) -> Callable[[str, str], Column]:
    return lambda x, y: F.col(f"{x}.{key}").eqNullSafe(F.col(f"{y}.{key}"))


#: Whether two records agree on a gated field, by the aliases of their tables (with the columns of ``_keyed``).
EQUAL: dict[str, Callable[[str, str], Column]] = {
    "qualification_code": _same("qualification_code"),
    "name": lambda x, y: names_equal(F.col(f"{x}.name"), F.col(f"{y}.name")),
    "campus": _same("campus_key"),
    "score": _same("score_key"),
    "subjects": _same("tree_key"),
    "excluded_subjects": _same("excluded_key"),
}


def _keyed(candidates: DataFrame) -> DataFrame:
    return candidates.join(tree_keys(candidates, "subjects"), "subjects", "left").withColumns({"campus_key": set_key(F.col("campus")), "score_key": score_key(F.col("score")), "excluded_key": set_key(F.col("excluded_subjects"))})


def conflict_pages(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pages of a with a code for which a and b both have a value of some gated field and differ."""
    both = _keyed(a).alias("a").join(_keyed(b).alias("b"), F.col("a.qualification_code") == F.col("b.qualification_code"))
    differ = F.lit(False)
    for f in GATED:
        differ = differ | (F.col(f"a.{f}").isNotNull() & F.col(f"b.{f}").isNotNull() & ~EQUAL[f]("a", "b"))
    return both.where(differ & F.col("a.source_page").isNotNull()).select(F.col("a.source_page").alias("page")).distinct()


def run_ensemble(candidates: DataFrame) -> DataFrame:
    """Records reconciled from a and b everywhere, and from c on the pages where a and b conflict."""
    last = last_per_code(candidates)
    pages = conflict_pages(last.where("method = 'a'"), last.where("method = 'b'"))
    third = last.where("method = 'c'").join(pages.withColumnRenamed("page", "source_page"), "source_page", "left_semi")
    return last.where("method <> 'c'").unionByName(third.select(last.columns))


def ensemble_records(candidates: DataFrame) -> DataFrame:
    """The ensemble's end product: ``reconcile`` of the records that ``run_ensemble`` lets in."""
    return reconcile(run_ensemble(candidates))


def unpopulated_fields(voted: DataFrame) -> DataFrame:
    """Fields for which no record ever got a vote."""
    return voted.groupBy("field").agg(F.bool_or(_tried()).alias("tried")).where("not tried").select("field")


def _tried() -> Column:
    return (F.col("confidence") > 0) | F.col("minority").isNotNull()


def _judged(voted: DataFrame, truth: DataFrame) -> DataFrame:
    """``voted`` in full outer join with the fields of ``truth``: agreed where all votes on a gated field that the truth
    holds agree, same where they also agree with it. A null code meets none."""
    right = votes(truth.withColumn("method", F.lit("t"))).select("code", "field", F.col("value").alias("true_value"), F.col("key").alias("true_key"), F.lit(True).alias("true"))
    both = voted.withColumn("voted", F.lit(True)).join(right, ["code", "field"], "full_outer")
    agreed = F.col("voted") & F.col("true") & F.col("field").isin(GATED) & (F.col("confidence") == 1.0)
    same = F.when(F.col("field") == "name", names_equal(F.col("true_value"), F.col("value"))).otherwise(F.col("key").eqNullSafe(F.col("true_key")))
    return both.withColumns({"agreed": F.coalesce(agreed, F.lit(False)), "same": F.coalesce(same, F.lit(False))})


def wrong_by_field(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(field, agreed, wrong): how often all votes on a gated field agree, and how often they are all wrong."""
    return _judged(vote(votes(candidates)), truth).where("agreed").groupBy("field").agg(F.count("*").alias("agreed"), F.count_if(~F.col("same")).alias("wrong"))


def gate(candidates: DataFrame, truth: DataFrame, least_recall: float = 0.98, most_wrong: float = 0.02) -> DataFrame:
    """One row: recall over ``truth``, share of agreed fields that are wrong, share of records for review, and the
    decision: recall above ``least_recall`` and wrong below ``most_wrong``, both strictly.

    Votes are read once: records are told by code, then counted by the sets of their weak and their tried fields, of
    which there are few, as only all of them together tell which fields count for review.
    """
    named = lambda c: F.sort_array(F.collect_set(F.when(F.col("voted") & c, F.col("field"))))
    by_code = _judged(vote(votes(candidates)), truth).groupBy("code").agg(
        F.bool_or("true").alias("present"), F.bool_or("voted").alias("found"), F.count_if("agreed").alias("agreed"), F.count_if(F.col("agreed") & ~F.col("same")).alias("wrong"),
        named(F.col("confidence") < 1).alias("weak"), named(_tried()).alias("tried"),
    )
    coded = F.col("code").isNotNull()
    kinds = by_code.withColumn("weak", F.when(coded, F.col("weak")).otherwise(F.array().cast("array<string>"))).groupBy("weak", "tried").agg(
        F.count_if("present").alias("present"), F.count_if(F.col("present") & F.col("found") & coded).alias("found"), F.sum("agreed").alias("agreed"), F.sum("wrong").alias("wrong"), F.count_if("found").alias("records")
    )
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("present", "found", "agreed", "wrong", "records")]
    one = kinds.agg(*sums, F.flatten(F.collect_set("tried")).alias("tried"), F.collect_list(F.struct("weak", "records")).alias("kinds"))
    review = F.aggregate("kinds", F.lit(0).cast("bigint"), lambda n, k: n + F.when(F.arrays_overlap(k["weak"], F.col("tried")), k["records"]).otherwise(0))
    ratio = lambda x, y: F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(y)), F.lit(0.0))
    one = one.select("present", "found", "agreed", "wrong", "records", review.alias("for_review"))
    one = one.withColumns({"recall": ratio("found", "present"), "false_agreement": ratio("wrong", "agreed"), "queue_fraction": ratio("for_review", "records")})
    return one.withColumn("passed", (F.col("recall") > least_recall) & (F.col("false_agreement") < most_wrong))


def page_report(predicted: DataFrame, known: DataFrame, least_recall: float = 0.95) -> DataFrame:
    """One row over pages (doc, page): precision, recall, counts of pages missed and pages in excess, and the gate."""
    both = known.select("doc", "page", F.lit(1).alias("k")).join(predicted.select("doc", "page", F.lit(1).alias("p")), ["doc", "page"], "full_outer")
    counts = both.agg(F.count_if(F.expr("k = 1 and p = 1")).alias("hits"), F.count_if(F.expr("k = 1 and p is null")).alias("missed"), F.count_if(F.expr("p = 1 and k is null")).alias("extra"))
    ratio = lambda y: F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("hits") + F.col(y)), F.lit(0.0))
    return counts.withColumns({"precision": ratio("extra"), "recall": ratio("missed")}).withColumn("passed", F.col("recall") > least_recall)


def page_differences(predicted: DataFrame, known: DataFrame) -> DataFrame:
    """(doc, page, what) of the known pages that were missed and of the pages that were predicted in excess."""
    missed = known.select("doc", "page").join(predicted, ["doc", "page"], "left_anti").select("doc", "page", F.lit("missed").alias("what"))
    extra = predicted.select("doc", "page").join(known, ["doc", "page"], "left_anti").select("doc", "page", F.lit("extra").alias("what"))
    return missed.distinct().unionByName(extra.distinct())


def page_lists(predicted: DataFrame, known: DataFrame) -> DataFrame:
    """(doc, missed_pages, extra_pages): the numbers of ``page_differences`` per document, in order."""
    pages = lambda what: F.sort_array(F.collect_list(F.when(F.col("what") == what, F.col("page"))))
    return page_differences(predicted, known).groupBy("doc").agg(pages("missed").alias("missed_pages"), pages("extra").alias("extra_pages"))
