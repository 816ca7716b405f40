"""Reference data: validation, keyed upserts, statistics and export of programmes and institutions."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as v

GROUPS = ("all", "any")


def _strings(values) -> Column:
    return F.array(*[F.lit(x) for x in values]).cast("array<string>")


def _texts(*checks: tuple[Column, Column | str]) -> Column:
    """The messages of the checks that hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.lit(m) if isinstance(m, str) else m) for when, m in checks]))


def _each(values: Column, wrong: Callable[[Column], Column], message: Callable[[Column], Column]) -> Column:
    """A message for each element that is wrong; none for a null array."""
    found = F.transform(F.filter(values, lambda x: F.coalesce(wrong(x), F.lit(False))), message)
    return F.coalesce(found, F.array().cast("array<string>"))


def validate(programmes: DataFrame, institutions: DataFrame) -> DataFrame:
    """(tag, error) of every problem; the tag is institution/code, ``dataset`` for the whole.

    Expects the columns of ``schemas.PROGRAMMES`` and ``ordinal``. A programme whose score and rules are both null
    has no requirements and is not checked further. All checks of a programme are made in one pass; only those of
    rule trees, once per distinct tree, are joined.
    """
    known = institutions.select(F.col("id").alias("institution_id"), F.lit(True).alias("is_known")).distinct()
    p = programmes.withColumn("tag", F.concat_ws("/", "institution_id", "qualification_code")).join(known, "institution_id", "left")
    p = p.withColumn("place", F.row_number().over(Window.partitionBy("institution_id", "academic_year", "qualification_code").orderBy("ordinal")))
    bare = F.col("score").isNull() & F.col("subjects").isNull()
    about_row = _texts(
        (F.col("is_known").isNull(), "unknown institution"),
        (F.col("place") > 1, "duplicate code for year"),
        (bare, "no nsc requirements"),
        (~bare & (F.col("score").isNull() | (F.size("score") == 0)), "empty score thresholds"),
    )
    about_scores = [
        _each(F.col("score"), lambda e: ~e["min_score"].between(10, 48), lambda e: F.concat(F.lit("implausible APS "), e["min_score"].cast("string"))),
        _each(F.col("score"), lambda e: (e["requires_subject"] != "") & ~e["requires_subject"].isin(v.SUBJECTS), lambda e: F.concat(F.lit("unknown requires_subject '"), e["requires_subject"], F.lit("'"))),
    ]
    about_excluded = F.when(~bare, _each(F.col("excluded_subjects"), lambda x: ~x.isin(v.SUBJECTS), lambda x: F.concat(F.lit("unknown excluded subject '"), x, F.lit("'")))).otherwise(F.array().cast("array<string>"))
    out = p.select("tag", F.explode(F.concat(about_row, *about_scores, about_excluded)).alias("error"))
    trees = p.join(tree_errors(p), "subjects").select("tag", F.concat("tag", F.substr("path", F.lit(2)), F.lit(": "), "problem").alias("error"))
    empty = programmes.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("dataset").alias("tag"), F.lit("no programmes found").alias("error"))
    return out.unionByName(trees).unionByName(empty)


def tree_nodes(text: str) -> list[tuple[str, str]]:
    """(path, JSON) of every node of a rule tree; the root's path is ``$``."""
    nodes = [("$", json.loads(text))]
    for path, node in nodes:  # it grows by the children while it is read
        inside = node.get("rules") if isinstance(node, dict) and node.get("kind") in GROUPS else None
        nodes += [(f"{path}.{node['kind']}[{k}]", child) for k, child in enumerate(inside if isinstance(inside, list) else [])]
    return [(path, json.dumps(node)) for path, node in nodes]


def node_problems(node: Column) -> Column:
    """Messages about one node, given as JSON without regard to its children."""
    keys, at = F.json_object_keys(node), lambda f: F.get_json_object(node, f"$.{f}")
    has = lambda f: F.array_contains(keys, f)
    shown = lambda f: F.coalesce(at(f), F.lit("None"))
    # Text that looks like a number is none.
    given = lambda f: F.try_variant_get(F.try_parse_json(node), f"$.{f}", "variant")
    number = lambda f: F.when(F.schema_of_variant(given(f)).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(given(f), "$", "double"))
    ranged = lambda f: F.coalesce(number(f).between(1, 7), F.lit(False))
    kind = shown("kind")
    group, subject, more = kind.isin(*GROUPS), kind == "subject", kind == "any_additional_language"
    return _texts(
        (keys.isNull(), "not an object"),
        (group & (F.coalesce(F.json_array_length(at("rules")), F.lit(0)) == 0), F.concat(F.lit("empty "), kind, F.lit(" node"))),
        (subject & (has("subject") == has("language")), "set exactly one of subject/language"),
        (subject & has("subject") & ~shown("subject").isin(v.SUBJECTS), F.concat(F.lit("unknown subject '"), shown("subject"), F.lit("'"))),
        (subject & has("language") & ~shown("language").isin(list(v.LANGUAGE_NAMES)), F.concat(F.lit("unknown language family '"), shown("language"), F.lit("'"))),
        *[(subject & has(f) & ~ranged(f), F.concat(F.lit(f"{f} "), shown(f), F.lit(" out of range 1-7"))) for f in ("min_level", "min_level_fal")],
        (more & ~ranged("min_level"), "min_level out of range"),
        (keys.isNotNull() & ~(group | subject | more), F.concat(F.lit("unknown rule kind '"), kind, F.lit("'"))),
    )


def tree_errors(programmes: DataFrame) -> DataFrame:
    """(subjects, path, problem) of each distinct rule tree; Python only takes the distinct trees apart."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(t, *n) for t in frame["subjects"] for n in tree_nodes(t)], columns=["subjects", "path", "node"])

    nodes = programmes.select("subjects").where("subjects is not null").distinct().mapInPandas(run, "subjects string, path string, node string")
    return nodes.select("subjects", "path", F.explode(node_problems(F.col("node"))).alias("problem"))


def with_source_file(errors: DataFrame, programmes: DataFrame) -> DataFrame:
    """Errors with the file that the programme came from (``source_file`` of ``programmes``): the last by path."""
    files = programmes.groupBy(F.concat_ws("/", "institution_id", "qualification_code").alias("tag")).agg(F.max("source_file").alias("source_file"))
    return errors.join(files, "tag", "left")


def structural_errors(
    seeds: DataFrame,
    required: list[str],
    allowed: list[str],
    enums: dict[str, list[str]] | None = None,
    least_items: dict[str, int] | None = None,
    nested: dict[str, tuple[list[str], list[str]]] | None = None,
) -> DataFrame:
    """(row_id, error) for raw ``seeds(row_id, body)``: body is JSON that must be an object with these keys.

    By path below the root: ``enums`` gives the values that are allowed, ``least_items`` how many entries an array
    has at least, ``nested`` the keys required and allowed in an object. A path that is absent is not checked.
    """
    at = lambda path: F.get_json_object("body", f"$.{path}")
    checks = [_keys_of(F.col("body"), required, allowed, "")]
    checks += [_texts((~at(path).isin(values), F.concat(F.lit(f"{path} has unknown value "), at(path)))) for path, values in (enums or {}).items()]
    checks += [_texts((F.coalesce(F.json_array_length(at(path)), F.lit(0)) < n, f"{path} has fewer than {n} items")) for path, n in (least_items or {}).items()]
    checks = checks[:1] + [F.when(at(path).isNotNull(), c).otherwise(F.array().cast("array<string>")) for path, c in zip([*(enums or {}), *(least_items or {})], checks[1:])]
    checks += [F.when(at(path).isNotNull(), _keys_of(at(path), must, may, f" in {path}")).otherwise(F.array().cast("array<string>")) for path, (must, may) in (nested or {}).items()]
    return seeds.select("row_id", F.explode(F.concat(*checks)).alias("error"))


def _keys_of(json_: Column, required: list[str], allowed: list[str], where: str) -> Column:
    """Messages about the keys of a JSON object."""
    keys = F.json_object_keys(json_)
    tell = lambda found, what: F.coalesce(F.transform(found, lambda k: F.concat(F.lit(f"{what} key "), k, F.lit(where))), F.array().cast("array<string>"))
    return F.concat(_texts((keys.isNull(), f"not an object{where}")), tell(F.array_except(_strings(required), keys), "missing"), tell(F.array_except(keys, _strings(allowed)), "unknown"))


#: Keys of a layout profile and its parts, those required and those that may be left out.
PROFILE_KEYS = {
    "profile": (["name", "layout", "classification"], ["source_url", "quirks"]),
    "layout": (["code_pattern", "header_keywords", "rotated_headers"], ["footnote_markers", "campus_tokens", "not_accepted_phrases", "alternative_phrases", "mutually_exclusive_subjects", "rows_per_programme"]),
    "classification": (["weights", "admin_baseline", "overinclusion_margin", "table_evidence_ruled_line_floor"], []),
    "weights": (v.PAGE_CLASSES, []),
}


@F.pandas_udf(T.StringType())
def _pattern_error(patterns: pd.Series) -> pd.Series:
    def error(pattern: str | None) -> str | None:
        try:
            re.compile(pattern or "")
        except re.error as e:
            return str(e)

    return patterns.map(error)


def profile_problems(profiles: DataFrame) -> DataFrame:
    """(institution_id, problem) of ``profiles(institution_id, profile)``, the profile being JSON text.

    The parts of a profile that lacks a part are not looked at.
    """
    paths = {"profile": "$", "layout": "$.layout", "classification": "$.classification", "weights": "$.classification.weights"}
    parts = {k: F.get_json_object("profile", path) for k, path in paths.items()}
    none = F.array().cast("array<string>")

    def keys(part: str) -> Column:
        must, may = PROFILE_KEYS[part]
        return _keys_of(parts[part], list(must), [*must, *may], f" in {part}")

    complete = lambda part: F.size(F.array_except(_strings(PROFILE_KEYS[part][0]), F.coalesce(F.json_object_keys(parts[part]), none))) == 0
    kind = lambda path: F.coalesce(F.expr(f"schema_of_variant(try_variant_get(try_parse_json(profile), '$.{path}', 'variant'))"), F.lit("VOID"))
    at = lambda path: F.get_json_object("profile", f"$.{path}")
    groups = F.from_json(at("layout.mutually_exclusive_subjects"), "array<array<string>>")
    small = F.exists(groups, lambda g: F.coalesce((F.size(g) < 2) | F.exists(g, lambda x: F.coalesce(x == "", F.lit(True))), F.lit(True)))
    number = lambda path: kind(path).startswith("BIGINT") | kind(path).startswith("DECIMAL") | kind(path).startswith("DOUBLE") | kind(path).startswith("FLOAT")
    layout = _texts(
        (F.col("pattern_error").isNotNull(), F.concat(F.lit("code_pattern does not compile: "), "pattern_error")),
        (F.coalesce(F.json_array_length(at("layout.header_keywords")), F.lit(0)) == 0, "header_keywords must be a list that isn't empty"),
        (kind("layout.rotated_headers") != "BOOLEAN", "rotated_headers must be a boolean"),
        (at("layout.mutually_exclusive_subjects").isNotNull() & (groups.isNull() | (F.size(groups) == 0) | small), "mutually_exclusive_subjects must hold groups of two or more subjects"),
        (~at("layout.rows_per_programme").isin("one", "many"), "rows_per_programme must be one or many"),
    )
    weights = F.map_entries(F.from_json(parts["weights"], "map<string,map<string,string>>"))
    signals = F.flatten(F.transform(weights, lambda w: F.transform(F.array_except(F.map_keys(w["value"]), _strings(v.SIGNALS)), lambda x: F.concat(F.lit("weights of "), w["key"], F.lit(" have unknown signal "), x))))
    knobs = _texts(*[(~number(f"classification.{k}"), f"{k} must be numeric") for k in PROFILE_KEYS["classification"][0][1:]])
    only = lambda when, c: F.when(when, F.coalesce(c, none)).otherwise(none)
    inner = [keys("layout"), only(complete("layout"), layout), keys("classification"), only(complete("classification"), F.concat(keys("weights"), F.coalesce(signals, none), knobs))]
    checked = profiles.select("institution_id", "profile").withColumn("pattern_error", _pattern_error(F.get_json_object("profile", "$.layout.code_pattern")))
    return checked.select("institution_id", F.explode(F.concat(keys("profile"), only(complete("profile"), F.concat(*inner)))).alias("problem"))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None, stamp: str | None = None) -> DataFrame:
    """``target`` with the rows of ``batch`` put in by key: new rows win, the last of the batch by ``order`` on repeats.

    ``stamp`` names a column that is set to the current time in the rows put in.
    """
    if order:
        last = Window.partitionBy(*keys).orderBy(F.desc(order))
        batch = batch.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    if stamp:
        batch = batch.withColumn(stamp, F.current_timestamp())
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch.select(*target.columns))


def insert_missing(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` whose key it lacks; rows there stay as they are."""
    return target.unionByName(batch.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def with_defaults(programmes: DataFrame) -> DataFrame:
    """Null arrays become empty, extended false and confidence verified."""
    none = F.array().cast("array<string>")
    arrays = {c: F.coalesce(c, none) for c in ("campus", "selection_notes", "excluded_subjects") if c in programmes.columns}
    return programmes.withColumns({**arrays, "extended": F.coalesce("extended", F.lit(False)), "confidence": F.coalesce("confidence", F.lit("verified"))})


def export_view(programmes: DataFrame, years: list[int], verified_only: bool = False) -> DataFrame:
    """Programmes of the given years as exported, by institution, faculty (null last) and code.

    A duration of 0 is exported as null.
    """
    kept = programmes.where(F.col("academic_year").isin(years))
    kept = kept.where("confidence = 'verified'") if verified_only else kept
    kept = kept.withColumn("duration_years", F.nullif(F.col("duration_years"), F.lit(0.0)).cast("double"))
    return kept.orderBy("institution_id", F.asc_nulls_last("faculty"), "qualification_code")


def refuse_below(df: DataFrame, least: int) -> DataFrame:
    """``df``, or a failure where it has fewer than ``least`` rows."""
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"refusing to export {n} rows; at least {least} are expected")
    return df


def seed_statistics(programmes: DataFrame, expected: DataFrame) -> DataFrame:
    """Programmes per expected ``group`` and confidence, groups without any as 0; groups not expected are flagged."""
    levels = ["verified", "extracted", "flagged"]
    counts = programmes.groupBy("group").pivot("confidence", levels).count()
    both = expected.select("group", F.lit(True).alias("expected")).join(counts, "group", "full_outer")
    filled = both.select("group", F.coalesce("expected", F.lit(False)).alias("expected"), *[F.coalesce(c, F.lit(0)).alias(c) for c in levels])
    return filled.withColumn("total", sum((F.col(c) for c in levels[1:]), F.col(levels[0])))
