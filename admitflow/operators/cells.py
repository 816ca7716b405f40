"""Requirement trees from interpreted cells, page exclusions from prose, and tables in Markdown or response form."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import vocabulary as v

_TEXTS = "array<string>"


def subject_node(slug: Column, level: Column) -> Column:
    """JSON text of the rule that asks a level of a subject or language."""
    field = F.when(slug.isin(list(v.LANGUAGE_NAMES)), "language").otherwise("subject")
    return F.concat(F.lit('{"kind":"subject","'), field, F.lit('":"'), slug, F.lit('","min_level":'), level.cast("string"), F.lit("}"))


def any_of(nodes: Column) -> Column:
    return F.concat(F.lit('{"kind":"any","rules":['), F.array_join(nodes, ","), F.lit("]}"))


def _split_group(nodes: Column, group: list[str]) -> tuple[Column, Column]:
    """Plain nodes of the group's subjects, and the others."""
    inside = lambda n: F.coalesce(n["slug"].isin([g for g in group if g not in v.LANGUAGE_NAMES]), F.lit(False))
    return F.filter(nodes, inside), F.filter(nodes, lambda n: ~inside(n))


def build_tree(cells: Column, exclusive: list[list[str]] = ()) -> Column:
    """struct(tree, excluded) from ordered cells ``array<struct<slug, cell struct<kind, level, raw>>>``.

    A rejected subject is excluded; a level is a node; an alternative is put together with the node before it, or
    stands alone as the first; empty cells say nothing. Two or more plain nodes of an exclusive group become one
    choice at the front.
    """
    return s.bound(cells, lambda x: _built(x, exclusive))


def _built(cells: Column, exclusive: list[list[str]]) -> Column:
    entry = "array<struct<json:string,slug:string>>"
    one = lambda c, slug: F.array(F.struct(c.alias("json"), slug.alias("slug")))

    def step(acc: Column, c: Column) -> Column:
        node = subject_node(c["slug"], c["cell"]["level"])
        last = F.element_at(acc, -1)
        pair = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), one(any_of(F.array(last["json"], node)), F.lit(None).cast("string")))
        alternative = F.when(F.size(acc) > 0, pair).otherwise(one(node, c["slug"]))
        return F.when(c["cell"]["kind"] == "level", F.concat(acc, one(node, c["slug"]))).when(c["cell"]["kind"] == "alternative", alternative).otherwise(acc)

    safe = F.array().cast(entry)
    nodes = F.aggregate(F.filter(cells, lambda c: c["cell"]["kind"].isin("level", "alternative")), safe, step)

    def written(nodes: Column) -> Column:
        front, rest = F.array().cast(_TEXTS), nodes
        for group in exclusive:
            members, others = _split_group(rest, group)
            several = F.size(members) > 1
            front = F.when(several, F.array_append(front, any_of(members["json"]))).otherwise(front)
            rest = F.when(several, others).otherwise(rest)
        return F.concat(F.lit('{"kind":"all","rules":['), F.array_join(F.concat(front, rest["json"]), ","), F.lit("]}"))

    tree = s.bound(nodes, written)
    out = F.filter(cells, lambda c: c["cell"]["kind"] == "not_accepted")
    return F.struct(tree.alias("tree"), F.array_sort(F.array_distinct(F.transform(out, lambda c: c["slug"]))).alias("excluded"))


def page_exclusions(lines: DataFrame, phrases: list[str], code_pattern: str) -> DataFrame:
    """(doc, page, excluded): subjects that prose rejects, from ``lines(doc, page, text)``.

    Each line is cut into sentences; one that holds a code is skipped; of the others the subjects named before each
    phrase count.
    """
    if not phrases:
        return lines.select("doc", "page").distinct().withColumn("excluded", F.array().cast(_TEXTS))
    pattern = "|".join(r"\s+".join(re.escape(w) for w in p.split()) for p in phrases)
    sentences = lines.select("doc", "page", F.explode(F.split("text", r"\r?\n")).alias("line"))
    sentences = sentences.select("doc", "page", F.explode(F.split(s.strip(F.col("line")), r"(?<=[.!?])\s+")).alias("sentence"))
    sentences = sentences.where((F.col("sentence") != "") & ~F.regexp_like("sentence", F.lit(code_pattern)))
    # What stands before the last phrase also stands before every earlier one's subjects.
    before = F.regexp_extract("sentence", rf"(?isU)^(.*)\b(?:{pattern})\b", 1)
    found = sentences.where(F.regexp_like("sentence", F.lit(rf"(?iU)\b(?:{pattern})\b"))).select("doc", "page", F.explode(s.all_aliases(before)).alias("slug"))
    return found.groupBy("doc", "page").agg(F.sort_array(F.collect_set("slug")).alias("excluded"))


def score_cell(text: Column) -> Column:
    """Thresholds of a score cell, or null.

    One distinct number: an entry per subject named, or one without. Several: an entry each, if every number is
    followed by a subject before the next one.
    """
    entry = lambda score, subject: F.struct(score.cast("int").alias("min_score"), subject.cast("string").alias("requires_subject"))

    def settled(x: Column) -> Column:
        joined, numbers = x["joined"], x["numbers"]
        first = F.try_element_at(numbers, F.lit(1))
        single = s.bound(s.all_aliases(joined), lambda names: F.when(F.size(names) > 0, F.transform(names, lambda a: entry(first, a))).otherwise(F.array(entry(first, F.lit(None)))))
        spans = F.slice(F.split(joined, s.SCORE_CANDIDATE), 2, 1_000_000)
        several = s.bound(spans, lambda after: F.transform(numbers, lambda n, i: entry(n, s.longest_alias(F.try_element_at(after, i + 1)))))
        clean = s.bound(several, lambda each: F.when(F.forall(each, lambda e: e["requires_subject"].isNotNull()), each))
        return F.when(F.size(numbers) == 0, None).when(F.size(F.array_distinct(numbers)) == 1, single).otherwise(clean)

    joined = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    return s.bound(joined, lambda j: s.bound(F.struct(j.alias("joined"), s.score_candidates(j).alias("numbers")), settled))


def row_subject_cells(cells: Column, markers: Column, not_accepted: Column, alternatives: Column) -> Column:
    """Subjects of a row whose subjects are data: pairs of neighbouring cells, a name and a level, line by line.

    Pairs with unequal numbers of lines say nothing. A pair that yields something uses up both its cells.
    """
    none = F.array().cast("array<struct<slug:string,cell:struct<kind:string,level:int,raw:string>>>")
    lines = lambda c: F.split(c, "\n")

    def pair(i: Column) -> Column:
        names, levels = lines(F.element_at(cells, i)), lines(F.element_at(cells, i + 1))
        both = F.transform(F.arrays_zip(names.alias("n"), levels.alias("l")), lambda x: F.struct(s.longest_alias(x["n"]).alias("slug"), s.interpret_cell(x["l"], markers, not_accepted, alternatives).alias("cell")))
        usable = (F.coalesce(F.element_at(cells, i), F.lit("")) != "") & (F.coalesce(F.element_at(cells, i + 1), F.lit("")) != "") & (F.size(names) == F.size(levels))
        return F.when(usable, F.filter(both, lambda x: x["slug"].isNotNull() & (x["cell"]["kind"] != "empty"))).otherwise(none)

    def step(acc: Column, i: Column) -> Column:
        got = pair(i)
        return F.when(acc["skip"] == i, acc).when(F.size(got) > 0, F.struct((i + 1).alias("skip"), F.concat(acc["out"], got).alias("out"))).otherwise(acc)

    start = F.struct(F.lit(0).alias("skip"), none.alias("out"))
    return F.when(F.size(cells) > 1, F.aggregate(F.sequence(F.lit(1), F.size(cells) - 1), start, step, lambda acc: acc["out"])).otherwise(none)


def group_rows(rows: DataFrame, code_pattern: str) -> DataFrame:
    """``rows(doc, page, row, cells)`` with ``programme``: the number of rows with a code so far; none before the first."""
    whole = F.lit(f"^(?:{code_pattern})$")
    code = F.filter("cells", lambda c: F.regexp_like(s.strip(c), whole))
    out = rows.withColumn("code", s.strip(F.try_element_at(code, F.lit(1))))
    order = Window.partitionBy("doc", "page").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("programme", F.count("code").over(order)).where("programme > 0")


def markdown_records(pages: DataFrame, profile: dict) -> DataFrame:
    """Records (doc, page, code, name, campus, score, tree, excluded) of ``pages(doc, page, markdown)``.

    The code column is the one with most cells that are codes, the first on ties; other columns go by their header:
    subject, score, campus or name, the first of each.
    """
    layout = profile["layout"]
    whole = F.lit(f"^(?:{layout['code_pattern']})$")
    markers, rejected, offered = (F.array(*[F.lit(x) for x in layout.get(k, [])]).cast(_TEXTS) for k in ("footnote_markers", "not_accepted_phrases", "alternative_phrases"))
    t = pages.select("doc", "page", s.table_rows(s.remove_detections(F.col("markdown"))).alias("rows")).where(F.size("rows") > 1)
    t = t.select("doc", "page", F.element_at("rows", 1).alias("header"), F.slice("rows", 2, 1_000_000).alias("rows"))
    width = F.array_max(F.transform("rows", lambda r: F.size(r)))
    hits = F.transform(F.sequence(F.lit(1), width), lambda i: F.struct(F.size(F.filter("rows", lambda r: F.coalesce(F.regexp_like(F.try_element_at(r, i), whole), F.lit(False)))).alias("hits"), (-i).alias("i")))
    t = t.withColumn("best", F.array_max(hits)).where("best.hits > 0").withColumn("code_col", -F.col("best.i"))
    low = lambda h: F.lower(s.strip(h))
    has = lambda h, *words: F.lit(False) if not words else F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low(h), w))
    # Headers are resolved once a table, before its rows are taken apart.
    t = t.withColumn("slugs", F.transform("header", lambda h: s.resolve_header(h, markers)))
    role = lambda h, i, slugs: F.when(i + 1 == F.col("code_col"), "code").when(F.element_at(slugs, i + 1).isNotNull(), "subject").when(has(h, "aps", "score"), "aps").when(has(h, "campus"), "campus").when(has(h, "programme", "qualification", "course", "name"), "name").otherwise("ignored")
    t = t.withColumn("roles", s.bound(F.col("slugs"), lambda slugs: F.transform("header", lambda h, i: role(h, i, slugs))))
    t = t.select("*", F.explode("rows").alias("cells")).drop("rows", "best")
    at = lambda name: F.try_element_at("cells", F.nullif(F.array_position("roles", name), F.lit(0)).cast("int"))
    t = t.withColumn("code", F.try_element_at("cells", F.col("code_col"))).where(F.regexp_like("code", whole))
    named = F.filter(F.transform("slugs", lambda x, i: F.struct(x.alias("slug"), F.try_element_at("cells", i + 1).alias("text"), F.element_at("roles", i + 1).alias("role"))), lambda x: x["role"] == "subject")
    subjects = F.transform(named, lambda x: F.struct(x["slug"].alias("slug"), s.interpret_cell(F.coalesce(x["text"], F.lit("")), markers, rejected, offered).alias("cell")))
    built = build_tree(subjects, layout.get("mutually_exclusive_subjects", []))
    tokens = F.array(*[F.lit(x) for x in sorted(layout.get("campus_tokens", []))]).cast(_TEXTS)
    score = F.nullif(F.regexp_extract(at("aps"), r"(?U)\b(\d{2})\b", 1), F.lit("")).cast("int")
    return t.withColumn("built", built).select(
        "doc", "page", "code", at("name").alias("name"), F.coalesce(F.filter(tokens, lambda x: F.contains(at("campus"), x)), F.array().cast(_TEXTS)).alias("campus"), score.alias("score"), F.col("built.tree").alias("tree"), F.col("built.excluded").alias("excluded")
    )


def parse_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, outcomes) of ``responses(doc, page, body)``.

    A response is parsed, empty (no programmes) or abstained (no JSON). A record needs a code of 4 to 8 capital
    letters and digits; prose is dropped, missing arrays become empty.
    """
    parsed = responses.withColumn("v", F.try_parse_json("body"))
    item = "struct<qualification_code:string,name:string,faculty:string,campus:array<string>,selection_notes:array<string>>"
    items = F.from_json(F.get_json_object(F.when(F.col("v").isNotNull(), F.col("body")), "$.programmes"), "array<string>")
    each = parsed.select("doc", "page", F.posexplode(items).alias("position", "item")).where(F.col("item").startswith("{"))
    each = each.select("doc", "page", "position", F.from_json("item", item).alias("r")).select("doc", "page", "position", "r.*")
    none = F.array().cast(_TEXTS)
    records = each.where(F.regexp_like("qualification_code", F.lit(r"^[A-Z0-9]{4,8}$"))).withColumns({"campus": F.coalesce("campus", none), "selection_notes": F.coalesce("selection_notes", none), "career_text": F.lit(None).cast("string"), "source_page": F.col("page")})
    outcome = F.when(F.col("v").isNull(), "abstained").when(F.coalesce(F.size(items), F.lit(0)) > 0, "parsed").otherwise("empty")
    return records, parsed.select("doc", "page", outcome.alias("outcome"))


def response_statistics(outcomes: DataFrame) -> DataFrame:
    """Pages attempted, parsed and abstained per document."""
    return outcomes.groupBy("doc").agg(F.count("*").alias("pages_attempted"), F.count_if(F.col("outcome") != "abstained").alias("pages_parsed"), F.count_if(F.col("outcome") == "abstained").alias("pages_abstained"))


def footnotes(pages: DataFrame, records: DataFrame, markers: list[str], code_pattern: str, lookback: int = 5) -> DataFrame:
    """(doc, page, code, marker, footnote_text) for ``records(doc, page, code)`` over ``pages(doc, page, text)``.

    A record's text runs from its code, forwards or backwards, to the next code; a marker in it takes the first
    legend line on its page, else on the nearest of ``lookback`` pages before; markers without one are dropped.
    """
    both = records.join(pages, ["doc", "page"])
    places = F.filter(F.array(F.instr("text", F.col("code")), F.instr("text", F.reverse("code"))), lambda p: p > 0)
    both = both.withColumn("start", F.array_min(places)).where("start is not null")
    tail = F.substr("text", F.col("start"))
    rest = F.substr(tail, F.lit(2))
    next_code = F.regexp_instr(rest, F.lit(code_pattern))
    window = F.when(next_code > 0, F.substr(tail, F.lit(1), next_code)).otherwise(tail)
    found = both.select("doc", "page", "code", F.explode(s.detect_markers(window, F.array(*[F.lit(m) for m in markers]))).alias("marker"))
    lines = pages.select("doc", F.col("page").alias("legend_page"), F.posexplode(F.split("text", "\n")).alias("line", "text")).withColumn("text", s.strip(F.col("text")))
    legend = r"^(\*{1,3})\s+([A-Za-z].*)$"
    lines = lines.where(F.regexp_like("text", F.lit(legend))).select("doc", "legend_page", "line", F.regexp_extract("text", legend, 1).alias("marker"), s.strip(F.regexp_extract("text", legend, 2)).alias("footnote_text"))
    # Pages in blocks of what a record may look back to: a record meets its own block and the one before.
    span = lookback + 1
    found = found.withColumn("block", F.explode(F.array(F.floor(F.col("page") / span), F.floor(F.col("page") / span) - 1)))
    near = found.join(lines.withColumn("block", F.floor(F.col("legend_page") / span)), ["doc", "marker", "block"]).where(F.col("legend_page").between(F.col("page") - lookback, F.col("page")))
    return near.groupBy("doc", "page", "code", "marker").agg(F.max_by("footnote_text", F.struct("legend_page", -F.col("line"))).alias("footnote_text"))
