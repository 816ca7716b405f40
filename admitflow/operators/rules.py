"""Rule trees: flattened once per distinct tree, then evaluated as one fold over their nodes.

Nodes stand in post-order, so a node's children and the languages that earlier siblings used up are known when the
fold reaches it. Evaluation is a Column: no shuffle, no recursion and no Python at run time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..schemas import FAILURE, NODE

_FIELDS = ["kind", "key", "name", "min_level", "hl", "fal", "min_level_fal", "language", "hl_name", "fal_name", "children", "consumers", "fail_kind", "message", "path"]


def _display(key: str) -> str:
    if key in v.SUBJECT_NAMES:
        return v.SUBJECT_NAMES[key]
    for suffix, label in v.VARIANTS.items():
        if key.endswith(suffix):
            base = key.removesuffix(suffix)
            return f"{v.LANGUAGE_NAMES.get(base, base.title())} {label}"
    return v.LANGUAGE_NAMES.get(key, key.replace("_", " ").title())


def _level(value) -> int | None:
    return int(value) if isinstance(value, int) and 1 <= value <= 7 else None


def _node(kind: str, path: str, **given) -> dict:
    return {f: None for f in _FIELDS} | {"kind": kind, "path": path, "children": [], "consumers": []} | given


def _broken(fail_kind: str, message: str, path: str) -> dict:
    return _node("malformed", path, fail_kind=fail_kind, message=f"Malformed rule: {message}" if not message.startswith("Unknown") else message)


def _leaf(rule, path: str) -> dict:
    """The node of a rule that has no children; malformed rules become nodes that always fail."""
    if not isinstance(rule, dict):
        return _broken("unknown", f"expected an object, got {type(rule).__name__}", path)
    kind = rule.get("kind")
    least = _level(rule.get("min_level"))
    wrong_level = f"invalid min_level {rule.get('min_level')!r}"
    if kind == "any_additional_language":
        return _broken(kind, wrong_level, path) if least is None else _node("additional", path, min_level=least)
    if kind != "subject":
        return _broken(str(kind), f"Unknown rule kind '{kind}'", path)
    if ("subject" in rule) == ("language" in rule):
        return _broken(kind, "set exactly one of subject/language", path)
    if "subject" in rule:
        key = str(rule["subject"])
        return _broken(kind, wrong_level, path) if least is None else _node("subject", path, key=key, name=_display(key), min_level=least)
    language = rule["language"]
    if language not in v.FAMILIES:
        return _broken(kind, f"unknown language family '{language}'", path)
    if least is None:
        return _broken(kind, wrong_level, path)
    hl, fal = v.FAMILIES[language]
    return _node("language", path, key=language, language=language, name=v.LANGUAGE_NAMES[language], min_level=least, min_level_fal=_level(rule.get("min_level_fal", least)) or least, hl=hl, fal=fal, hl_name=_display(hl), fal_name=_display(fal))


def flatten_tree(text: str | None) -> list[dict]:
    """Nodes of one tree in post-order.

    ``consumers`` of an additional-language node are the language nodes that may have used up a family before it,
    nearest first: at each "all" above it, the language rules among the earlier children; "any" adds none.
    """
    nodes: list[dict] = []
    try:
        tree = json.loads(text) if text is not None else None
    except ValueError:
        tree = text
    # Each frame: rule, path, consumers seen from here, whether its children were pushed, positions of children.
    done: dict[int, int] = {}
    stack: list[tuple] = [(0, tree, "$", [], False)]
    serial, kids, local = 1, {0: []}, {}
    parent: dict[int, int] = {}
    while stack:
        me, rule, path, inherited, open_ = stack.pop()
        group = isinstance(rule, dict) and rule.get("kind") in ("all", "any")
        rules = (rule.get("rules") or []) if group else []
        rules = rules if isinstance(rules, list) else []
        if group and rules:
            # Children are visited one at a time, as a later one sees the languages of earlier ones.
            done_so_far = len(kids[me])
            if open_ and rule["kind"] == "all":
                last, at = rules[done_so_far - 1], done[kids[me][-1]]
                if isinstance(last, dict) and last.get("kind") == "subject" and "language" in last and "subject" not in last and nodes[at]["kind"] == "language":
                    local[me] = [at, *local.get(me, [])]
            if done_so_far < len(rules):
                stack.append((me, rule, path, inherited, True))
                child, serial = serial, serial + 1
                kids[me].append(child)
                kids[child], parent[child] = [], me
                seen = [*local.get(me, []), *inherited] if rule["kind"] == "all" else inherited
                stack.append((child, rules[done_so_far], f"{path}.{rule['kind']}[{done_so_far}]", seen, False))
                continue
            nodes.append(_node(rule["kind"], path, children=[done[k] for k in kids[me]]))
        elif group and rule["kind"] == "all":
            nodes.append(_node("all", path))
        elif group:
            nodes.append(_broken("any", "'any' node has no branches", path))
        else:
            nodes.append(_leaf(rule, path))
            nodes[-1]["consumers"] = list(inherited) if nodes[-1]["kind"] == "additional" else []
        done[me] = len(nodes) - 1
    return nodes


def flatten_trees(trees: DataFrame, column: str = "subjects") -> DataFrame:
    """(column, nodes) for each distinct tree text; one small Python step per distinct tree, not per row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({column: frame[column], "nodes": [flatten_tree(t) for t in frame[column]]})

    return trees.select(column).where(F.col(column).isNotNull()).distinct().mapInPandas(run, f"{column} string, nodes array<{NODE}>")


def _failure(kind, message, required, actual, subject) -> Column:
    lit = lambda x, t: (x if isinstance(x, Column) else F.lit(x)).cast(t)
    return F.struct(lit(kind, "string").alias("kind"), lit(message, "string").alias("message"), lit(required, "int").alias("required"), lit(actual, "int").alias("actual"), lit(subject, "string").alias("subject"))


_NONE = f"array<{FAILURE}>"


def evaluate(nodes: Column, marks: Column, levels: Column, excluded: Column, told: bool = True) -> Column:
    """Failures of a flattened tree for a learner: an empty array where the learner passes.

    ``marks`` and ``levels`` map subjects to percentages and levels (null level: not usable); subjects in
    ``excluded`` count as absent. Without ``told`` failures have no messages.
    """
    failure = lambda kind, message, *rest: _failure(kind, message if told else None, *rest)
    none = F.array().cast(_NONE)
    shut = F.coalesce(excluded, F.array().cast("array<string>"))
    level = lambda key: F.when(~F.array_contains(shut, key), F.try_element_at(levels, key))
    fewest = lambda lvl: F.element_at(F.array(*[F.lit(p) for _, p in sorted(v.LEVEL_FROM.items())]), lvl).cast("string")
    text = lambda c: c.cast("string")

    def below(key: Column, name: Column, bar: Column, has: Column, field: Column) -> Column:
        message = F.when(has.isNull(), F.concat(F.lit("Requires "), name, F.lit(" as a matric subject"))).otherwise(
            F.concat(F.lit("Requires "), name, F.lit(" level "), text(bar), F.lit(" ("), fewest(bar), F.lit("%+); you have level "), text(has), F.lit(" ("), text(F.try_element_at(marks, key)), F.lit("%)"))
        )
        return F.array(failure("subject", message, bar, has, field))

    def language(n: Column) -> Column:
        hl, fal = level(n["hl"]), level(n["fal"])
        home = hl.isNotNull() & (fal.isNull() | (n["min_level"] - hl <= n["min_level_fal"] - fal))
        nearest = F.when(home, below(n["hl"], n["hl_name"], n["min_level"], hl, n["language"])).otherwise(below(n["fal"], n["fal_name"], n["min_level_fal"], fal, n["language"]))
        absent = F.array(failure("subject", F.concat(F.lit("Requires "), n["name"], F.lit(" as a matric subject")), n["min_level"], None, n["language"]))
        passed = F.coalesce(hl >= n["min_level"], F.lit(False)) | F.coalesce(fal >= n["min_level_fal"], F.lit(False))
        return F.when(passed, none).when(hl.isNull() & fal.isNull(), absent).otherwise(nearest)

    def additional(n: Column, acc: Column) -> Column:
        used = F.try_element_at(F.filter(n["consumers"], lambda c: F.size(F.element_at(acc, c + 1)) == 0), F.lit(1))
        family = F.when(used.isNotNull(), F.try_element_at(nodes, used + 1)["language"])
        others = F.filter(F.array(*[F.lit(x) for x in v.FAMILIES]), lambda x: family.isNull() | (x != family))
        best = F.array_max(F.transform(others, lambda x: F.greatest(level(F.concat(x, F.lit("_hl"))), level(F.concat(x, F.lit("_fal"))))))
        ending = F.when(best.isNull(), F.lit("you do not offer a second language")).otherwise(F.concat(F.lit("your best additional language is level "), text(best)))
        message = F.concat(F.lit("Requires an additional language at level "), text(n["min_level"]), F.lit(" ("), fewest(n["min_level"]), F.lit("%+); "), ending)
        return F.when(F.coalesce(best >= n["min_level"], F.lit(False)), none).otherwise(F.array(failure("any_additional_language", message, n["min_level"], best, None)))

    def closest(n: Column, acc: Column) -> Column:
        # Fewest failures, the first branch on ties.
        order = F.array_min(F.transform(n["children"], lambda c, i: F.struct(F.size(F.element_at(acc, c + 1)).alias("size"), i.alias("i"))))
        return F.element_at(acc, F.element_at(n["children"], order["i"] + 1) + 1)

    def step(acc: Column, n: Column) -> Column:
        has = level(n["key"])
        out = (
            F.when(n["kind"] == "subject", F.when(F.coalesce(has >= n["min_level"], F.lit(False)), none).otherwise(below(n["key"], n["name"], n["min_level"], has, n["key"])))
            .when(n["kind"] == "language", language(n))
            .when(n["kind"] == "all", F.flatten(F.transform(n["children"], lambda c: F.element_at(acc, c + 1))))
            .when(n["kind"] == "any", closest(n, acc))
            .when(n["kind"] == "additional", additional(n, acc))
            .otherwise(F.array(failure(n["fail_kind"], n["message"], None, None, None)))
        )
        return F.array_append(acc, out)

    return F.aggregate(nodes, F.array().cast(f"array<{_NONE}>"), step, lambda acc: F.element_at(acc, -1))


def usable_levels(levels: Column, excluded: Column) -> tuple[Column, Column]:
    """What ``count_failures`` asks: levels by subject without the excluded ones, and family and level of languages."""
    shut = F.coalesce(excluded, F.array().cast("array<string>"))
    usable = F.when(F.size(shut) == 0, levels).otherwise(F.map_filter(levels, lambda k, _: ~F.array_contains(shut, k)))
    family = F.create_map(*[F.lit(x) for name, keys in v.FAMILIES.items() for key in keys for x in (key, name)])
    spoken = F.transform(F.map_entries(usable), lambda e: F.struct(F.try_element_at(family, e["key"]).alias("family"), e["value"].alias("level")))
    return usable, F.filter(spoken, lambda x: x["family"].isNotNull() & x["level"].isNotNull())


def count_failures(nodes: Column, usable: Column, spoken: Column) -> Column:
    """How many failures ``evaluate`` gives, without making any; the maps come from ``usable_levels``."""
    reaches = lambda key, bar: F.coalesce(F.try_element_at(usable, key) >= bar, F.lit(False))

    def step(acc: Column, n: Column) -> Column:
        before = lambda c: F.element_at(acc, c + 1)
        used = F.try_element_at(F.filter(n["consumers"], lambda c: before(c) == 0), F.lit(1))
        family = F.try_element_at(nodes, used + 1)["language"]
        more = F.exists(spoken, lambda x: (x["level"] >= n["min_level"]) & (family.isNull() | (x["family"] != family)))
        passed = F.when(n["kind"] == "subject", reaches(n["key"], n["min_level"])).when(n["kind"] == "language", reaches(n["hl"], n["min_level"]) | reaches(n["fal"], n["min_level_fal"])).when(n["kind"] == "additional", more).otherwise(F.lit(False))
        group = F.transform(n["children"], before)
        out = F.when(n["kind"] == "all", F.aggregate(group, F.lit(0), lambda total, x: total + x)).when(n["kind"] == "any", F.array_min(group)).otherwise(F.when(passed, 0).otherwise(1))
        return F.array_append(acc, out)

    return F.aggregate(nodes, F.array().cast("array<int>"), step, lambda acc: F.element_at(acc, -1))


#: Fields that tell rules of a kind apart; rules of other kinds differ in any field.
_TELLING = {"subject": ["subject", "language", "min_level", "min_level_fal"], "any_additional_language": ["min_level"]}


def tree_key(text: str | None) -> str | None:
    """A tree as text that is equal for trees that differ only in the order of children."""

    def folded(node: dict) -> dict | str:
        # Called from the leaves up: the children are text already.
        kind = node.get("kind")
        if kind in ("all", "any"):
            return json.dumps([kind, *sorted(c if isinstance(c, str) else json.dumps(c) for c in node.get("rules") or [])])
        return json.dumps([kind, [node.get(f) for f in _TELLING[kind]] if kind in _TELLING else sorted(node.items())])

    key = json.loads(text, object_hook=folded) if text is not None else None
    return key if key is None or isinstance(key, str) else json.dumps(key)


def tree_keys(trees: DataFrame, column: str) -> DataFrame:
    """(column, tree_key) for each distinct tree text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({column: frame[column], "tree_key": [tree_key(t) for t in frame[column]]})

    return trees.select(column).where(F.col(column).isNotNull()).distinct().mapInPandas(run, f"{column} string, tree_key string")
