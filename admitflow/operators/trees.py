"""Rule trees taken apart in the engine: recursive SQL gives the nodes, arrays put them in post-order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..functions.scalars import subject_name
from ..schemas import NODE

_FIELDS = [f.split(":")[0] for f in NODE.removeprefix("struct<").removesuffix(">").replace("array<int>", "array").split(",")]

#: ``at`` has the positions of the children on the way to a node; the root's is empty. A text that is no JSON is a
#: string. Levels are as many as the deepest tree has; the parameter's limit stops trees that are nested absurdly.
_NODES = """
WITH RECURSIVE nodes(tree, path, at, node) MAX RECURSION LEVEL 1000 AS (
  SELECT tree, '$', cast(array() AS array<int>), coalesce(try_parse_json(tree), cast(tree AS variant)) FROM {trees}
  UNION ALL
  SELECT n.tree, concat(n.path, '.', try_variant_get(n.node, '$.kind', 'string'), '[', c.pos, ']'), array_append(n.at, c.pos), c.value
  FROM nodes n, LATERAL variant_explode(try_variant_get(n.node, '$.rules', 'variant')) c
  WHERE try_variant_get(n.node, '$.kind', 'string') IN ('all', 'any') AND startswith(schema_of_variant(try_variant_get(n.node, '$.rules', 'variant')), 'ARRAY')
)
SELECT tree, path, at, size(at) AS depth, node FROM nodes"""


def tree_rows(trees: DataFrame, column: str = "subjects") -> DataFrame:
    """(tree, path, at, depth, node) of every node of each distinct tree in ``column``; node is a variant.

    The recursion is one step per level for all trees together. Its number of rows is bound by the session's
    spark.sql.cteRecursionRowLimit: beyond that it fails, and drops nothing.
    """
    spark = trees.sparkSession
    distinct = trees.select(F.col(column).alias("tree")).where("tree is not null").distinct()
    return spark.sql(_NODES, trees=distinct)


def _kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def _shown(value: Column, quoted: bool = False) -> Column:
    """A value as messages show it: None for null or none, texts in quotes where asked."""
    text = F.try_variant_get(value, "$", "string")
    kind = _kind_of(value)
    text = F.when(kind.startswith("DECIMAL") & ~F.contains(text, F.lit(".")), F.concat(text, F.lit(".0"))).otherwise(text)
    return F.when(value.isNull() | (kind == "VOID"), "None").when(kind == "BOOLEAN", F.initcap(text)).when((kind == "STRING") & F.lit(quoted), F.concat(F.lit("'"), text, F.lit("'"))).otherwise(F.coalesce(text, F.to_json(value)))


def _level(value: Column) -> Column:
    """A level from 1 to 7 given as a whole number, else null; true counts as 1."""
    number = F.when(_kind_of(value) == "BIGINT", F.try_variant_get(value, "$", "long")).when((_kind_of(value) == "BOOLEAN") & F.try_variant_get(value, "$", "boolean"), F.lit(1).cast("long"))
    return F.when(number.between(1, 7), number.cast("int"))


def _typed(rows: DataFrame) -> DataFrame:
    """``tree_rows`` with the fields of a flattened node, but for children and consumers."""
    at = lambda k: F.try_variant_get("node", f"$.{k}", "variant")
    for k in ("kind", "subject", "language", "min_level", "min_level_fal", "rules"):
        rows = rows.withColumn(f"v_{k}", at(k))
    kind = F.try_variant_get("v_kind", "$", "string")
    rows = rows.withColumns({"is_object": _kind_of(F.col("node")).startswith("OBJECT"), "rule": F.coalesce(kind, F.lit("")), "least": _level(F.col("v_min_level"))})
    rows = rows.withColumns({"group": F.col("is_object") & F.col("rule").isin("all", "any"), "branches": F.coalesce(F.when(_kind_of(F.col("v_rules")).startswith("ARRAY"), F.json_array_length(F.to_json("v_rules"))), F.lit(0))})
    family = F.when(_kind_of(F.col("v_language")) == "STRING", F.try_variant_get("v_language", "$", "string"))
    rows = rows.withColumns({"has_subject": F.col("v_subject").isNotNull(), "has_language": F.col("v_language").isNotNull(), "family": F.when(family.isin(list(v.FAMILIES)), family)})
    types = F.create_map(*[F.lit(x) for pair in {"STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "VOID": "NoneType", "ARRAY": "list"}.items() for x in pair])
    got = F.coalesce(F.try_element_at(types, F.regexp_extract(_kind_of(F.col("node")), r"^\w+", 0)), F.lit("float"))
    bad_level = F.concat(F.lit("Malformed rule: invalid min_level "), _shown(F.col("v_min_level"), quoted=True))
    is_subject, is_more = F.col("rule") == "subject", F.col("rule") == "any_additional_language"
    message = (
        F.when(~F.col("is_object"), F.concat(F.lit("Malformed rule: expected an object, got "), got))
        .when(F.col("group"), F.when((F.col("rule") == "any") & (F.col("branches") == 0), "Malformed rule: 'any' node has no branches"))
        .when(is_more, F.when(F.col("least").isNull(), bad_level))
        .when(~is_subject, F.concat(F.lit("Unknown rule kind '"), _shown(F.col("v_kind")), F.lit("'")))
        .when(F.col("has_subject") == F.col("has_language"), "Malformed rule: set exactly one of subject/language")
        .when(F.col("has_language") & F.col("family").isNull(), F.concat(F.lit("Malformed rule: unknown language family '"), _shown(F.col("v_language")), F.lit("'")))
        .when(F.col("least").isNull(), bad_level)
    )
    rows = rows.withColumn("message", message)
    sound = F.col("message").isNull()
    what = F.when(~sound, "malformed").when(F.col("group"), F.col("rule")).when(is_more, "additional").when(F.col("has_language"), "language").otherwise("subject")
    rows = rows.withColumn("what", what)
    subject, language, names = F.col("what") == "subject", F.col("what") == "language", F.create_map(*[F.lit(x) for pair in v.LANGUAGE_NAMES.items() for x in pair])
    form = lambda end: F.when(language, F.concat("family", F.lit(end)))
    key = F.when(subject, _shown(F.col("v_subject"))).when(language, F.col("family"))
    return rows.select(
        "tree", "at",
        F.col("what").alias("kind"), key.alias("key"), F.when(subject, subject_name(key)).when(language, F.try_element_at(names, F.col("family"))).alias("name"),
        F.when(F.col("what").isin("subject", "language", "additional"), F.col("least")).alias("min_level"),
        form("_hl").alias("hl"), form("_fal").alias("fal"), F.when(language, F.coalesce(_level(F.col("v_min_level_fal")), F.col("least"))).alias("min_level_fal"),
        F.when(language, F.col("family")).alias("language"), F.when(language, subject_name(form("_hl"))).alias("hl_name"), F.when(language, subject_name(form("_fal"))).alias("fal_name"),
        F.when(~sound, F.when(~F.col("is_object"), "unknown").when(F.col("group") | is_subject | is_more, F.col("rule")).otherwise(_shown(F.col("v_kind")))).alias("fail_kind"), "message", "path",
    )


#: Children stand before their parent, so the positions are known in one pass over the tree's array.
_CHILDREN = "transform(filter(places, x -> size(x.at) = size(n.at) + 1 and slice(x.at, 1, size(n.at)) = n.at), x -> x.i)"
#: At each "all" above, the languages among the earlier children, nearest first; "any" adds none.
_CONSUMERS = """flatten(transform(sequence(size(n.at) - 1, 0, -1), k ->
    if(exists(places, p -> p.kind = 'all' and p.at = slice(n.at, 1, k)),
      reverse(transform(filter(places, x -> x.kind = 'language' and size(x.at) = k + 1 and slice(x.at, 1, k) = slice(n.at, 1, k) and x.at[k] < n.at[k]), x -> x.i)),
      cast(array() AS array<int>))))"""


def flatten_trees_sql(trees: DataFrame, column: str = "subjects") -> DataFrame:
    """(column, nodes) for each distinct tree text, nodes in post-order as evaluation reads them.

    A tree's nodes are one array, as they are in evaluation; nothing else grows with a tree.
    """
    rows = _typed(tree_rows(trees, column))
    fields = [c for c in rows.columns if c != "tree"]
    # A node comes after all below it: its positions are followed by the largest number.
    placed = F.struct(F.array_append("at", F.lit(2**31 - 1)).alias("place"), *fields)
    whole = rows.groupBy("tree").agg(F.sort_array(F.collect_list(placed)).alias("all"))
    whole = whole.withColumn("places", F.expr("transform(all, (n, i) -> named_struct('at', n.at, 'kind', n.kind, 'i', i))"))
    given = {"children": f"if(n.kind in ('all', 'any'), {_CHILDREN}, cast(array() AS array<int>))", "consumers": f"if(n.kind = 'additional' and size(n.at) > 0, {_CONSUMERS}, cast(array() AS array<int>))"}
    struct = ", ".join(f"'{f}', {given.get(f, f'n.{f}')}" for f in _FIELDS)
    return whole.select(F.col("tree").alias(column), F.expr(f"transform(all, n -> named_struct({struct}))").cast(f"array<{NODE}>").alias("nodes"))
