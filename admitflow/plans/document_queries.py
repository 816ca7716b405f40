"""Registered queries of the document, discovery and streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import vocabulary as v
from ..operators import cells, discovery, geometry, pages, refdata
from ..operators import qualify as q
from ..operators import rules
from ..sources.scratch import scratch_folder
from ..streaming import streams
from . import testviews as t
from .queries import query

# Rotated text


def _chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The characters of each document, partitioned by page, rotated but in every third document; lines break every 20."""
    # Texts are dealt out by page before they are taken apart; many tasks, as each sorts some 100 bytes a character.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    d = t.table(spark, sf_dir, "documents").select(F.lit("all").alias("doc"), F.col("doc_id").cast("int").alias("page"), "doc_id", "text").repartition(tasks, "page")
    c = d.select("doc", "page", "doc_id", F.posexplode(F.split("text", "")).alias("seq", "text"))
    n = F.col("seq")
    piece = F.floor(n / 20)
    return c.where(F.length("text") > 0).select(
        "doc", "page", "seq", "text", (F.col("doc_id") % 3 == 0).alias("upright"),
        F.lit(0.0).alias("a"), F.lit(8.0).alias("b"), F.lit(-8.0).alias("c"), F.lit(0.0).alias("d"), (F.floor(n / 60) * 20).cast("double").alias("e"), (n * 5 + piece * 30).cast("double").alias("f"),
        (F.floor(n / 60) * 20).cast("double").alias("x0"), (F.floor(n / 60) * 20 + 8).cast("double").alias("x1"), (n * 5).cast("double").alias("top"), (n * 5 + 5).cast("double").alias("bottom"),
    )


_CHARS = """chars AS (SELECT doc_id::INT AS page, n, ch, n // 60 AS col, n // 20 AS piece FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(length(text))) AS n FROM documents WHERE text <> '') WHERE doc_id % 3 <> 0
), runs AS (SELECT page, -160.0 * col AS perp, piece, string_agg(ch, '' ORDER BY n) AS text, min(n) AS first_n, avg(col * 20.0) AS x0, min(n * 5.0) AS top, max(n * 5.0 + 5) AS bottom FROM chars GROUP BY page, col, piece
), numbered AS (SELECT *, (row_number() OVER (PARTITION BY page ORDER BY perp, piece) - 1)::INT AS run FROM runs)"""


@query(f"WITH {_CHARS} SELECT page, run, text, x0, top, bottom FROM numbered")
def rotated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of rotated characters in reading order."""
    return geometry.rotated_runs(_chars(spark, sf_dir), placed=True).select("page", "run", "text", "x0", "top", "bottom")


@query(f"WITH {_CHARS}, r AS (SELECT page, string_agg(text, chr(10) ORDER BY run) AS runs FROM numbered GROUP BY page) SELECT doc_id::INT AS page, md5('base' || coalesce(chr(10) || runs, '')) AS digest FROM documents LEFT JOIN r ON page = doc_id")
def repaired_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the ordered text of their rotated runs put behind."""
    base = t.table(spark, sf_dir, "documents").select(F.lit("all").alias("doc"), F.col("doc_id").cast("int").alias("page"), F.lit("base").alias("text"))
    return geometry.repaired_text(base, _chars(spark, sf_dir), placed=True).select("page", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("""WITH e AS (SELECT *, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER w > 3600 THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    i AS (SELECT user_id, event_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e) SELECT user_id, island::BIGINT AS island, count(*) AS n, min(event_id) AS first FROM i GROUP BY ALL""")
def gaps_and_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Islands of each user's events without a gap over an hour: the clustering step of runs, columns and blocks."""
    e = t.table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return geometry.islands(e, ["user_id"], ["ts", "event_id"], F.col("at"), 3600, "island").groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@query("""WITH c AS (SELECT i, i * 97.0 AS centre FROM (SELECT unnest(range(10)) AS i)) SELECT doc_id, arg_min(i, abs(centre - n_chars % 1000) * 100 + i)::INT AS col FROM documents, c GROUP BY doc_id""")
def nearest_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of ten columns by position, the first on ties."""
    d = t.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("doc"), (F.col("n_chars") % 1000).alias("x"))
    centres = d.select("doc").distinct().select("doc", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("col")).withColumn("centre", F.col("col") * 97.0)
    return geometry.nearest(d, centres, ["doc"], F.abs(F.col("centre") - F.col("x")), "col", ["doc_id", "doc"]).select("doc_id", "col")


# Cells and trees

_CELL = """CASE p_size % 8 WHEN 0 THEN '' WHEN 1 THEN 'Not accepted' WHEN 2 THEN 'accepted Not' WHEN 3 THEN 'OR ' || (p_partkey % 9) || ' (50%)' WHEN 4 THEN (p_partkey % 9) || ' (60%+)**' WHEN 5 THEN 'see page' WHEN 6 THEN ' ' || (1 + p_partkey % 7) || ' ' ELSE 'level ' || (p_partkey % 9) END"""


def _cell(text):
    return s.interpret_cell(text, F.array(F.lit("**")), F.array(F.lit("Not accepted")), F.array(F.lit("OR")))


@query(f"""WITH c AS (SELECT p_partkey, p_size % 8 AS k, p_partkey % 9 AS n, 1 + p_partkey % 7 AS m FROM part)
    SELECT p_partkey, CASE WHEN k IN (1, 2) THEN 'not_accepted' WHEN k = 6 THEN 'level' WHEN k IN (0, 5) OR n NOT BETWEEN 1 AND 7 THEN 'empty' WHEN k = 3 THEN 'alternative' ELSE 'level' END AS kind,
      CASE WHEN k = 6 THEN m WHEN k IN (3, 4, 7) AND n BETWEEN 1 AND 7 THEN n END::INT AS level FROM c""")
def interpreted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and level of requirement cells."""
    part = t.spread(t.table(spark, sf_dir, "part")).withColumn("text", F.expr(_CELL))
    return part.withColumn("cell", _cell(F.col("text"))).select("p_partkey", "cell.kind", "cell.level")


@query("""WITH c AS (SELECT p_partkey AS k, (p_partkey % 3) + 2 AS a, (p_partkey % 4) + 3 AS b FROM part)
    SELECT k AS p_partkey, CASE WHEN k % 5 = 0 THEN '{"kind":"all","rules":[{"kind":"any","rules":[{"kind":"subject","subject":"mathematics","min_level":' || a || '},{"kind":"subject","subject":"mathematical_literacy","min_level":' || b || '}]},{"kind":"subject","language":"english","min_level":4}]}'
      WHEN k % 5 IN (1, 2) THEN '{"kind":"all","rules":[{"kind":"subject","language":"english","min_level":4},{"kind":"any","rules":[{"kind":"subject","subject":"mathematics","min_level":' || a || '},{"kind":"subject","subject":"mathematical_literacy","min_level":' || b || '}]}]}'
      ELSE '{"kind":"all","rules":[{"kind":"subject","language":"english","min_level":4},{"kind":"subject","subject":"mathematics","min_level":' || a || '}]}' END AS tree,
      CASE WHEN k % 5 IN (3, 4) THEN 'mathematical_literacy' ELSE '' END AS excluded FROM c""")
def built_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule trees from rows of cells: plain levels of exclusive subjects, a marked alternative, a rejection."""
    part = t.spread(t.table(spark, sf_dir, "part")).select("p_partkey", (F.col("p_partkey") % 5).alias("k"), (F.col("p_partkey") % 3 + 2).alias("a"), (F.col("p_partkey") % 4 + 3).alias("b"))
    third = F.when(F.col("k") == 0, F.col("b").cast("string")).when(F.col("k") < 3, F.concat(F.lit("OR "), F.col("b").cast("string"))).otherwise("Not accepted")
    cell = lambda slug, text: F.struct(F.lit(slug).alias("slug"), _cell(text).alias("cell"))
    row = F.array(cell("english", F.lit("4")), cell("mathematics", F.col("a").cast("string")), cell("mathematical_literacy", third))
    built = part.withColumn("t", cells.build_tree(row, [["mathematics", "mathematical_literacy"]]))
    return built.select("p_partkey", "t.tree", F.array_join("t.excluded", ",").alias("excluded"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN (14 + p_size % 35) || ':' WHEN 1 THEN (14 + p_size % 35) || ':mathematics;' || (14 + p_size % 35) || ':mathematical_literacy'
      WHEN 2 THEN '20:mathematics;' || '30:technical_mathematics' END AS score FROM part""")
def score_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds of score cells; ambiguous ones abstain."""
    n = (14 + F.col("p_size") % 35).cast("string")
    k = F.col("p_partkey") % 6
    text = F.when(k == 0, n).when(k == 1, F.concat(n, F.lit(" with Mathematics OR "), n, F.lit(" with\nMathematics Literacy"))).when(k == 2, "20 with Mathematics OR 30 with Technical Mathematics").when(k == 3, "20 or 30 with Mathematics").when(k == 4, "3 (40%+)").otherwise("")
    scored = t.spread(t.table(spark, sf_dir, "part")).withColumn("s", cells.score_cell(text))
    return scored.select("p_partkey", F.array_join(F.transform("s", lambda e: F.concat_ws(":", e["min_score"].cast("string"), F.coalesce(e["requires_subject"], F.lit("")))), ";").alias("score"))


@query("""SELECT source AS doc, doc_id::INT AS page, CASE doc_id % 4 WHEN 0 THEN 'geography,technical_mathematics' ELSE 'technical_mathematics' END AS excluded FROM documents WHERE doc_id % 4 < 2""")
def prose_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that a page's prose rejects; what follows the phrase and sentences with codes don't count."""
    k = F.col("doc_id") % 4
    line = F.when(k == 0, "Study well. Technical Mathematics and\tGeography are NOT  accepted here.").when(k == 1, "Technical Mathematics is not accepted, and where Mathematics is a major, see History.").when(k == 2, "B8BA3Q Geography not accepted.").otherwise("History is welcome.\nnot accepted")
    pages = t.table(spark, sf_dir, "documents").select(F.col("source").alias("doc"), F.col("doc_id").cast("int").alias("page"), line.alias("text"))
    return cells.page_exclusions(pages, ["not accepted"], v.DEFAULT_PROFILE["layout"]["code_pattern"]).withColumn("excluded", F.array_join("excluded", ","))


@query("""WITH r AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS row FROM lineitem),
    g AS (SELECT *, count(*) FILTER (WHERE l_partkey % 3 = 0) OVER (PARTITION BY o ORDER BY row) AS programme FROM r) SELECT o::VARCHAR AS page, programme, count(*) AS rows FROM g WHERE programme > 0 GROUP BY ALL""")
def programme_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table grouped into programmes, each starting at a row with a code."""
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    code = F.when(F.col("l_partkey") % 3 == 0, F.lit(" B2ABC ")).otherwise(F.lit("text"))
    rows = t.table(spark, sf_dir, "lineitem").select(F.lit("d").alias("doc"), F.col("l_orderkey").cast("string").alias("page"), F.row_number().over(order).alias("row"), F.array(F.lit("x"), code).alias("cells"))
    return cells.group_rows(rows, v.DEFAULT_PROFILE["layout"]["code_pattern"]).groupBy("page", "programme").agg(F.count("*").alias("rows"))


def _ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = t.spread(t.table(spark, sf_dir, "part")), F.col("p_partkey").cast("string")
    table = F.concat(
        F.lit("text\n| Programme | English | Qualification Code | Mathematics | Campus | APS |\n|---|:-:|---|---|---|---|\n| <|det|>"), F.element_at(F.split("p_name", " "), 1), F.lit(" [1, 2]<|/det|> | 4 | B2"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"),
        F.lit(" | "), (F.col("p_partkey") % 7 + 1).cast("string"), F.lit(" (60%) | APB, SWC | "), (10 + F.col("p_size")).cast("string"), F.lit(" |\n| no code | 4 | - | 5 | APB | 30 |\n"),
    )
    return p.select(F.lit("d").alias("doc"), F.col("p_partkey").cast("int").alias("page"), F.when(n.endswith("9"), "no table").otherwise(table).alias("markdown"))


@query("""SELECT p_partkey::INT AS page, 'B2' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS code, split_part(p_name, ' ', 1) AS name, 'APB' AS campus, (10 + p_size)::INT AS score,
    '{"kind":"all","rules":[{"kind":"subject","language":"english","min_level":4},{"kind":"subject","subject":"mathematics","min_level":' || (p_partkey % 7 + 1) || '}]}' AS tree FROM part WHERE p_partkey % 10 <> 9""")
def markdown_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of pages read as Markdown tables."""
    profile = {"layout": {**v.DEFAULT_PROFILE["layout"], "campus_tokens": ["APB", "DFC"], "not_accepted_phrases": ["Not accepted"]}}
    return cells.markdown_records(_ocr(spark, sf_dir), profile).select("page", "code", "name", F.array_join("campus", ",").alias("campus"), "score", "tree")


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("event_id") % 4, F.col("event_id").cast("string")
    good = F.concat(F.lit('{"programmes":[{"qualification_code":"B'), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), F.lit('","name":"n'), n, F.lit('","career_text":"x"},{"qualification_code":"bad code"},7]}'))
    body = F.when(k == 0, good).when(k == 1, F.col("props")).when(k == 2, F.lit("{not json")).otherwise(F.lit('{"programmes":{}}'))
    return t.table(spark, sf_dir, "events").select(F.col("event_type").alias("doc"), F.col("event_id").cast("int").alias("page"), body.alias("body"))


@query("SELECT event_id::INT AS page, 'B' || lpad((event_id % 1000)::VARCHAR, 3, '0') AS qualification_code, 'n' || event_id AS name FROM events WHERE event_id % 4 = 0")
def response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records admitted from model responses."""
    return cells.parse_responses(_responses(spark, sf_dir))[0].select("page", "qualification_code", "name")


@query("SELECT event_type AS doc, count(*) AS pages_attempted, count(*) FILTER (WHERE event_id % 4 <> 2) AS pages_parsed, count(*) FILTER (WHERE event_id % 4 = 2) AS pages_abstained FROM events GROUP BY 1")
def response_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses attempted, parsed and abstained by document."""
    return cells.response_statistics(cells.parse_responses(_responses(spark, sf_dir))[1])


@query(f"""WITH {t.PAGES}, r AS (SELECT doc, page, doc_id, unnest(CASE WHEN doc_id % 15 = 0 THEN ['**', '*'] WHEN doc_id % 3 = 0 THEN ['*'] WHEN doc_id % 5 = 0 THEN ['**'] ELSE [] END) AS marker FROM page_text),
    l AS (SELECT doc, page AS legend_page, CASE WHEN doc_id % 2 = 0 THEN '*' ELSE '**' END AS marker, 'Legend ' || doc_id AS footnote_text FROM page_text WHERE doc_id % 7 = 0)
    SELECT doc, page, marker, arg_max(footnote_text, legend_page) AS footnote_text FROM r JOIN l USING (doc, marker) WHERE legend_page BETWEEN page - 5 AND page GROUP BY ALL""")
def resolved_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnotes of each record with the nearest legend on its page or up to five pages back."""
    k = F.col("doc_id")
    code = F.concat(F.lit("B2"), F.lpad((k % 10000).cast("string"), 4, "0"))
    marked = F.concat(code, F.lit(" name"), F.when(k % 3 == 0, " 5*").otherwise(" 5"), F.when(k % 5 == 0, " 6**").otherwise(" 6"), F.lit("\nQ9ZZZZ *\n"))
    text = F.concat(marked, F.when(k % 7 == 0, F.concat(F.when(k % 2 == 0, "* ").otherwise("** "), F.lit("Legend "), k.cast("string"))).otherwise("end"))
    pages = t.pages(spark, sf_dir).select("doc", "page", text.alias("text"), code.alias("code"))
    found = cells.footnotes(pages.drop("code"), pages.select("doc", "page", "code"), ["*", "**"], v.DEFAULT_PROFILE["layout"]["code_pattern"])
    return found.select("doc", "page", "marker", "footnote_text")


# Discovery


@query("""SELECT page_id, (unnest(range(len(l))))::INT AS position, unnest(l) AS fragment FROM (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS l FROM pages) WHERE len(l) > 0""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page as rows."""
    return discovery.fragments(t.table(spark, sf_dir, "pages"), r'<a href="[^"]*">[^<]*</a>').select("page_id", "position", "fragment")


@query("SELECT page_id, regexp_extract(rtrim(url, '/'), '([^/]*)$', 1) AS slug FROM pages")
def url_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last path segment of every URL."""
    return t.table(spark, sf_dir, "pages").select("page_id", s.last_segment(F.col("url")).alias("slug"))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of cards per year, a card per customer."""
    n = F.col("c_custkey").cast("string")
    card = F.concat(F.lit('<div class="x card"><h5 class="card-title">'), F.col("c_name"), F.lit("&amp;Co Prospectus "), (2023 + F.col("c_custkey") % 5).cast("string"), F.lit('</h5><a href="https://h/pdf-prospectus/s'), n, F.lit('/">go</a></div>'))
    c = t.table(spark, sf_dir, "customer").select((2023 + F.col("c_custkey") % 5).cast("int").alias("academic_year"), (F.col("c_custkey") % 97).alias("listing"), card.alias("card"))
    return c.groupBy(F.lit("cards").alias("source"), "academic_year", "listing").agg(F.array_join(F.sort_array(F.collect_list("card")), "\n").alias("html")).drop("listing")


@query("SELECT (2023 + c_custkey % 5)::INT AS academic_year, 's' || c_custkey AS source_id, c_name || '&Co' AS display_name FROM customer")
def card_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of card listings."""
    return discovery.card_listing(_listing(spark, sf_dir)).select("academic_year", "source_id", "display_name")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries named after nations, in odd spelling, some of several institutions."""
    k = F.col("c_custkey")
    name = F.when(k % 11 == 0, "KZN  CAO handbook").when(k % 6 == 0, F.concat(F.lit("unknown "), k.cast("string"))).otherwise(F.concat(F.lit("  Nation_"), (k % 20).cast("string"), F.lit(" ")))
    return t.table(spark, sf_dir, "customer").select((2023 + k % 5).cast("int").alias("academic_year"), k.cast("string").alias("source_id"), name.alias("display_name"), k.alias("k"))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = t.table(spark, sf_dir, "nation").select(F.col("n_name").alias("variant"), F.col("n_name").alias("institution_id"))
    return discovery.annotate(_entries(spark, sf_dir), names)


_ENTRIES = "entries AS (SELECT (2023 + c_custkey % 5)::INT AS academic_year, c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'SKIPPED_MULTI_INSTITUTION' WHEN c_custkey % 6 = 0 THEN 'UNMAPPED' ELSE 'MAPPED' END AS status, CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 6 <> 0 THEN 'NATION_' || c_custkey % 20 END AS institution_id FROM customer)"


@query(f"WITH {_ENTRIES} SELECT k, status, institution_id FROM entries")
def annotated_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries mapped to institutions, skipped or left unmapped."""
    return _annotated(spark, sf_dir).select("k", "status", "institution_id")


@query(f"WITH {_ENTRIES} SELECT n_name AS institution_id, EXISTS (SELECT 1 FROM entries e WHERE e.institution_id = n_name AND academic_year = 2027) AS present FROM nation")
def year_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which institutions a year's entries cover."""
    return discovery.coverage(_annotated(spark, sf_dir), t.institutions(spark, sf_dir), 2027)


@query(f"""WITH {_ENTRIES}, e AS (SELECT * FROM entries), m AS (SELECT n_name AS i FROM nation WHERE n_name NOT IN (SELECT institution_id FROM e WHERE academic_year = 2027 AND institution_id IS NOT NULL))
    SELECT i AS institution_id, coalesce(string_agg(DISTINCT academic_year, ',' ORDER BY academic_year DESC), '') AS years FROM m LEFT JOIN e ON e.institution_id = i AND academic_year BETWEEN 2023 AND 2026 GROUP BY i""")
def historical_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier years that cover the institutions missing now."""
    out = discovery.historical_coverage(_annotated(spark, sf_dir), t.institutions(spark, sf_dir), 2027)
    return out.withColumn("years", F.array_join(F.transform("years", lambda y: y.cast("string")), ","))


@query("SELECT p_partkey, lower(CASE p_partkey % 3 WHEN 0 THEN 'Mathematics' WHEN 1 THEN 'Physical Sciences' ELSE 'English Home Language' END) AS name, (p_partkey % 7 + 1)::INT AS level FROM part")
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names and levels of subject keys."""
    key = F.element_at(F.array(*[F.lit(x) for x in ("mathematics", "physical_sciences", "english_hl")]), (F.col("p_partkey") % 3 + 1).cast("int"))
    return t.spread(t.table(spark, sf_dir, "part")).select("p_partkey", F.lower(s.subject_name(key)).alias("name"), s.level(s.least_percentage((F.col("p_partkey") % 7 + 1).cast("int"))).alias("level"))


@query(f"WITH {t.PROGRAMMES} SELECT p_type, count(*) AS programmes FROM programmes GROUP BY 1")
def tree_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes per distinct rule tree, by the tree's canonical key."""
    p = t.programmes(spark, sf_dir)
    kinds = spark.createDataFrame([(rules.tree_key(__import__("json").dumps(tree)), k) for k, tree in t.TREES.items()], "tree_key string, p_type string")
    return p.join(rules.tree_keys(p, "subjects"), "subjects").join(F.broadcast(kinds), "tree_key").groupBy("p_type").agg(F.count("*").alias("programmes"))


# Streams


@query("SELECT DISTINCT sha256('%PDF-' || text) AS sha256 FROM documents WHERE text IS NOT NULL")
def stream_deduplicated_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of a stream's contents, equal ones once."""
    folder = scratch_folder(spark)
    source = spark.readStream.schema(t.table(spark, sf_dir, "documents").schema).parquet(f"{sf_dir}/documents.parque[t]")  # as a pattern, it may be a file or a folder
    documents = source.where("text is not null").select(F.concat(F.lit("/in/site/2027/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"), F.concat(F.lit("%PDF-"), "text").cast("binary").alias("content"))
    streams.run_ingestion(documents, t.institutions(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("sha256")


@query(
    f"""WITH {t.MARKS}, n AS (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY level DESC) AS n FROM marks WHERE subject <> 'life_orientation')
    SELECT learner_id, sum(level)::INT AS score FROM n WHERE n <= 6 GROUP BY learner_id"""
)
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the learners whose marks arrive on a stream; a learner's marks come in one batch."""
    folder = scratch_folder(spark)
    lines = spark.readStream.schema(t.table(spark, sf_dir, "lineitem").schema).parquet(f"{sf_dir}/lineitem.parque[t]")

    def answer(batch: DataFrame) -> DataFrame:
        lines = batch.join(t.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        subject = F.element_at(F.array(*[F.lit(x) for x in t.SUBJECTS]), (F.col("l_partkey") % 12 + 1).cast("int"))
        marks = lines.where((F.col("o_custkey") + F.col("l_partkey") % 12) % 4 != 0).select(F.col("o_custkey").alias("learner_id"), F.struct(*t._LAST).alias("ordinal"), subject.alias("subject"), (2 * F.col("l_quantity")).cast("int").alias("percentage"))
        valid, _ = q.validate_requests(q.last_marks(marks).withColumn("ordinal", F.lit(0)))
        return q.learner_maps(valid).select("learner_id", q.SCORERS["aps_best6_excl_lo"](F.col("marks")).alias("score"))

    streams.answer_requests(lines, answer, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("learner_id", "score")


@query("SELECT event_type AS status, count(*) AS n FROM (SELECT user_id, arg_max(event_type, epoch_us(ts) * 10 + (event_id % 10)) AS event_type FROM (SELECT user_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'classifying' ELSE 'pending' END AS event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) GROUP BY user_id) GROUP BY 1")
def latest_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last status of each document from its changes."""
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "classifying").otherwise("pending")
    changes = t.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sha256"), status.alias("status"), F.lit(None).cast("string").alias("error"), F.col("ts").alias("changed_at"))
    return streams.latest_status(changes).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT doc_id AS row_id, unnest(['missing key layout', 'unknown key text']) AS error FROM documents WHERE doc_id % 5 = 1 UNION ALL SELECT doc_id, 'not an object' FROM documents WHERE doc_id % 5 = 2")
def structural_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and unknown keys of JSON rows."""
    k = F.col("doc_id") % 5
    body = F.when(k == 1, '{"name":1,"text":2}').when(k == 2, "[1]").otherwise('{"name":1,"layout":{}}')
    return refdata.structural_errors(t.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), body.alias("body")), ["name", "layout"], ["name", "layout", "quirks"])


# Whole table methods


def _table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per part: a header and two rows as ruled table, a worse reading as text."""
    k = F.col("p_partkey")
    code = F.concat(F.lit("B2"), F.lpad((k % 10000).cast("string"), 4, "0"))
    text = lambda *cells: F.array(*[c if hasattr(c, "cast") else F.lit(c) for c in cells])
    rows = F.array(text("Code", "Programme", "English", "OR", "Mathematics", "APS"), text(code, F.element_at(F.split("p_name", " "), 1), "4 (50%)", F.when(k % 2 == 0, "OR").otherwise(""), (k % 7 + 1).cast("string"), (14 + F.col("p_size") % 30).cast("string")), text("no", "code", "4", "", "4", "30"))
    part = t.spread(t.table(spark, sf_dir, "part")).select(F.lit("d").alias("doc"), k.cast("int").alias("page"), F.posexplode(rows).alias("row", "cells"))
    ruled = part.select("doc", "page", F.lit("lattice").alias("strategy"), "row", F.posexplode("cells").alias("col", "text"))
    ruled = ruled.withColumns({"n_chars": F.lit(4), "n_rotated": F.when(F.col("col") == 2, 4).otherwise(0)}).withColumn("text", F.when(F.col("col") == 2, F.reverse("text")).otherwise(F.col("text")))
    loose = part.where("row = 0").select("doc", "page", F.lit("stream").alias("strategy"), "row", F.lit(0).alias("col"), F.lit("nothing").alias("text"), F.lit(4).alias("n_chars"), F.lit(0).alias("n_rotated"))
    return ruled.unionByName(loose)


_METHOD_PROFILE = {"layout": {"code_pattern": r"[A-Z]\d[A-Z0-9]{3,4}", "header_keywords": ["code", "programme", "english", "aps"], "rotated_headers": True, "alternative_phrases": ["OR"], "not_accepted_phrases": ["Not accepted"], "campus_tokens": ["APB"]}}
_METHOD_TREE = """'{"kind":"all","rules":[' || CASE WHEN p_partkey % 2 = 0 THEN '{"kind":"any","rules":[{"kind":"subject","language":"english","min_level":4},{"kind":"subject","subject":"mathematics","min_level":' || (p_partkey % 7 + 1) || '}]}'
  ELSE '{"kind":"subject","language":"english","min_level":4},{"kind":"subject","subject":"mathematics","min_level":' || (p_partkey % 7 + 1) || '}' END || ']}' AS tree"""


def _no_exclusions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc string, page int, excluded array<string>")


@query(f"SELECT p_partkey::INT AS page, 'B2' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS code, split_part(p_name, ' ', 1) AS name, (14 + p_size % 30)::INT AS score, {_METHOD_TREE} FROM part")
def geometric_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of ruled tables: better strategy, rotated cells, a marker column that joins the next subject."""
    got = geometry.geometric_records(_table_cells(spark, sf_dir), _no_exclusions(spark), _METHOD_PROFILE)
    return got.select("page", "code", "name", F.col("score")[0]["min_score"].alias("score"), "tree")


@query(f"SELECT p_partkey::INT AS page, 'B2' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS code, 'Bachelor of ' || split_part(p_name, ' ', 1) AS name, (14 + p_size % 30)::INT AS score, {_METHOD_TREE} FROM part")
def text_layer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of rotated tables: sections, columns by place, characters to rows, names and scores from upright words."""
    k = F.col("p_partkey")
    code = F.concat(F.lit("B2"), F.lpad((k % 10000).cast("string"), 4, "0"))
    line = lambda text, x, advance: F.struct((text if hasattr(text, "cast") else F.lit(text)).alias("text"), F.lit(float(x)).alias("x"), F.lit(float(advance)).alias("advance"))
    lines = F.array(line("Code", 50, 4000), line("English", 100, 4000), line("OR", 130, 4000), line("Mathematics", 160, 4000), line("APS", 210, 4000), line(code, 50, 1000), line("4", 100, 1000), line((k % 7 + 1).cast("string"), 160, 1000), line(F.when(k % 2 == 0, "OR").otherwise(""), 130, 1000))
    part = t.spread(t.table(spark, sf_dir, "part")).withColumn("page", k.cast("int"))
    each = part.select("page", F.posexplode(lines).alias("n", "l")).select("page", "n", "l.*").where("text <> ''")
    chars = each.select("page", "n", "x", "advance", F.posexplode(F.split("text", "")).alias("i", "text")).where("text <> ''")
    top = F.when(F.col("advance") > 2000, 10.0).otherwise(100.0) + F.col("i")
    chars = chars.select(F.lit("d").alias("doc"), "page", (F.col("n") * 100 + F.col("i")).alias("seq"), "text", F.lit(False).alias("upright"), F.lit(0.0).alias("a"), F.lit(8.0).alias("b"), F.lit(-8.0).alias("c"), F.lit(0.0).alias("d"), F.col("x").alias("e"), (F.col("advance") / 8 + F.col("i") * 2).alias("f"), F.col("x").alias("x0"), (F.col("x") + 8).alias("x1"), top.alias("top"), (top + 1).alias("bottom"))
    word = lambda text, x0, x1, y: F.struct(text.alias("text"), F.lit(x0).alias("x0"), F.lit(x1).alias("x1"), F.lit(y).alias("top"))
    said = F.array(word(F.lit("Bachelor"), 5.0, 20.0, 101.0), word(F.lit("of"), 21.0, 25.0, 101.0), word(F.element_at(F.split("p_name", " "), 1), 5.0, 20.0, 112.0), word((14 + F.col("p_size") % 30).cast("string"), 300.0, 310.0, 101.0))
    words = part.select(F.lit("d").alias("doc"), "page", F.explode(said).alias("w")).select("doc", "page", "w.*")
    got = geometry.text_layer_records(chars, words, _no_exclusions(spark), _METHOD_PROFILE)
    return got.select("page", "code", "name", F.col("score")[0]["min_score"].alias("score"), "tree")


@query("SELECT source AS doc, doc_id AS page, round(least(1.0, coalesce(sum(n_chars % 700 * 300.0) / nullif(any_value(CASE WHEN doc_id % 9 = 0 THEN 0.0 ELSE 600 * 800.0 END), 0), 0)), 9) AS image_area_ratio FROM documents GROUP BY source, doc_id")
def image_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each page under images."""
    d = t.table(spark, sf_dir, "documents").select(F.col("source").alias("doc"), F.col("doc_id").alias("page"), (F.col("n_chars") % 700).cast("double").alias("image_width"))
    images = d.withColumn("image_height", F.lit(300.0))
    sizes = d.select("doc", "page", F.lit(600.0).alias("width"), F.when(F.col("page") % 9 == 0, 0.0).otherwise(800.0).alias("height"))
    return pages.image_coverage(images, sizes).withColumn("image_area_ratio", F.round("image_area_ratio", 9))


@query("SELECT doc, page FROM (SELECT source AS doc, (doc_id % 70)::INT AS page FROM documents) a JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) b ON a.doc = b.source WHERE page BETWEEN 1 AND n")
def existing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages asked for that their document has."""
    d = t.table(spark, sf_dir, "documents")
    counts = d.groupBy(F.col("source").alias("doc")).agg(F.count("*").alias("page_count"))
    return pages.existing_pages(d.select(F.col("source").alias("doc"), (F.col("doc_id") % 70).cast("int").alias("page")), counts)


@query(f"WITH {t.PAGES} SELECT doc, count(*) AS pages, sum(n_chars)::BIGINT AS total_chars FROM page_text GROUP BY doc")
def profile_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence for a draft profile of each document, by its totals."""
    p = t.pages(spark, sf_dir)
    found = pages.profile_evidence(p.select("doc", "page", "text"), p.select("doc", "page", "n_chars", (F.col("page") % 2).alias("n_rotated")))
    return found.select("doc", F.size("pages_sampled").cast("long").alias("pages"), F.col("rotation.total_chars").alias("total_chars"))
