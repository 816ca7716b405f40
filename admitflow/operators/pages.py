"""Page signals, page classification, document triage and evidence for new profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import vocabulary as v


def signals(primitives: DataFrame, layout: dict) -> DataFrame:
    """``page_primitives`` with the eight signals of ``vocabulary.SIGNALS``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return primitives.select(
        "doc",
        "page",
        s.density(F.col("char_count"), F.col("width"), F.col("height")).alias("text_density"),
        F.regexp_count(text, F.lit(f"(?mU){layout['code_pattern']}")).alias("code_matches"),
        s.distinct_hits(text, layout["header_keywords"]).alias("keyword_hits"),
        s.numeric_ratio(text).alias("numeric_ratio"),
        F.col("line_count").alias("ruled_line_count"),
        F.col("image_area_ratio").alias("image_coverage"),
        s.distinct_hits(text, v.SCORING_PHRASES).alias("scoring_phrase_hits"),
        s.distinct_hits(text, v.ALTERNATIVE_PHRASES).alias("alt_admission_phrase_hits"),
    )


def classify(signalled: DataFrame, classification: dict) -> DataFrame:
    """Pages with page_class and a score per class.

    The class of the highest score wins, the first of ``vocabulary.PAGE_CLASSES`` on ties. Where a page shows a code
    or enough ruled lines and the table's score is within the margin of the winner, it counts as a table.
    """
    weights = classification["weights"]
    score = lambda c: reduce(lambda a, b: a + b, [F.col(n).cast("double") * w for n, w in weights[c].items()], F.lit(classification["admin_baseline"] if c == "admin" else 0.0).cast("double"))
    out = signalled.withColumns({f"score_{c}": score(c) for c in v.PAGE_CLASSES})
    order = F.array(*[F.struct(F.col(f"score_{c}").alias("s"), F.lit(-k).alias("k"), F.lit(c).alias("c")) for k, c in enumerate(v.PAGE_CLASSES)])
    best = F.array_max(order)
    evidence = (F.col("code_matches") >= 1) | (F.col("ruled_line_count") >= classification["table_evidence_ruled_line_floor"])
    near = best["s"] - F.col("score_programme_table") <= classification["overinclusion_margin"]
    return out.withColumn("page_class", F.when(evidence & near, v.PAGE_CLASSES[0]).otherwise(best["c"]))


def classification_result(classified: DataFrame) -> DataFrame:
    """Per document: page_count, the table pages in order, and number of pages by class."""
    by_class = classified.groupBy("doc", "page_class").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("page_class") == v.PAGE_CLASSES[0], F.col("page"))).alias("pages"))
    return by_class.groupBy("doc").agg(
        F.sum("n").alias("page_count"), F.sort_array(F.flatten(F.collect_list("pages"))).alias("table_pages"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("page_class", "n")))).alias("stats")
    )


def code_matches(text: Column) -> Column:
    """Matches of the code shape that fits the page best."""
    return F.greatest(*[F.regexp_count(text, F.lit(f"(?U){p}")) for p in v.CODE_SHAPES.values()])


def programme_line(line: Column) -> Column:
    """Whether a line is a name and numbers, or has a code and a plausible score."""
    line = s.strip(line)
    code = reduce(lambda a, b: a | b, [F.regexp_like(line, F.lit(f"(?U){p}")) for p in v.CODE_SHAPES.values()])
    return F.regexp_like(line, F.lit(f"(?U){v.NAME_AND_NUMBERS}")) | (code & F.regexp_like(line, F.lit(f"(?U){v.SCORE_NUMBER}")))


def estimated_rows(text: Column, cells_per_programme: int = 4) -> Column:
    """Programmes on a page, by lines and by level cells."""
    lines = F.size(F.filter(F.split(text, "\n"), programme_line))
    return lines + F.floor(F.regexp_count(text, F.lit(f"(?U){v.LEVEL_CELL}")) / cells_per_programme).cast("int")


def triage(pages: DataFrame, least_codes: int = 3, full_pages: int = 10, full_rows: int = 50) -> DataFrame:
    """Per document of ``pages(doc, page, text, n_rotated)``: page_count, plausible_table_pages,
    estimated_programme_rows, rotated_pages, self_describes_partial and verdict.

    A marker of a partial document counts where a page holds it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    vocabulary = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in v.HEADER_VOCABULARY])
    facts = pages.select(
        "doc",
        (s.strip(text) != "").alias("has_text"),
        ((code_matches(text) >= least_codes) & vocabulary).alias("table"),
        estimated_rows(text).alias("rows"),
        (F.coalesce("n_rotated", F.lit(0)) > 0).alias("rotated"),
        *[F.contains(low, F.lit(m)).alias(f"m{k}") for k, m in enumerate(v.PARTIAL_MARKERS)],
    )
    out = facts.groupBy("doc").agg(
        F.count("*").alias("page_count"),
        F.count_if("table").alias("plausible_table_pages"),
        F.sum("rows").alias("estimated_programme_rows"),
        F.count_if("rotated").alias("rotated_pages"),
        F.array_compact(F.array(*[F.when(F.bool_or(f"m{k}"), m) for k, m in enumerate(v.PARTIAL_MARKERS)])).alias("self_describes_partial"),
        F.bool_or("has_text").alias("has_text"),
    )
    full = (F.col("estimated_programme_rows") >= full_rows) | (F.col("plausible_table_pages") >= full_pages)
    return out.withColumn("verdict", F.when(~F.col("has_text"), "UNREADABLE").when(full, "LIKELY_FULL").otherwise("LIKELY_SUMMARY")).drop("has_text")


def triage_report(documents: DataFrame) -> DataFrame:
    """Documents with most estimated rows first."""
    return documents.orderBy(F.desc("estimated_programme_rows"), "doc")


def document_identity(path: Column, fallback_year: int | None = None) -> tuple[Column, Column]:
    """(institution id, year) from a file's path: ``id_YEAR.pdf``, else the stem and a year directory."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    named = F.regexp_like(stem, F.lit(r"^[a-z0-9]+_\d{4}$"))
    folder = F.regexp_extract(path, r"/(\d{4})/[^/]+$", 1)
    year = F.when(named, F.right(stem, F.lit(4)).cast("int")).when(folder != "", folder.cast("int")).otherwise(F.lit(fallback_year).cast("int"))
    return F.when(named, F.regexp_extract(stem, r"^([a-z0-9]+)_", 1)).otherwise(stem), year


def sample_pages(documents: DataFrame, n: int) -> DataFrame:
    """(doc, page): ``n`` evenly spaced pages of each document of ``documents(doc, total)``, all of shorter ones."""
    spaced = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * (F.col("total") / n)).cast("int") + 1)
    return documents.where("total > 0").select("doc", F.explode(F.when(F.col("total") <= n, F.sequence(F.lit(1), F.col("total"))).otherwise(F.array_distinct(spaced))).alias("page"))


def top(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group by a total order, with their ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def code_shape_evidence(pages: DataFrame, samples: int = 10) -> DataFrame:
    """(doc, label, total_matches, pages_with_matches, samples) of each code shape; samples are the most frequent."""
    shapes = F.array(*[F.struct(F.lit(k).alias("label"), F.regexp_extract_all("text", F.lit(f"(?U){p}"), 0).alias("found")) for k, p in v.CODE_SHAPES.items()])
    found = pages.select("doc", "page", F.explode(shapes).alias("x")).select("doc", "page", "x.label", "x.found")
    totals = found.groupBy("doc", "label").agg(F.sum(F.size("found")).alias("total_matches"), F.count_if(F.size("found") > 0).alias("pages_with_matches"))
    words = found.select("doc", "label", F.explode("found").alias("code")).groupBy("doc", "label", "code").agg(F.count("*").alias("n"))
    best = top(words, ["doc", "label"], [F.desc("n"), F.col("code")], samples).groupBy("doc", "label").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "code"))), lambda x: x["code"]).alias("samples"))
    return totals.join(best, ["doc", "label"], "left").withColumn("samples", F.coalesce("samples", F.array().cast("array<string>")))


def recurring_words(pages: DataFrame, pattern: str, least_pages: int, share: float, n: int, stopwords: list[str] = v.CAPITAL_STOPWORDS) -> DataFrame:
    """(doc, word, page_count, rank): words of a pattern on at least ``least_pages`` pages and a ``share`` of them."""
    words = pages.select("doc", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?U){pattern}"), 0))).alias("word")).where(~F.col("word").isin(stopwords))
    counts = words.groupBy("doc", "word").agg(F.count("*").alias("page_count"))
    total = pages.groupBy("doc").agg(F.count("*").alias("pages"))
    kept = counts.join(total, "doc").where(F.col("page_count") >= F.greatest(F.lit(least_pages), F.floor(F.col("pages") * share)))
    return top(kept.drop("pages"), ["doc"], [F.desc("page_count"), F.col("word")], n)


def header_evidence(pages: DataFrame) -> DataFrame:
    """Capital words that recur on three tenths of the pages, twenty at most."""
    return recurring_words(pages, r"\b[A-Z]{2,20}\b", 2, 0.3, 20)


def campus_evidence(pages: DataFrame) -> DataFrame:
    """Short capital tokens on two or more pages, fifteen at most."""
    return recurring_words(pages, r"\b[A-Z]{2,4}\b", 2, 0.0, 15)


def rotation_evidence(pages: DataFrame) -> DataFrame:
    """Per document of ``pages(doc, page, n_chars, n_rotated)``: share of rotated characters, pages with any, and
    whether the headers are likely rotated (over one in a hundred)."""
    out = pages.groupBy("doc").agg(F.sum("n_chars").alias("total_chars"), F.sum("n_rotated").alias("rotated_chars"), F.count_if(F.col("n_rotated") > 0).alias("rotated_pages"), F.count("*").alias("pages"))
    return out.withColumn("ratio", F.coalesce(F.try_divide(F.col("rotated_chars").cast("double"), F.col("total_chars")), F.lit(0.0))).withColumn("likely_rotated_headers", F.col("ratio") > 0.01)


def repair_report(runs: DataFrame, code_pattern: str) -> DataFrame:
    """Per page of ``runs(doc, page, text)``: runs that still read backwards, and whether the page passes."""
    return runs.groupBy("doc", "page").agg(F.count_if(s.looks_reversed(F.col("text"), F.lit(code_pattern))).alias("reversed_runs"), F.count("*").alias("runs")).withColumn("passed", F.col("reversed_runs") == 0)


def image_coverage(images: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc, page, image_area_ratio) of ``sizes(doc, page, width, height)``: share of the page under ``images(doc,
    page, image_width, image_height)``, at most 1, 0 without images or area."""
    covered = images.groupBy("doc", "page").agg(F.sum(F.coalesce("image_width", F.lit(0.0)) * F.coalesce("image_height", F.lit(0.0))).alias("covered"))
    ratio = F.coalesce(F.try_divide(F.col("covered"), F.col("width") * F.col("height")), F.lit(0.0))
    return sizes.join(covered, ["doc", "page"], "left").select("doc", "page", F.least(F.lit(1.0), ratio).alias("image_area_ratio"))


def existing_pages(asked: DataFrame, documents: DataFrame) -> DataFrame:
    """``asked(doc, page)`` without pages outside their document of ``documents(doc, page_count)``."""
    return asked.join(documents.select("doc", "page_count"), "doc").where(F.col("page").between(1, F.col("page_count"))).drop("page_count")


def profile_evidence(pages: DataFrame, rotation: DataFrame) -> DataFrame:
    """One row per document with all evidence for a draft profile, ready to be written as JSON.

    ``pages(doc, page, text)`` are the sampled pages, ``rotation(doc, page, n_chars, n_rotated)`` their characters.
    """
    listed = lambda df, name, *columns: df.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
    out = pages.groupBy("doc").agg(F.sort_array(F.collect_list("page")).alias("pages_sampled"))
    out = out.join(listed(code_shape_evidence(pages), "code_patterns", "label", "total_matches", "pages_with_matches", "samples"), "doc", "left")
    out = out.join(listed(header_evidence(pages), "header_keywords", "rank", "word", "page_count"), "doc", "left")
    out = out.join(listed(campus_evidence(pages), "campus_tokens", "rank", "word", "page_count"), "doc", "left")
    return out.join(rotation_evidence(rotation).select("doc", F.struct("total_chars", "rotated_chars", "rotated_pages", "ratio", "likely_rotated_headers").alias("rotation")), "doc", "left")
