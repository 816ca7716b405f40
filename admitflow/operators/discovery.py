"""Discovery of documents: listing and detail pages as rows, names to institutions, coverage over years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import vocabulary as v

_ENTRY = ["source", "academic_year", "source_id", "display_name", "detail_url"]


def plain(html: Column) -> Column:
    """Text of a fragment: tags become spaces, the common entities their characters."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return s.strip(F.regexp_replace(text, r"\s+", " "))


def fragments(pages: DataFrame, pattern: str) -> DataFrame:
    """``pages`` with a row per match of ``pattern`` in html: ``position`` and ``fragment``."""
    return pages.select("*", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), 0)).alias("position", "fragment")).drop("html")


def card_listing(pages: DataFrame) -> DataFrame:
    """Entries of listings made of cards: a title and a link to a prospectus page; ``pages(source, academic_year, html)``.

    A card runs to the next one. The title loses its "Prospectus YEAR", and the link's last segment is the source_id.
    """
    cards = fragments(pages, r'(?s)<div[^>]*class="(?:[^"]* )?card(?: [^"]*)?".*?(?=<div[^>]*class="(?:[^"]* )?card(?: [^"]*)?"|$)')
    title = F.regexp_extract("fragment", r'(?s)<h5[^>]*class="[^"]*card-title[^"]*"[^>]*>(.*?)</h5>', 1)
    link = F.regexp_extract("fragment", r'<a[^>]*href="([^"]*/pdf-prospectus/[^"]*)"', 1)
    found = cards.withColumns({"title": title, "detail_url": link}).where("title <> '' and detail_url <> ''")
    return found.withColumns({"display_name": s.strip_year_suffix(plain(F.col("title")), F.col("academic_year")), "source_id": s.last_segment(F.col("detail_url"))}).select(*_ENTRY, "position")


def heading_listing(pages: DataFrame) -> DataFrame:
    """Entries of listings made of headings with a link; excluded slugs are left out."""
    heads = fragments(pages, r'(?s)<h2[^>]*class="[^"]*elementor-heading-title[^"]*"[^>]*>.*?</h2>')
    link = F.regexp_extract("fragment", r'''<a[^>]*href=["']([^"']*/prospectuses/[^"']*)["']''', 1)
    text = F.regexp_extract("fragment", r"""(?s)<a[^>]*href=["'][^"']*/prospectuses/[^"']*["'][^>]*>(.*?)</a>""", 1)
    found = heads.withColumns({"detail_url": link, "display_name": s.strip_suffix(plain(text))}).where("detail_url <> ''")
    found = found.withColumn("source_id", s.last_segment(F.col("detail_url")))
    return found.where(~F.col("source_id").isin(v.EXCLUDED_SLUGS)).select(*_ENTRY, "position")


def viewer_document(html: Column) -> Column:
    """URL that an embedded viewer shows, null unless it is a PDF."""
    url = F.replace(F.regexp_extract(html, r'(?s)location:\s*\{\s*url:\s*"([^"]+)"', 1), F.lit("\\/"), F.lit("/"))
    return F.when(F.endswith(F.lower(url), F.lit(".pdf")), url)


def download_document(html: Column, year: Column) -> Column:
    """URL of the first download link, null unless the page's title holds the year."""
    title = s.strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    tag = F.regexp_extract(html, r"(<a\b[^>]*\sdownload(?:[\s=>][^>]*)?>)", 1)
    href = F.regexp_extract(F.when(tag != "", tag), r'href="([^"]*)"', 1)
    return F.when(F.contains(title, year.cast("string")) & (href != ""), href)


#: Sources by name: how to list entries and how to find an entry's document in its page.
SOURCES = {
    "cards": (card_listing, lambda html, year: viewer_document(html)),
    "headings": (heading_listing, download_document),
}


def resolve_documents(entries: DataFrame, details: DataFrame, kind: str) -> DataFrame:
    """Entries with ``pdf_url`` from ``details(detail_url, html)``, null where none is found."""
    return entries.join(details, "detail_url", "left").withColumn("pdf_url", SOURCES[kind][1](F.col("html"), F.col("academic_year"))).drop("html")


def annotate(entries: DataFrame, names: DataFrame) -> DataFrame:
    """Entries with status and institution_id from ``names(variant, institution_id)``.

    Documents of several institutions are skipped first; other names are mapped only where listed.
    """
    low = s.squeeze(F.concat_ws(" ", "display_name", "source_id"))
    multi = F.coalesce(*[F.when(F.exists(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(low, p)), F.lit(key)) for key, patterns in v.MULTI_INSTITUTION.items()], F.lit(None).cast("string"))
    known = names.select(s.squeeze(F.col("variant")).alias("_name"), F.col("institution_id").alias("_id")).groupBy("_name").agg(F.max("_id").alias("_id"))
    out = entries.withColumns({"multi_institution_key": multi, "_name": s.squeeze(F.col("display_name"))}).join(known, "_name", "left")
    status = F.when(F.col("multi_institution_key").isNotNull(), "SKIPPED_MULTI_INSTITUTION").when(F.col("_id").isNull(), "UNMAPPED").otherwise("MAPPED")
    return out.withColumns({"status": status, "institution_id": F.when(status == "MAPPED", F.col("_id"))}).drop("_name", "_id")


def to_fetch(entries: DataFrame, institutions: list[str] | None = None) -> DataFrame:
    """Mapped entries, of the given institutions if any."""
    mapped = entries.where("status = 'MAPPED'")
    return mapped.where(F.col("institution_id").isin(institutions)) if institutions else mapped


def coverage(entries: DataFrame, institutions: DataFrame, year: int) -> DataFrame:
    """(institution_id, present): whether each known institution has an entry of the year."""
    have = entries.where((F.col("academic_year") == year) & F.col("institution_id").isNotNull()).select("institution_id", F.lit(True).alias("present")).distinct()
    return institutions.select(F.col("id").alias("institution_id")).join(have, "institution_id", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def historical_coverage(entries: DataFrame, institutions: DataFrame, year: int, back: int = 4) -> DataFrame:
    """(institution_id, years) of the institutions missing in a year: the earlier years that have them, latest first."""
    missing = coverage(entries, institutions, year).where("not present").select("institution_id")
    earlier = entries.where(F.col("academic_year").between(year - back, year - 1)).select("institution_id", "academic_year").distinct()
    return missing.join(earlier, "institution_id", "left").groupBy("institution_id").agg(F.sort_array(F.collect_list("academic_year"), asc=False).alias("years"))


def with_profile(documents: DataFrame, profiles: DataFrame, default: str) -> DataFrame:
    """Documents with the profile (JSON text) of their institution, the default one otherwise."""
    return documents.join(profiles.select("institution_id", "profile"), "institution_id", "left").withColumn("profile", F.coalesce("profile", F.lit(default)))
