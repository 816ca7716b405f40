"""Readers of the domain's files and tables; every schema is explicit."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.refdata import with_defaults


def seed_programmes(spark: SparkSession, path: str) -> DataFrame:
    """Programme files one folder down, as ``schemas.PROGRAMMES`` with source_file and ordinal (by path, then place).

    Each file holds an array of programmes. Rule trees stay JSON text.
    """
    files = spark.read.format("text").option("wholetext", True).load(f"{path.rstrip('/')}/*/*.json").select("value", F.col("_metadata.file_path").alias("source_file"))
    each = files.select("source_file", F.posexplode(F.from_json("value", "array<string>")).alias("place", "body"))
    return _programmes(each, ["source_file", "place"])


def _programmes(each: DataFrame, order: list[str]) -> DataFrame:
    body = "institution_id string, academic_year int, qualification_code string, name string, faculty string, campus array<string>, duration_years double, extended boolean, selection_notes array<string>, career_text string, source_doc string, source_page int, confidence string"
    nsc = f"struct<score:{schemas.THRESHOLDS},excluded_subjects:array<string>>"
    parsed = each.select(*order, F.from_json("body", body).alias("p"), F.from_json(F.get_json_object("body", "$.requirements.nsc"), nsc).alias("n"), F.get_json_object("body", "$.requirements.nsc.subjects").alias("subjects"))
    flat = parsed.select("p.*", F.col("n.score").alias("score"), "subjects", F.col("n.excluded_subjects").alias("excluded_subjects"), *order)
    return with_defaults(flat).withColumn("ordinal", F.struct(*order))


def institutions(spark: SparkSession, path: str) -> DataFrame:
    """The institutions dimension: a file with one array."""
    return spark.read.schema(schemas.INSTITUTIONS).option("multiLine", True).json(path)


def exported(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(institutions, programmes) of an exported dataset: one object with two arrays; malformed files fail."""
    shape = f"institutions array<struct<{_struct(schemas.INSTITUTIONS)}>>, programmes array<string>"
    whole = spark.read.schema(shape).option("multiLine", True).option("mode", "FAILFAST").json(path)
    programmes = whole.select(F.posexplode("programmes").alias("place", "body"))
    return whole.select(F.inline("institutions")), _programmes(programmes, ["place"])


def _struct(ddl: str) -> str:
    return ",".join(":".join(f.strip().split(" ", 1)) for f in ddl.split(","))


def scan_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, key, value, error) of files that hold one JSON object each: a row per entry, value as a variant.

    A file that doesn't parse, or holds something else, is a row with an error and doesn't stop the others.
    """
    text = spark.read.format("text").option("wholetext", True).load(path).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("whole"))
    kind = F.schema_of_variant("whole")
    wrong = F.when(F.col("whole").isNull(), "not JSON").when(~kind.startswith("OBJECT"), F.concat(F.lit("not an object but "), F.lower(F.regexp_extract(kind, r"^\w+", 0))))
    text = text.withColumn("error", wrong)
    spark_view = text.where("error is null")
    entries = spark_view.lateralJoin(spark.tvf.variant_explode(F.col("whole").outer())).select("file", "key", "value", F.lit(None).cast("string").alias("error"))
    return entries.unionByName(text.where("error is not null").select("file", "error"), allowMissingColumns=True)


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """(institution_id, profile) of registry files, objects of profiles by institution; profile is JSON text."""
    return scan_objects(spark, path).where("error is null").select(F.col("key").alias("institution_id"), F.to_json("value").alias("profile"))


def profile_scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(profiles without problems, problems) of registry files, each problem with its file and institution."""
    from ..operators.refdata import profile_problems

    entries = scan_objects(spark, path)
    found = entries.where("error is null").select("file", F.col("key").alias("institution_id"), F.to_json("value").alias("profile"))
    problems = profile_problems(found).join(found.select("file", "institution_id"), "institution_id").select("file", "institution_id", "problem")
    broken = entries.where("error is not null").select("file", F.lit(None).cast("string").alias("institution_id"), F.col("error").alias("problem"))
    return found.join(problems.select("institution_id"), "institution_id", "left_anti").select("institution_id", "profile"), problems.unionByName(broken)


def checked_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(institution_id, profile) of registry files; fails where a profile or a file has a problem, with the first 100."""
    good, problems = profile_scan(spark, path)
    told = problems.orderBy("institution_id", "problem").limit(100).collect()
    if told:
        raise ValueError("; ".join(f"{r.institution_id or r.file}: {r.problem}" for r in told))
    return good


#: What a programme of an exported dataset must have, and of what kind.
_EXPORTED = {"institution_id": "STRING", "academic_year": "BIGINT", "qualification_code": "STRING", "name": "STRING", "requirements": "OBJECT"}


def scan_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(programmes with defaults, errors) of exported datasets, as ``exported`` but with errors as rows.

    A programme that lacks a key or has it of another kind is an error of its file and place; the others are read.
    """
    entries = scan_objects(spark, path)
    listed = entries.where("error is null and key = 'programmes'")
    kind = F.schema_of_variant("value")
    no_list = listed.where(~kind.startswith("ARRAY")).select("file", F.lit("programmes is no array").alias("error"))
    items = listed.where(kind.startswith("ARRAY")).select("file", "value").withColumnRenamed("value", "list")
    items = items.lateralJoin(spark.tvf.variant_explode(F.col("list").outer())).select("file", F.col("pos").alias("place"), F.col("value").alias("item"))
    at = lambda k: F.schema_of_variant(F.try_variant_get("item", f"$.{k}", "variant"))
    # A key that is absent gives no variant and null; one that is null gives VOID.
    wrong = [F.when(at(k).isNull(), F.lit(f"missing {k}")).when(~at(k).startswith(want), F.concat(F.lit(f"{k} is "), F.lower(F.regexp_extract(at(k), r"^\w+", 0)))) for k, want in _EXPORTED.items()]
    shape = F.when(F.schema_of_variant("item").startswith("OBJECT"), F.array_compact(F.array(*wrong))).otherwise(F.array(F.lit("not an object")))
    items = items.withColumn("wrong", shape)
    good = items.where("size(wrong) = 0").select("file", "place", F.to_json("item").alias("body"))
    errors = items.select("file", F.explode("wrong").alias("e"), "place").select("file", F.concat(F.lit("programmes["), F.col("place").cast("string"), F.lit("]: "), F.col("e")).alias("error"))
    return _programmes(good, ["file", "place"]), errors.unionByName(no_list).unionByName(entries.where("error is not null").select("file", "error"))


#: Files of a folder that are passed on at a time.
_LISTED = 10_000


@lru_cache
def _store(uri: str) -> tuple:
    """(Arrow's file system of a URI or local path, the path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def found_files(spark: SparkSession, root: str, hidden: bool = False) -> DataFrame:
    """(path, name, at, length, modificationTime) of all files below a folder: ``name`` is the path from there, ``at`` that
    which ``content`` reads.

    Folders are listed by tasks, level by level, and files go to tables in between, so the driver knows no file; a task
    lists one folder at a time. What starts with _ or . is left out unless ``hidden``. ``root`` must be on a file system
    that Arrow knows and all executors reach.
    """
    from .scratch import kept

    root = root.rstrip("/")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = _store(root)
        start = root.removesuffix(base) if root.endswith(base) else root.split("://")[0] + "://"
        for at in (x for frame in frames for x in frame["at"]):
            infos = system.get_file_info(fs.FileSelector(at or base))
            for k in range(0, len(infos), _LISTED):
                part = [i for i in infos[k : k + _LISTED] if hidden or not i.base_name.startswith(("_", "."))]
                yield pd.DataFrame(
                    {
                        "path": [start + i.path for i in part], "name": [i.path[len(base) :].lstrip("/") for i in part], "at": [i.path for i in part],
                        "length": [i.size or 0 for i in part], "modificationTime": pd.to_datetime([i.mtime for i in part], utc=True), "folder": [i.type == fs.FileType.Directory for i in part],
                    }
                )

    level, levels = spark.createDataFrame([("",)], "at string"), []
    while not levels or not level.isEmpty():
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        levels.append(kept(level.repartition(tasks, "at").mapInPandas(run, "path string, name string, at string, length long, modificationTime timestamp, folder boolean")))
        level = levels[-1].where("folder").select("at")
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.where("not folder").drop("folder")


def content(root: str, at: Column) -> Column:
    """Bytes of files that ``found_files`` found below ``root``; not read where a caller doesn't select them."""

    def read(place: str) -> bytes:
        with _store(root)[0].open_input_stream(place) as f:
            return f.read()

    # Not by Arrow, whose batches hold thousands of files.
    return F.udf(read, "binary", useArrow=False)(at)


def inbox(spark: SparkSession, path: str) -> DataFrame:
    """Binary documents anywhere below a folder: path, length, modificationTime, content."""
    found = found_files(spark, path).where(F.col("name").endswith(".pdf")).repartition(spark.sparkContext.defaultParallelism)
    return found.select("path", "modificationTime", "length", content(path, F.col("at")).alias("content"))


def ocr_pages(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, markdown) of a cache of pages: ``doc/page_NNNN.md``."""
    found = found_files(spark, path, hidden=True).where(F.col("name").rlike(r"^[^/]+/page_[^/]*\.md$")).repartition(spark.sparkContext.defaultParallelism)
    name = F.col("name")
    return found.select(F.regexp_extract(name, r"([^/]+)/page_\d+\.md$", 1).alias("doc"), F.regexp_extract(name, r"page_(\d+)\.md$", 1).cast("int").alias("page"), content(path, F.col("at")).cast("string").alias("markdown"))


def split_cached(pages: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages with markdown, pages without) of ``pages(doc, page)``: the rest goes to the text-layer method."""
    keys = ["doc", "page"]
    return pages.join(cache, keys), pages.join(cache.select(*keys), keys, "left_anti")


def model_responses(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, model, body) of responses kept as JSON lines."""
    return spark.read.schema("doc string, page int, model string, body string").json(path)


def discovered(spark: SparkSession, path: str) -> DataFrame:
    """Entries of discovery results: files with an ``entries`` array."""
    entry = "struct<source:string,academic_year:int,source_id:string,display_name:string,detail_url:string,institution_id:string,status:string>"
    return spark.read.schema(f"entries array<{entry}>").option("multiLine", True).json(path).select(F.inline("entries"))
