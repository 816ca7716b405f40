"""Writers: datasets as JSON, content-addressed files, discovery results and the cache of pages."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed_table import KeyedTable


def export_dataset(institutions: DataFrame, programmes: DataFrame, path: str) -> None:
    """Two JSON datasets below a folder; each scales with its table."""
    institutions.write.mode("overwrite").json(f"{path.rstrip('/')}/institutions")
    programmes.write.mode("overwrite").json(f"{path.rstrip('/')}/programmes")


def put_if_new(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``documents(key, sha256, …)`` that ``stored(key, sha256)`` lacks or holds with another hash."""
    return documents.join(stored.select("key", "sha256"), ["key", "sha256"], "left_anti")


def merge_table(batch: DataFrame, path: str, keys: list[str], order: str | None = None, stamp: str | None = None) -> DataFrame:
    """Upserts ``batch`` into the keyed table at ``path``, rewriting the buckets of its keys, and returns the table."""
    table = KeyedTable(batch.sparkSession, path)
    return table.read(table.merge(batch, keys, order, stamp))


def current_version(spark: SparkSession, path: str) -> int | None:
    """Number of the last complete version of the keyed table at ``path``, null without one."""
    return max(KeyedTable(spark, path).versions(), default=None)


def write_by_institution(df: DataFrame, path: str, run: str = "0") -> None:
    """Parquet laid out by institution and year, and within these by ``run``.

    The same run written again, by a caller's retry, replaces what it wrote in the partitions it writes to; rows of
    other runs stay. Readers of ``path`` see all runs, each row once.
    """
    placed = df.withColumn("run", F.lit(run))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("institution_id", "academic_year", "run").parquet(path)


def write_discovered(entries: DataFrame, path: str) -> None:
    """JSON per source and year; a source and year written again replaces its entries, and no others."""
    entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "academic_year").json(path)


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Writes each row of ``rows(path, content)`` as a file below ``root``, by tasks; gives path, sha256 and size.

    A file is written under ``root/_drafts`` and gets its name by a move, so readers see it whole, and a task that
    runs twice leaves one file. ``root`` must be on a file system that all executors reach. Nothing is written before
    the result is used.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        system.create_dir(f"{base}/_drafts", recursive=True)
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                draft = f"{base}/_drafts/{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(content)
                system.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                system.move(draft, f"{base}/{path}")
            yield pd.DataFrame({"path": frame["path"], "sha256": [hashlib.sha256(c).hexdigest() for c in frame["content"]], "size": [len(c) for c in frame["content"]]})

    return rows.select("path", F.col("content").cast("binary").alias("content")).mapInPandas(run, "path string, sha256 string, size long")


def download_manifest(documents: DataFrame) -> DataFrame:
    """(url, sha256, size, fetched_at) of ``documents(url, content)``; what isn't a PDF is left out."""
    return documents.where(is_pdf()).select("url", F.sha2("content", 256).alias("sha256"), F.length("content").alias("size"), F.current_timestamp().alias("fetched_at"))


def record_downloads(documents: DataFrame, table: str) -> DataFrame:
    """Puts the manifest of ``documents(url, content)`` into the keyed table at ``table`` and returns the table.

    A url whose contents are the same as before keeps the time at which they were first fetched; written twice, the
    manifest is as after once. Of repeated urls the one with the largest hash counts.
    """
    store = KeyedTable(documents.sparkSession, table)
    found = download_manifest(documents)
    if store.versions():
        found = found.join(store.read().select("url", "sha256"), ["url", "sha256"], "left_anti").select(found.columns)
    store.merge(found.withColumn("last", F.col("sha256")), ["url"], order="last")
    return store.read()


def is_pdf(content: str = "content"):
    """Whether bytes start as a PDF does."""
    return F.substring(F.col(content), 1, 5) == F.lit(b"%PDF-")


def store_markdown(pages: DataFrame, path: str) -> int:
    """Writes ``pages(doc, page, markdown)`` as text without detection tags, ``doc/page_NNNN.md`` each; how many."""
    from ..functions.scalars import remove_detections

    name = F.format_string("%s/page_%04d.md", F.col("doc"), F.col("page"))
    return write_files(pages.select(name.alias("path"), remove_detections(F.col("markdown")).alias("content")), path).agg(F.count("path")).first()[0]
