"""Raw adverts and search listings."""

from __future__ import annotations

import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.html import LEAST_PAGE, result_links, split_job_url

STEM = r"([^/]+?)(\.[^./]*)?$"


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """jobid (the file's stem), filename, html of every file of a folder."""
    files = spark.read.text(folder, wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_path", STEM, 1).alias("jobid"), F.col("_metadata.file_path").alias("filename"), F.col("value").alias("html"))


def pages_from(df: DataFrame, jobid: str, html: str) -> DataFrame:
    return df.select(F.col(jobid).cast("string").alias("jobid"), F.lit(None).cast("string").alias("filename"), F.col(html).alias("html"))


def fetch(url: str, timeout: float = 30) -> str:
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
        return answer.read().decode("utf-8", "replace")


class _PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.size = options.get("pageSize")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        url = partition.value
        if self.size and "pageSize=" not in url:
            url += ("&" if "?" in url else "?") + f"pageSize={self.size}"
        yield url, fetch(url)


class WebPages(DataSource):
    """format("webpages"): option urls (one a line; http, https or file), option pageSize for search listings; a partition each."""

    @classmethod
    def name(cls) -> str:
        return "webpages"

    def schema(self) -> str:
        return "url string, html string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _PageReader(self.options)


def read_web(spark: SparkSession, urls: list[str], page_size: int | None = None) -> DataFrame:
    spark.dataSource.register(WebPages)
    reader = spark.read.format("webpages").option("urls", "\n".join(urls))
    return (reader.option("pageSize", page_size) if page_size else reader).load()


def listed_jobs(listings: DataFrame, base: str, html: str = "html") -> DataFrame:
    """jobid, name, url of every search hit whose link has the known shape."""
    links = listings.select(F.explode(result_links(html)).alias("link"))
    return links.select(split_job_url(base, "link").alias("j")).where("j is not null").select("j.*").dropDuplicates(["jobid"])


def not_downloaded(listed: DataFrame, have: DataFrame) -> DataFrame:
    return listed.join(have.select("jobid"), "jobid", "left_anti")


def long_enough(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages worth recording, and the quarantined rest."""
    ok = F.coalesce(F.length("html") > LEAST_PAGE, F.lit(False))
    return pages.where(ok), pages.where(~ok)


def write_pages(pages: DataFrame, folder: str) -> None:
    """Parquet of jobid and html; a file per page would not scale, and read_stored reads it back."""
    long_enough(pages)[0].select("jobid", "html").write.mode("append").parquet(folder)


def read_stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("jobid string, html string").parquet(folder)
