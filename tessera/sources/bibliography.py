"""Bibliographic records: pages fetched by a Spark data source, parsed from JSON and XML, with metadata by fallback."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.functions.text import blank_to_null, normalize_doi, normalize_pmcid

# Attempts, first wait in seconds and the answers worth another attempt.
ATTEMPTS, FIRST_WAIT = 5, 1.0
AGAIN = (429, 500, 502, 503, 504)


def wait_before(attempt: int, retry_after: str | None, first: float = FIRST_WAIT) -> float:
    """Doubling waits; what the server asks for is the least."""
    asked = float(retry_after) if retry_after and retry_after.strip().isdigit() else 0.0
    return max(first * 2**attempt, asked)


def fetched(url: str, attempts: int = ATTEMPTS, first_wait: float = FIRST_WAIT) -> str:
    for attempt in range(attempts):
        try:
            with urllib.request.urlopen(url, timeout=60) as answer:
                return answer.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            if e.code not in AGAIN or attempt == attempts - 1:
                raise
            time.sleep(wait_before(attempt, e.headers.get("Retry-After"), first_wait))
        except urllib.error.URLError:
            if attempt == attempts - 1:
                raise
            time.sleep(wait_before(attempt, None, first_wait))
    raise ValueError("no attempt was allowed")


class Page(InputPartition):
    def __init__(self, number: int, url: str):
        self.number, self.url = number, url


class PagedRecords(DataSource):
    """``paged_records``: a row (page, url, body) for each page of a search, a partition each.

    Options: ``url`` with ``{start}`` and ``{size}``, ``size``, ``cap`` (records at most) and ``first_wait``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def schema(self) -> str:
        return "page int, url string, body string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        size, cap = int(self.options.get("size", 25)), int(self.options.get("cap", 100))
        return [Page(k, self.options["url"].format(start=at, size=min(size, cap - at))) for k, at in enumerate(range(0, cap, size))]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield partition.number, partition.url, fetched(partition.url, first_wait=float(self.options.get("first_wait", FIRST_WAIT)))


def read_pages(spark: SparkSession, **options) -> DataFrame:
    spark.dataSource.register(PagedRecords)
    return spark.read.format("paged_records").options(**options).load()


RESULTS = "struct<resultList: struct<result: array<struct<pmid: string, pmcid: string, doi: string, title: string, pubYear: string, source: string, id: string>>>>"


def json_records(pages: DataFrame, body: str = "body") -> DataFrame:
    """Records of JSON pages with normalised ids; the link goes by the best id that a record has."""
    each = pages.select(*(c for c in pages.columns if c != body), F.posexplode(F.from_json(body, RESULTS).getField("resultList").getField("result")).alias("place", "r"))
    ids = each.select(*(c for c in pages.columns if c != body), "place", "r.*").withColumns({"pmid": blank_to_null(F.trim("pmid")), "pmcid": normalize_pmcid(F.col("pmcid")), "doi": normalize_doi(F.col("doi"))})
    link = F.when(F.col("pmcid").isNotNull(), F.concat(F.lit("pmcid:"), "pmcid")).when(F.col("pmid").isNotNull(), F.concat(F.lit("pmid:"), "pmid")).when(F.col("doi").isNotNull(), F.concat(F.lit("doi:"), "doi"))
    return ids.withColumn("link", link)


ARTICLE = "pmid string, title string, abstract string, year string, medline_date string, types struct<type: array<string>>, journal string"


def article_metadata(spark: SparkSession, path: str, row_tag: str = "article") -> DataFrame:
    """Metadata of article records; the year comes from its own element, else from the first four digits of a free date."""
    raw = spark.read.format("xml").option("rowTag", row_tag).schema(ARTICLE).load(path)
    year = F.coalesce(F.regexp_extract("year", r"^\s*(\d{4})\s*$", 1).try_cast("int"), F.regexp_extract("medline_date", r"\b(\d{4})\b", 1).try_cast("int"))
    return raw.select("pmid", F.trim("title").alias("title"), "abstract", year.alias("year"), F.array_join("types.type", "; ").alias("types"), "journal")


def enriched(records: DataFrame, first: DataFrame, second: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields from the first source, else from the second, and which one had the record."""
    a = first.select(key, F.lit(True).alias("__a"), *(F.col(f).alias(f"__a_{f}") for f in fields))
    b = second.select(key, F.lit(True).alias("__b"), *(F.col(f).alias(f"__b_{f}") for f in fields))
    both = records.join(a, key, "left").join(b, key, "left")
    origin = F.when(F.col("__a"), "first").when(F.col("__b"), "second").otherwise("none")
    return both.select(*records.columns, *(F.coalesce(f"__a_{f}", f"__b_{f}").alias(f) for f in fields), origin.alias("origin"))
