"""Searches with state: an id search with server-side history and then its pages, or pages behind a cursor; both resume from a cache.

The cache is a Parquet folder of pages: request, answer, hash. Each page that is missing is a task's work and its file is in place as
soon as the task is done, so a run that dies fetches none of them again. Pages that failed are kept with their error and asked for
again by the next run; the other searches go on.
"""

from __future__ import annotations

import hashlib
import urllib.error
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import names_in, written
from tessera.sources.bibliography import ATTEMPTS, FIRST_WAIT, fetched

PAGES = "search string, page int, url string, body string, sha256 string, error string"
#: Number of the id search among a search's pages.
ID_SEARCH = -1


class CursorMismatch(ValueError):
    """A cached page was asked for with another cursor than the page before it names."""


def filled(template: str, **values: Column) -> Column:
    """A URL from a template with ``{name}`` for each value, encoded."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.url_encode(value.cast("string")))
    return out


def cached(spark: SparkSession, cache: str) -> DataFrame:
    """The pages of a cache: the whole ones, once each; a page whose text is not that of its hash counts as missing."""
    if not any(x.endswith(".parquet") for x in names_in(spark, cache)):
        return spark.createDataFrame([], PAGES)
    rows = spark.read.schema(PAGES).parquet(cache).where(F.col("error").isNull() & (F.col("sha256") == F.sha2("body", 256)))
    return rows.dropDuplicates(["search", "page", "url"])


def failures(spark: SparkSession, cache: str) -> DataFrame:
    """(search, page, error) of pages that have failed and not been fetched since."""
    if not any(x.endswith(".parquet") for x in names_in(spark, cache)):
        return spark.createDataFrame([], "search string, page int, error string")
    rows = spark.read.schema(PAGES).parquet(cache).where("error is not null")
    return rows.join(cached(spark, cache).select("search", "page", "url"), ["search", "page", "url"], "left_anti").groupBy("search", "page").agg(F.max("error").alias("error"))


def fetch(requests: DataFrame, cache: str, attempts: int = ATTEMPTS, first_wait: float = FIRST_WAIT) -> DataFrame:
    """The pages of ``requests`` (search, page, url) that the cache has after those that it lacks have been fetched, a task each."""
    spark = requests.sparkSession

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                body = error = None
                try:
                    body = fetched(row["url"], attempts, first_wait)
                except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                    error = f"{type(e).__name__}: {e}"
                sha = hashlib.sha256(body.encode()).hexdigest() if body is not None else None
                yield pa.RecordBatch.from_pylist([row | {"body": body, "sha256": sha, "error": error}], pa.schema([("search", pa.string()), ("page", pa.int32()), ("url", pa.string()), ("body", pa.string()), ("sha256", pa.string()), ("error", pa.string())]))

    wanted = requests.select("search", F.col("page").cast("int").alias("page"), "url").distinct()
    missing = wanted.join(cached(spark, cache).select("search", "page", "url"), ["search", "page", "url"], "left_anti")
    count = missing.count()
    if count:
        # version 2: a task's file is moved to its place when the task ends, not when the job does
        dealt = missing.repartition(count).mapInArrow(ask, PAGES)
        dealt.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(cache)
    return cached(spark, cache).join(wanted, ["search", "page", "url"], "left_semi")


def records() -> Column:
    """How many records a page has."""
    return F.coalesce(F.json_array_length(F.get_json_object("body", "$.resultList.result")), F.lit(0))


def history_search(searches: DataFrame, cache: str, search_url: str, page_url: str, size: int, cap: int, **tries) -> DataFrame:
    """(search, page, start, records, total, body): each search (search, term) asks for its ids once and then for pages of what the server remembers.

    ``search_url`` has ``{term}`` and ``{cap}``, ``page_url`` ``{history}``, ``{key}``, ``{start}`` and ``{size}``. A search without hits has no pages. What failed is in ``failures``.
    """
    first = searches.select("search", F.lit(ID_SEARCH).alias("page"), filled(search_url, term=F.col("term"), cap=F.lit(cap)).alias("url"))
    told = fetch(first, cache, **tries)
    path = lambda name: F.get_json_object("body", f"$.esearchresult.{name}")
    total = path("count").try_cast("int")
    found = told.select("search", path("webenv").alias("history"), path("querykey").alias("key"), F.coalesce(total, F.lit(0)).alias("total"))
    last = F.least("total", F.lit(cap)) - 1
    starts = found.where("total > 0").withColumn("start", F.explode(F.sequence(F.lit(0), last, F.lit(size))))
    here = F.least(F.lit(size), F.least("total", F.lit(cap)) - F.col("start"))
    asked = starts.withColumn("records", here).withColumn("page", F.floor(F.col("start") / size).cast("int"))
    asked = asked.withColumn("url", filled(page_url, history=F.col("history"), key=F.col("key"), start=F.col("start"), size=F.col("records")))
    # written, as Spark takes two readings of one folder for equal and would not see what has been added in between
    asked = written(asked, "history-pages")
    pages = fetch(asked.select("search", "page", "url"), cache, **tries)
    return asked.join(pages, ["search", "page", "url"]).select("search", "page", "start", "records", "total", "body")


def cursor_search(searches: DataFrame, cache: str, url: str, size: int, cap: int, first: str = "*", **tries) -> DataFrame:
    """(search, page, cursor, records, body): each search (search, term) follows the cursor that its last page names, all searches beside each other.

    ``url`` has ``{term}``, ``{cursor}`` and ``{size}``. A search ends with ``cap`` records, an empty page, no cursor or one that repeats. What is cached is followed, not
    fetched; a cached page that was asked for with another cursor is an error. A search whose page fails stays where it is.
    """
    spark = searches.sparkSession
    open_ = searches.select("search", "term", F.lit(0).alias("page"), F.lit(first).alias("cursor"), F.lit(0).alias("seen"))
    trail = None
    while True:
        left = F.least(F.lit(size), F.lit(cap) - F.col("seen"))
        # this round's requests, one a search; written, as Spark takes two readings of one folder for equal
        asked = written(open_.where(F.col("seen") < cap).withColumn("url", filled(url, term=F.col("term"), cursor=F.col("cursor"), size=left)), "cursor-round")
        if asked.isEmpty():
            break
        other = cached(spark, cache).withColumnRenamed("url", "was").join(asked, ["search", "page"]).where("was <> url and page > 0").select("search", "page", "cursor").first()
        if other:
            raise CursorMismatch(f"page {other['page']} of {other['search']} is cached for another cursor than {other['cursor']}")
        got = asked.join(fetch(asked, cache, **tries), ["search", "page", "url"]).withColumn("records", records())
        trail = asked if trail is None else trail.unionByName(asked)
        following = F.get_json_object("body", "$.nextCursorMark")
        on = got.withColumn("next", following).where((F.col("records") > 0) & F.col("next").isNotNull() & (F.col("next") != F.col("cursor")))
        open_ = on.select("search", "term", (F.col("page") + 1).alias("page"), F.col("next").alias("cursor"), (F.col("seen") + F.col("records")).alias("seen"))
    if trail is None:
        return spark.createDataFrame([], "search string, page int, cursor string, records int, body string")
    return trail.join(cached(spark, cache), ["search", "page", "url"]).select("search", "page", "cursor", records().alias("records"), "body")
