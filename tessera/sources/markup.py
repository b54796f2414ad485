"""Markup sources: links and headings of HTML pages by column functions, article blocks of XML, cells of tables."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import collapsed, url_host

# What a link's label or file name says about it, first match first.
LINK_RULES = {
    "patent": r"\bpatents?\b",
    "protocol": r"\bprotocols?\b",
    "dataset": r"\b(dataset|data set|repository|accession)s?\b",
    "supplement": r"\b(supplement(ary|al)?|supporting information|appendix)\b",
}


def links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, place, href, label, kind): every anchor, in page order."""
    found = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r'(<a\s[^>]*href="[^"]*"[^>]*>[^<]*)'), 1)
    each = pages.select(id_col, F.posexplode(found).alias("place", "tag"))
    parts = each.select(id_col, "place", F.regexp_extract("tag", r'href="([^"]*)"', 1).alias("href"), collapsed(F.regexp_extract("tag", r">([^<]*)$", 1)).alias("label"))
    kind = F.lit("other")
    for name, pattern in reversed(LINK_RULES.items()):
        kind = F.when(F.concat_ws(" ", "label", "href").rlike(f"(?i){pattern}"), name).otherwise(kind)
    return parts.withColumn("kind", kind)


def distinct_links(found: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per (id, kind, href), the last of the page."""
    return found.groupBy(id_col, "kind", "href").agg(F.max_by("label", "place").alias("label"), F.max("place").alias("place"))


def headed_blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, place, tag, heading, text): headings and paragraphs, each with the last heading before it."""
    found = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r"(?is)<(?:h[1-6]|p|li)\b[^>]*>((?:(?!<(?:h[1-6]|p|li|/p|/li|/h[1-6])\b).)*)"), 0)
    each = pages.select(id_col, F.posexplode(found).alias("place", "raw"))
    tag = F.lower(F.regexp_extract("raw", r"^<([a-zA-Z0-9]+)", 1))
    text = collapsed(F.regexp_replace(F.regexp_replace("raw", r"^<[^>]*>", ""), r"<[^>]*>", " "))
    blocks = each.select(id_col, "place", tag.alias("tag"), text.alias("text")).where(F.length("text") > 0)
    w = Window.partitionBy(id_col).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("heading", F.last(F.when(F.col("tag").rlike("^h[1-6]$"), F.col("text")), ignorenulls=True).over(w))


def article_blocks(files: DataFrame, id_col: str = "path", content_col: str = "content") -> DataFrame:
    """(id, place, section_path, block_type, element_id, text) of article XML: paragraphs, tables and captions in order.

    An element id counts once. A document that is no XML gives one row of type ``error``.
    """
    kinds = {"p": "paragraph", "table-wrap": "table", "fig": "caption"}

    def walk(node: ET.Element, path: list[str], seen: set, out: list) -> None:
        for child in node:
            tag = child.tag.rsplit("}", 1)[-1]
            if tag == "sec":
                title = child.find("./{*}title")
                walk(child, [*path, " ".join("".join(title.itertext()).split())] if title is not None else path, seen, out)
            elif tag in kinds:
                name, text = child.get("id"), " ".join("".join(child.itertext()).split())
                if text and (name is None or name not in seen):
                    seen.add(name)
                    out.append((" > ".join(path), kinds[tag], name, text))
            else:
                walk(child, path, seen, out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("place", pa.int32()), ("section_path", pa.string()), ("block_type", pa.string()), ("element_id", pa.string()), ("text", pa.string())])
        for batch in batches:
            rows = []
            for name, content in zip(batch.column("id").to_pylist(), batch.column("content").to_pylist(), strict=True):
                out: list = []
                try:
                    walk(ET.fromstring(content or ""), [], set(), out)
                except ET.ParseError as e:
                    out = [("", "error", None, str(e))]
                rows += [{"id": name, "place": k, "section_path": s, "block_type": b, "element_id": i, "text": t} for k, (s, b, i, t) in enumerate(out)]
            yield pa.RecordBatch.from_pylist(rows, schema)

    slim = files.select(F.col(id_col).cast("string").alias("id"), F.col(content_col).cast("string").alias("content"))
    return slim.mapInArrow(read, "id string, place int, section_path string, block_type string, element_id string, text string")


def table_rows(cells: DataFrame, table: str, row: str, column: str, text: str) -> DataFrame:
    """Rows of a table as text, cells joined by a bar."""
    own = F.array_sort(F.collect_list(F.struct(F.col(column).alias("c"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return cells.groupBy(table, row).agg(F.array_join(F.transform(own, lambda x: x["t"]), " | ").alias("line"))


def headed_cells(cells: DataFrame, table: str, row: str, column: str, text: str, is_row_header: str, is_column_header: str) -> DataFrame:
    """Data cells with the headers of their row and of their column, joined in order."""
    joined = lambda key, order, flag, name: cells.where(flag).groupBy(table, key).agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), " / ").alias(name))
    data = cells.where(~F.col(is_row_header) & ~F.col(is_column_header))
    return data.join(joined(row, column, is_row_header, "row_header"), [table, row], "left").join(joined(column, row, is_column_header, "column_header"), [table, column], "left")


def hosts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    return pages.groupBy(url_host(F.col(url_col)).alias("host")).agg(F.count("*").alias("n"))
