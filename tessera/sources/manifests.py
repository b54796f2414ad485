"""Manifests and gates: query manifests, full-text validity with ordered sources, typed lanes, schema strictness, new databases."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ElementTree
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ManifestError(ValueError):
    """A manifest that lacks something or names something twice."""


def query_manifest(spark: SparkSession, text: str, strata: Sequence[str]) -> DataFrame:
    """(stratum, query_id, query) of a JSON manifest ``{"strata": {name: {"synonyms": [...], "queries": {id: [terms]}}}}``.

    Each query is its terms and the stratum's synonyms, each a group of alternatives: ``("a" OR "b") AND ("c")``. All
    strata are to be there with synonyms and queries, and ids are unique.
    """
    found = json.loads(text).get("strata", {})
    if set(found) != set(strata):
        raise ManifestError(f"strata {sorted(found)} for {sorted(strata)}")
    quoted = lambda terms: "(" + " OR ".join(f'"{x}"' for x in terms) + ")"
    rows, seen = [], set()
    for name, own in found.items():
        if not own.get("synonyms") or not own.get("queries"):
            raise ManifestError(f"{name} has no synonyms or no queries")
        for query_id, terms in own["queries"].items():
            if query_id in seen or not terms:
                raise ManifestError(f"{query_id} is empty or not unique")
            seen.add(query_id)
            rows.append((name, query_id, " AND ".join([quoted(own["synonyms"]), quoted(terms)])))
    return spark.createDataFrame(rows, "stratum string, query_id string, query string")


def full_text_states(df: DataFrame, keys: Sequence[str], xml_col: str) -> DataFrame:
    """(keys, state) of XML texts: valid, no_article, no_body or not_xml (null and empty ones too)."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def state(text: str | None) -> str:
        try:
            root = ElementTree.fromstring(text or "")
        except ElementTree.ParseError:
            return "not_xml"
        local = lambda e: e.tag.rsplit("}", 1)[-1]
        article = next((e for e in root.iter() if local(e) == "article"), None)
        return "no_article" if article is None else "valid" if any(local(e) == "body" for e in article.iter()) else "no_body"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = pa.array([state(x) for x in batch.column(len(keys)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keys))), states], names=[*keys, "state"])

    return df.select(*keys, F.col(xml_col).cast("string").alias("__xml")).mapInArrow(read, f"{kinds}, state string")


def first_valid_source(states: DataFrame, key: str, rank: str) -> DataFrame:
    """(key, rank, state): the first source in order whose text is valid, or else the first source and what is wrong with it."""
    per = states.groupBy(key).agg(F.min(F.when(F.col("state") == "valid", F.col(rank))).alias("__good"), F.min(rank).alias("__first"), F.min_by("state", rank).alias("__state"))
    good = F.col("__good").isNotNull()
    return per.select(key, F.coalesce("__good", "__first").alias(rank), F.when(good, "valid").otherwise(F.col("__state")).alias("state"))


def typed_lane(spark: SparkSession, path: str, schema: str, required: Sequence[str]) -> DataFrame:
    """Entries of a lane's JSON lines; a line that is no JSON or of another type fails the read, and so does one without a required field."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for c in required:
        df = df.withColumn(c, F.coalesce(c, F.raise_error(F.lit(f"{c} is missing"))))
    return df


def strictness_issues(schema: Mapping, path: str = "$") -> list[str]:
    """Where a JSON schema is not strict: objects that allow other fields or do not require all of theirs, arrays without items, at any depth."""
    issues = []
    kinds = schema.get("type")
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if "object" in kinds or "properties" in schema:
        own = schema.get("properties", {})
        if schema.get("additionalProperties") is not False:
            issues.append(f"{path}: other fields are allowed")
        left = sorted(set(own) - set(schema.get("required", [])))
        issues += [f"{path}.{name}: not required" for name in left]
        for name, part in own.items():
            issues += strictness_issues(part, f"{path}.{name}")
    if "array" in kinds:
        issues += strictness_issues(schema["items"], f"{path}[]") if "items" in schema else [f"{path}: items are not described"]
    for word in ("anyOf", "oneOf", "allOf"):
        for k, part in enumerate(schema.get(word, [])):
            issues += strictness_issues(part, f"{path}/{word}{k}")
    for name, part in schema.get("$defs", {}).items():
        issues += strictness_issues(part, f"#{name}")
    return issues


def new_database(spark: SparkSession, path: str, tables: Mapping[str, str]) -> None:
    """An empty table for each name and schema below ``path``; an existing one is never overwritten."""
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(f"{path}/{name}")


def flagged_rows(rows: DataFrame, flag: str, id_col: str, owner: str, prefix_length: int) -> DataFrame:
    """Rows whose flag says yes in any usual spelling, with the owner that their id's prefix names."""
    yes = F.lower(F.trim(F.col(flag).cast("string"))).isin("true", "1", "yes", "y")
    return rows.where(F.coalesce(yes, F.lit(False))).withColumn(owner, F.substring(F.col(id_col).cast("string"), 1, prefix_length))


def scanned_artifacts(files: DataFrame, allowed: Sequence[str], denied: Sequence[str], paper_pattern: str) -> DataFrame:
    """Files (path, sha256) with ``paper`` from their path and ``state``: denied, other_kind, no_paper, duplicate (of an earlier path's content) or kept."""
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    paper = F.regexp_extract("path", paper_pattern, 1)
    bad = F.exists(F.array(*map(F.lit, denied)), lambda d: F.col("path").contains(d)) if denied else F.lit(False)
    state = F.when(bad, "denied").when(~ending.isin(*allowed), "other_kind").when(paper == "", "no_paper")
    rated = files.select("path", "sha256", paper.alias("paper"), state.alias("state"))
    firsts = rated.where("state is null").groupBy("sha256").agg(F.min("path").alias("__first"))
    own = F.when(F.col("path") == F.col("__first"), "kept").otherwise("duplicate")
    return rated.join(firsts, "sha256", "left").select("path", "paper", F.coalesce("state", own).alias("state"))
