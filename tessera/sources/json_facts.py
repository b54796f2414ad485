"""Facts of JSON documents of any shape: every leaf with its path and the record that it belongs to."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def leaves(value, path: str = "$", key: str = "") -> Iterator[tuple[str, str, str, str]]:
    """(path, record key, field, value as JSON). A record is named by its first non-empty ``*_id``; arrays add their index."""
    if isinstance(value, dict):
        own = next((str(v) for k, v in value.items() if k.endswith("_id") and isinstance(v, str | int) and v != ""), None)
        key = own if own is not None else key
        for k, v in value.items():
            if isinstance(v, dict | list):
                yield from leaves(v, f"{path}.{k}", key)
            else:
                yield f"{path}.{k}", key, k, json.dumps(v, ensure_ascii=False)
    elif isinstance(value, list):
        for n, v in enumerate(value):
            inner = f"{key}[{n}]"
            if isinstance(v, dict | list):
                yield from leaves(v, f"{path}[{n}]", inner)
            else:
                yield f"{path}[{n}]", inner, path.rsplit(".", 1)[-1], json.dumps(v, ensure_ascii=False)


def collected_ids(value, suffix: str = "evidence_ids") -> list[str]:
    """All members of lists under names that end so, first come first, once each."""
    out: dict[str, None] = {}

    def walk(v) -> None:
        if isinstance(v, dict):
            for k, x in v.items():
                if k.endswith(suffix) and isinstance(x, list):
                    out.update(dict.fromkeys(map(str, x)))
                else:
                    walk(x)
        elif isinstance(v, list):
            for x in v:
                walk(x)

    walk(value)
    return list(out)


def facts(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, place, json_path, record_key, field, value); a broken document gives one row with field ``error``."""
    kind = df.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    own = list(leaves(json.loads(raw or "")))
                except ValueError as e:
                    own = [("$", "", "error", json.dumps(str(e)))]
                rows += [(i, k, *x) for k, x in enumerate(own)]
            if rows:
                types = [batch.schema.field(0).type, pa.int32(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types, strict=True)], names=["id", "place", "json_path", "record_key", "field", "value"])

    return df.select(F.col(id_col), F.col(json_col).cast("string")).mapInArrow(read, f"id {kind}, place int, json_path string, record_key string, field string, value string").withColumnRenamed("id", id_col)


def regrouped(df: DataFrame, id_col: str, name_col: str, value_col: str) -> DataFrame:
    """Names like ``group.name.3.field`` as one row per (group, name, number) with a map of fields."""
    parts = r"^([^.]+)\.([^.]+)\.(\d+)\.(.+)$"
    own = df.where(F.col(name_col).rlike(parts)).select(id_col, F.regexp_extract(name_col, parts, 1).alias("group"), F.regexp_extract(name_col, parts, 2).alias("name"), F.regexp_extract(name_col, parts, 3).cast("int").alias("number"), F.regexp_extract(name_col, parts, 4).alias("field"), F.col(value_col).alias("v"))
    return own.groupBy(id_col, "group", "name", "number").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("field", "v")))).alias("fields"))
