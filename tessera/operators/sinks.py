"""Sinks: refuse what breaks a rule, publish with a manifest, export as CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import digest
from tessera.operators.relational import table_digest


class Refused(ValueError):
    """The rows to write break a rule."""


def content(df: DataFrame) -> tuple[int, str]:
    row = table_digest(df, digest(*(F.col(c) for c in df.columns))).first()
    return row["n"], row["digest"]


def publish(df: DataFrame, path: str, broken: DataFrame | None = None) -> tuple[int, str]:
    """Write a new table and verify by rows and digest that what is read back is what was given; an existing path is never overwritten."""
    if broken is not None and not broken.isEmpty():
        first = broken.first()
        raise Refused(f"{first['check']}: {first['key']}")
    expected = content(df)
    df.write.mode("errorifexists").parquet(f"{path}/data")
    found = content(df.sparkSession.read.schema(df.schema).parquet(f"{path}/data"))
    if found != expected:
        raise Refused(f"{path}: {found} was read back for {expected}")
    df.sparkSession.createDataFrame([found], "n long, digest string").write.json(f"{path}/manifest")
    return found


def rebuilt(path: str, tables: Mapping[str, DataFrame], broken: DataFrame | None = None) -> dict[str, tuple[int, str]]:
    """A new database: every table published below ``path`` and verified, nothing written if a rule is broken; an existing table is an error."""
    if broken is not None and not broken.isEmpty():
        first = broken.first()
        raise Refused(f"{first['check']}: {first['key']}")
    return {name: publish(df, f"{path}/{name}") for name, df in tables.items()}


def snapshot(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> dict[str, tuple[int, str]]:
    """Copies of published tables, each held against the manifest of its source."""
    found = {}
    for name in names:
        manifest = spark.read.json(f"{source}/{name}/manifest").first()
        found[name] = publish(spark.read.parquet(f"{source}/{name}/data"), f"{target}/{name}")
        if found[name] != (manifest["n"], manifest["digest"]):
            raise Refused(f"{name} is not what its manifest says")
    return found


def promoted(spark: SparkSession, candidate: str, expected: Mapping[str, tuple[int, str]], current: str) -> None:
    """Make ``candidate`` the current database, if all its tables are the expected ones: readers follow the path that ``current`` holds."""
    for name, want in expected.items():
        if content(spark.read.parquet(f"{candidate}/{name}/data")) != want:
            raise Refused(f"{name} is not the one that was approved")
    spark.createDataFrame([(candidate,)], "path string").coalesce(1).write.mode("overwrite").json(current)


def export_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """CSV with a header, sorted within files; ranges of ``by`` keep the files in global order."""
    out = df.repartitionByRange(by).sortWithinPartitions(by) if by else df
    out.write.mode("errorifexists").option("header", "true").csv(path)
