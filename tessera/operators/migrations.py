"""Versions of a database of files: preflight, backup, migration and restore.

A database is a folder of published tables (data and a manifest of rows and digest) and of pointers, numbered
folders of one JSON row each; the last one says which version holds and where each table lies. Readers follow it. A migration
publishes only tables that it changes and then renames one new pointer into place, so a failure before that changes nothing. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.relational import missing_parents
from tessera.operators.sinks import Refused, content, publish
from tessera.shared import moved, names_in

Tables = dict[str, DataFrame]
Link = tuple[str, str, str, str]  # child table, column, parent table, column


@dataclass(frozen=True)
class Migration:
    """A step to ``version`` from the one before: ``change`` returns the tables that are new or other; a table whose value is None goes.

    Tables of ``keeps`` have to come out with as many rows as they went in, ``keys`` name unique columns of tables after the step.
    """

    version: int
    name: str
    change: Callable[[Tables], Mapping[str, DataFrame | None]]
    keeps: tuple[str, ...] = ()
    keys: Mapping[str, tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Current:
    """What the last pointer says: its number, the version, and (path, rows, digest) of each table."""

    number: int
    version: int
    tables: Mapping[str, tuple[str, int, str]]


def current(spark: SparkSession, db: str) -> Current:
    names = [x for x in names_in(spark, f"{db}/pointers") if x.isdigit()]
    if not names:
        raise FileNotFoundError(f"{db} has no version")
    row = spark.read.schema("version int, tables string").json(f"{db}/pointers/{names[-1]}").first()
    return Current(int(names[-1]), row["version"], {k: tuple(v) for k, v in json.loads(row["tables"]).items()})


def read(spark: SparkSession, db: str, at: Current | None = None) -> Tables:
    """The tables of the current version, or of one that ``current`` told before."""
    return {name: spark.read.parquet(f"{path}/data") for name, (path, _, _) in (at or current(spark, db)).tables.items()}


def point(spark: SparkSession, db: str, number: int, version: int, tables: Mapping[str, tuple[str, int, str]]) -> None:
    """Make a version the current one; if another writer has taken the number, that is an error and nothing changes."""
    staged = f"{db}/staged/{uuid.uuid4().hex}"
    spark.createDataFrame([(version, json.dumps(tables))], "version int, tables string").coalesce(1).write.json(staged)
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{db}/pointers")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    moved(spark, staged, f"{db}/pointers/{number:08d}")


def published(db: str, name: str, df: DataFrame) -> tuple[str, int, str]:
    path = f"{db}/tables/{name}-{uuid.uuid4().hex}"
    return (path, *publish(df, path))


def create(spark: SparkSession, db: str, tables: Mapping[str, DataFrame], version: int = 0) -> Current:
    """A new database; an existing one is an error."""
    if names_in(spark, f"{db}/pointers"):
        raise FileExistsError(db)
    point(spark, db, 1, version, {name: published(db, name, df) for name, df in tables.items()})
    return current(spark, db)


def preflight(spark: SparkSession, db: str, migrations: Sequence[Migration], links: Sequence[Link] = ()) -> tuple[Current, list[Migration]]:
    """The current version and the steps that it lacks.

    Refused: steps that are not numbered upwards, a version newer than the last step or between steps unknown to them, a table whose
    content is not what its manifest says, and a link to a row that is not there.
    """
    versions = [m.version for m in migrations]
    if versions != sorted(set(versions)):
        raise Refused(f"steps are not in order: {versions}")
    now = current(spark, db)
    if versions and now.version > versions[-1]:
        raise Refused(f"version {now.version} is newer than {versions[-1]}, the last known")
    if now.version and now.version not in versions:
        raise Refused(f"version {now.version} is unknown")
    tables = read(spark, db, now)
    for name, df in tables.items():
        if content(df) != now.tables[name][1:]:
            raise Refused(f"{name} is not what its manifest says")
    broken_links(tables, links)
    return now, [m for m in migrations if m.version > now.version]


def broken_links(tables: Tables, links: Sequence[Link]) -> None:
    for child, column, parent, key in links:
        if child in tables and parent in tables:
            own = tables[child].where(F.col(column).isNotNull()).select(F.col(column).alias("__key"))
            lost = missing_parents(own, tables[parent].select(F.col(key).alias("__key")), "__key").first()
            if lost:
                raise Refused(f"{child}.{column} {lost['__key']} is not in {parent}")


def backup(spark: SparkSession, db: str, target: str) -> Current:
    """A copy of the current version as a database of its own, verified table by table; an existing target is an error."""
    now = current(spark, db)
    copy = create(spark, target, read(spark, db, now), now.version)
    for name, (_, *want) in now.tables.items():
        if list(copy.tables[name][1:]) != list(want):
            raise Refused(f"{name} is not what its manifest says")
    return copy


def migrate(spark: SparkSession, db: str, migrations: Sequence[Migration], target: str | None = None, links: Sequence[Link] = ()) -> list[tuple[int, str, str, int, int]]:
    """Bring a database to the last version and return (version, step, table, rows before, rows after) of what changed.

    After the preflight and, with ``target``, a backup there, each step's tables are published and checked; then the pointer is renamed
    into place if it is still the one of the preflight. Whatever fails on the way, the old version stays current. Without a step to do nothing is written.
    """
    now, steps = preflight(spark, db, migrations, links)
    if not steps:
        return []
    if target:
        backup(spark, db, target)
    tables, report = dict(now.tables), []
    for step in steps:
        frames = {name: spark.read.parquet(f"{path}/data") for name, (path, _, _) in tables.items()}
        for name, df in step.change(frames).items():
            before = tables[name][1] if name in tables else 0
            if df is None:
                del tables[name]
                after = 0
            else:
                tables[name] = published(db, name, df)
                after = tables[name][1]
            if name in step.keeps and after != before:
                raise Refused(f"{step.name}: {name} had {before} rows and has {after}")
            report.append((step.version, step.name, name, before, after))
        made = {name: spark.read.parquet(f"{path}/data") for name, (path, _, _) in tables.items()}
        for name, key in (step.keys or {}).items():
            twice = made[name].groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").first()
            if twice:
                raise Refused(f"{step.name}: {name} has {', '.join(str(twice[k]) for k in key)} {twice['n']} times")
    broken_links(made, links)
    if current(spark, db) != now:
        raise Refused(f"{db} changed since the preflight")
    point(spark, db, now.number + 1, steps[-1].version, tables)
    return report


def restore(spark: SparkSession, db: str, target: str) -> Current:
    """Make a backup's content the current version again, under a new pointer."""
    kept, now = current(spark, target), current(spark, db)
    tables = {}
    for name, df in read(spark, target, kept).items():
        tables[name] = published(db, name, df)
        if list(tables[name][1:]) != list(kept.tables[name][1:]):
            raise Refused(f"{name} is not what its manifest says")
    point(spark, db, now.number + 1, kept.version, tables)
    return current(spark, db)
