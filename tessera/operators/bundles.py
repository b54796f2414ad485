"""Bundles of records a paper, imported all or nothing into a store of files.

A store has a folder a table. A run stages its new rows below ``run=...`` of each table, checks every paper, and then renames one
manifest into place: the papers that it commits. Readers follow the manifests, so rows of a refused paper, or of a run that died
before its manifest, are never seen, and what was committed before stays as it is. One writer at a time.

A record is known by paper, table and record id. Its content holds its own values and the identity of its parents, so a changed
parent changes what hangs on it. The same content is unchanged, other content under a known id is kept beside it as a conflict.
Files hold the content's digest as 32 bytes; ids follow from it and are made when a table is read.

An import takes as many papers at a time as have ``SLICE_ROWS`` records or so, by their hash, and its tables and shuffles go before the
next ones come; they are committed together. Rows are dealt out by paper, in which links, doubles and what the store knows are told, so
a digest is not shuffled again for each of these; a large paper is sorted in one task, which can spill.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import digest
from tessera.operators import readiness
from tessera.shared import CLEANED, drop, moved, names_in, partitions_for, settings, settled, written


@dataclass(frozen=True)
class Entity:
    """A table of the store: columns that name records of other tables, those of them that may be null, and its conflicts' reason code."""

    name: str
    parents: Mapping[str, str] = field(default_factory=dict)
    optional: frozenset[str] = frozenset()
    reason: str = ""


#: Tables, their links and the reason codes of conflicts.
ENTITIES = (
    Entity("paper", reason="content_conflict_paper"),
    Entity("formulation", reason="conflicting_formulation"),
    Entity("component", {"formulation_id": "formulation"}, reason="conflicting_formulation"),
    Entity("arm", {"formulation_id": "formulation"}, reason="experiment_link_unclear"),
    Entity("outcome", {"arm_id": "arm"}, reason="conflicting_outcome"),
    Entity("evidence", {"arm_id": "arm", "outcome_id": "outcome"}, frozenset({"arm_id", "outcome_id"}), "content_conflict_evidence"),
)
KEY = ["paper_id", "record_id"]
SLICE_ROWS, TASK_ROWS = 128_000_000, 250_000
#: Rows that are dealt out by paper are joined by paper and another column where they are.
DEALT = CLEANED | {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def dealt(df: DataFrame) -> DataFrame:
    return df.repartition(partitions_for(df.sparkSession), "paper_id")


def slices(rows: int) -> list[Column]:
    """Conditions on ``paper_id``, each paper in one of them, that have ``SLICE_ROWS`` of so many rows or so."""
    n = max(1, -(-rows // SLICE_ROWS))
    return [F.pmod(F.xxhash64("paper_id"), F.lit(n)) == k for k in range(n)] if n > 1 else [F.lit(True)]


def record_id(entity: str) -> Column:
    """A record's identity, from its paper, table, record id and content (bytes)."""
    return digest(F.lit(entity), F.col("paper_id"), F.col("record_id"), F.lower(F.hex("content")))


def identified(own: DataFrame, entity: Entity, made: Mapping[str, DataFrame]) -> DataFrame:
    """The records with ``content``, 32 bytes, given those of the tables they link to; it follows from the records alone, so another run gives the same."""
    columns = own.columns
    values = sorted(set(columns) - {*KEY, *entity.parents})
    orphan, own = F.lit(False), dealt(own)
    for column, parent in entity.parents.items():
        ids = made[parent].where("__least").select("paper_id", F.col("record_id").alias(column), F.unhex(record_id(parent)).alias(f"__{column}"))
        own = own.join(dealt(ids), ["paper_id", column], "left")
        needed = F.lit(True) if column not in entity.optional else F.col(column).isNotNull()
        orphan = orphan | (needed & F.col(f"__{column}").isNull())
    links = [F.lower(F.hex(f"__{c}")) for c in entity.parents]
    content = F.unhex(digest(*(F.col(c) for c in values), *links)).alias("content")
    return own.select(*KEY, *(c for c in columns if c not in KEY), content, orphan.alias("__orphan"))


def problems(records: Mapping[str, DataFrame], rules: Sequence[tuple[str, str, Column | str]]) -> DataFrame:
    """(paper_id, check, key), some of them repeated: ids that a bundle gives twice with different content, links to nothing, papers without a paper row, and rows that break a rule (name, table, broken)."""
    out = None
    papers = records["paper"].select("paper_id").distinct()
    named = [df.select(F.lit(name).alias("__table"), F.col("paper_id").alias("__paper")).distinct() for name, df in records.items() if name != "paper"]
    named += [records["paper"].where("paper_id is null").select(F.lit("paper").alias("__table"), F.col("paper_id").alias("__paper")).distinct()]
    # few papers lack a row, so they are found before records are looked at
    astray = written(reduce(DataFrame.unionByName, named).join(papers, F.col("__paper") == F.col("paper_id"), "left_anti"), "astray-papers")
    for name, df in records.items():
        lost = astray.where(F.col("__table") == name).select("__paper")
        found = [("repeated_id", df.where("__twice")), ("orphan", df.where("__orphan")), ("no_paper", df.join(lost, F.col("paper_id").eqNullSafe(F.col("__paper")), "left_semi"))]
        found += [(rule, df.where(broken)) for rule, table, broken in rules if table == name]
        for check, broken in found:
            own = broken.select("paper_id", F.lit(check).alias("check"), F.concat(F.lit(f"{name}:"), F.col("record_id").cast("string")).alias("key"))
            out = own if out is None else out.unionByName(own)
    return out


def commits(spark: SparkSession, store: str) -> DataFrame | None:
    """(paper_id, run, inserted, conflicts) of every run that reached its manifest; None for a new store."""
    runs = [x for x in names_in(spark, f"{store}/commits") if x.startswith("run=")]
    return spark.read.parquet(*(f"{store}/commits/{x}" for x in runs)) if runs else None


def committed(spark: SparkSession, store: str, table: str, papers: Column | None = None) -> DataFrame | None:
    """The rows of a table that committed papers have, content as bytes, with the run that brought them; None if there are none. With ``papers`` those of some, dealt out by paper."""
    known = commits(spark, store)
    runs = [] if known is None else [x for x in names_in(spark, f"{store}/commits") if x.startswith("run=")]
    paths = [f"{store}/{table}/{x}" for x in runs if x in names_in(spark, f"{store}/{table}")]
    if not paths:
        return None
    rows = spark.read.option("basePath", f"{store}/{table}").parquet(*paths).withColumn("run", F.col("run").cast("string"))
    seen = known.select("paper_id", F.col("run").cast("string").alias("run"))
    if papers is not None:
        rows, seen = dealt(rows.where(papers)), dealt(seen.where(papers))
    return rows.join(seen.distinct(), ["paper_id", "run"], "left_semi")


def decided(records: DataFrame, known: DataFrame | None) -> DataFrame:
    """Each record once, with ``decision``: unchanged, conflict (known id, new content) or new; ``__twice`` marks ids with different content, ``__least`` the content that stands for an id in links.

    Both tables are dealt out by paper. One sort, of a bundle's records and what is known of them, tells all of it.
    """
    rows = records.withColumn("__known", F.lit(False))
    if known is not None:
        nothing = (F.lit(None).cast(kind).alias(c) for c, kind in records.dtypes if c not in {*KEY, "content"})
        rows = rows.unionByName(known.select(*KEY, "content", *nothing, F.lit(True).alias("__known")))
    same, key = Window.partitionBy(*KEY, "content").orderBy(F.desc("__known")), Window.partitionBy(*KEY)
    rows = rows.select("*", F.first("__known").over(same).alias("__same"), (~F.col("__known") & F.coalesce(F.lag("__known").over(same), F.lit(True))).alias("__own"))
    least, several = F.min(F.when(F.col("__own"), F.col("content"))).over(key), F.count_if("__own").over(key) > 1
    rows = rows.select("*", F.max("__known").over(key).alias("__met"), several.alias("__twice"), least.alias("__low")).where("__own")
    decision = F.when(F.col("__same"), "unchanged").when(F.col("__met"), "conflict").otherwise("new")
    return rows.select(*records.columns, decision.alias("decision"), "__twice", (F.col("content") == F.col("__low")).alias("__least"))


def import_bundles(spark: SparkSession, store: str, bundles: Mapping[str, DataFrame], rules: Sequence[tuple[str, str, Column | str]] = (), entities: Sequence[Entity] = ENTITIES) -> DataFrame:
    """Import papers and report ``paper_id, state, inserted, conflicts, unchanged, problems`` for each.

    ``bundles`` has a DataFrame a table with ``paper_id``, ``record_id``, the link columns and any values. A paper with a broken rule is
    ``refused`` and leaves nothing; others are ``committed``, or ``unchanged`` if the store has all their records already.
    A null paper or record id is refused. Empty bundles write no manifest.
    """
    run = f"run={len(names_in(spark, f'{store}/commits')) + 1:06d}-{uuid.uuid4().hex[:8]}"
    rows = reduce(DataFrame.union, [bundles[e.name].select(F.lit(1)) for e in entities]).count()
    report = gathered(spark, rows, lambda papers: imported(spark, store, run, bundles, rules, entities, papers), "import-report")
    new = report.where("state = 'committed'")
    if not new.isEmpty():
        commit(new.select("paper_id", F.lit(run.removeprefix("run=")).alias("run"), "inserted", "conflicts"), store, run)
    return report


def gathered(spark: SparkSession, rows: int, make: Callable[[Column], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns for some papers after others, as one table; what it writes on its way goes before the next ones come."""
    parts = max(partitions_for(spark), -(-min(rows, SLICE_ROWS) // TASK_ROWS))
    with settings(spark, DEALT | {"spark.sql.shuffle.partitions": str(parts)}):
        made = [settled(spark, lambda papers=papers: make(papers), name) for papers in slices(rows)]
        if len(made) == 1:
            return made[0]
        out = written(reduce(DataFrame.unionByName, made), name)
    for df in made:
        drop(df)
    return out


def imported(spark: SparkSession, store: str, run: str, bundles: Mapping[str, DataFrame], rules: Sequence[tuple[str, str, Column | str]], entities: Sequence[Entity], papers: Column) -> DataFrame:
    """Stage what some papers bring that is new, to be seen once the run is committed, and report on them."""
    records: dict[str, DataFrame] = {}
    linked = {parent for entity in entities for parent in entity.parents.values()}
    for entity in entities:
        own = identified(bundles[entity.name].where(papers), entity, records)
        own = decided(own, committed(spark, store, entity.name, papers))
        if entity.name not in linked:  # nothing asks for the content of what is there already
            own = own.withColumn("content", F.when(F.col("decision") != "unchanged", F.col("content")))
        records[entity.name] = written(own, f"bundle-{entity.name}", "zstd")
    nameless = [("null_id", name, F.col("paper_id").isNull() | F.col("record_id").isNull()) for name in records]
    broken = written(problems(records, [*rules, *nameless]).distinct(), "bundle-problems")
    refused = broken.select("paper_id").distinct()

    def stage(name: str) -> None:
        # rows of refused papers are left out to save space; the manifest alone decides what is seen
        fresh = records[name].where("decision <> 'unchanged'").drop("__orphan", "__twice", "__least").join(refused, "paper_id", "left_anti")
        fresh.write.mode("append").option("compression", "zstd").parquet(f"{store}/{name}/{run}")

    with ThreadPoolExecutor(len(records)) as tables:  # small jobs beside each other
        list(tables.map(stage, records))
    counts = None
    for df in records.values():
        own = df.groupBy("paper_id").agg(F.count_if(F.col("decision") != "unchanged").alias("inserted"), F.count_if(F.col("decision") == "conflict").alias("conflicts"), F.count_if(F.col("decision") == "unchanged").alias("unchanged"))
        counts = own if counts is None else counts.unionByName(own)
    per = counts.groupBy("paper_id").agg(*(F.sum(c).alias(c) for c in ("inserted", "conflicts", "unchanged")))
    why = broken.groupBy("paper_id").agg(F.count("*").alias("problems"))
    state = F.when(F.col("problems").isNotNull(), "refused").when(F.col("inserted") > 0, "committed").otherwise("unchanged")
    same = F.col("r.paper_id").eqNullSafe(F.col("w.paper_id"))
    report = per.alias("r").join(why.alias("w"), same, "left").select("r.*", F.coalesce("problems", F.lit(0)).alias("problems"), state.alias("state"))
    gone = F.col("state") == "refused"
    return report.select("paper_id", "state", *(F.when(gone, 0).otherwise(F.col(c)).alias(c) for c in ("inserted", "conflicts", "unchanged")), "problems")


def commit(papers: DataFrame, store: str, run: str) -> None:
    """Write a run's manifest beside its place and rename it there, which makes all its papers seen at once."""
    papers.write.parquet(f"{store}/staged/{run}")
    spark = papers.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/commits")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    moved(spark, f"{store}/staged/{run}", f"{store}/commits/{run}")


def conflicts(tables: Mapping[str, DataFrame], entities: Sequence[Entity] = ENTITIES) -> DataFrame:
    """(paper_id, entity, record_id, reason_code, contents): ids under which the store keeps several contents."""
    out = None
    for entity in entities:
        many = tables[entity.name].groupBy(*KEY).agg(F.count("*").alias("contents")).where("contents > 1")
        own = many.select("paper_id", F.lit(entity.name).alias("entity"), F.col("record_id").cast("string").alias("record_id"), F.lit(entity.reason).alias("reason_code"), "contents")
        out = own if out is None else out.unionByName(own)
    return out


def conflicted_arms(tables: Mapping[str, DataFrame], found: DataFrame) -> DataFrame:
    """(paper_id, arm_id, reasons): arms that a conflict touches, their own or one of their paper, formulation, components, outcomes or evidence."""
    own = lambda kind, column: found.where(F.col("entity") == kind).select("paper_id", F.col("record_id").alias(column), "reason_code")
    arms = tables["arm"].select("paper_id", F.col("record_id").alias("arm_id"), "formulation_id").distinct()
    by = lambda table, column, to: tables[table].select("paper_id", F.col("record_id").alias(column), to).where(F.col(to).isNotNull()).distinct()
    ways = [
        arms.join(own("paper", "p").select("paper_id", "reason_code").distinct(), "paper_id"),
        arms.join(own("formulation", "formulation_id"), ["paper_id", "formulation_id"]),
        arms.join(by("component", "c", "formulation_id").join(own("component", "c"), ["paper_id", "c"]), ["paper_id", "formulation_id"]),
        own("arm", "arm_id"),
        by("outcome", "o", "arm_id").join(own("outcome", "o"), ["paper_id", "o"]),
        by("evidence", "e", "arm_id").join(own("evidence", "e"), ["paper_id", "e"]),
    ]
    out = None
    for way in ways:
        way = way.select("paper_id", "arm_id", "reason_code").distinct()
        out = way if out is None else out.unionByName(way)
    return out.groupBy("paper_id", "arm_id").agg(F.array_sort(F.collect_set("reason_code")).alias("reasons"))


def corpus_tables(spark: SparkSession, store: str, entities: Sequence[Entity] = ENTITIES, papers: Column | None = None) -> dict[str, DataFrame]:
    """Every table of a store that has a committed paper; with ``papers`` the rows of some, dealt out by paper."""
    found = {e.name: committed(spark, store, e.name, papers) for e in entities}
    if None in found.values():
        raise FileNotFoundError(f"{store} has no committed papers")
    return {name: df.withColumn("id", record_id(name)).withColumn("content", F.lower(F.hex("content"))) for name, df in found.items()}


def deduplicated_arms(arms: DataFrame, values: Sequence[str]) -> DataFrame:
    """The arms with ``kept_as``: the first of a paper's arms with equal values, spelled alike but for case and blanks."""
    plain = [F.lower(F.trim(F.regexp_replace(F.coalesce(F.col(v).cast("string"), F.lit("")), r"\s+", " "))) for v in values]
    return arms.withColumn("kept_as", F.min("record_id").over(Window.partitionBy("paper_id", *plain)))


def rescreened(arms: DataFrame, evidence: DataFrame, value: str) -> DataFrame:
    """The arms with ``scope``: the one value that their evidence states, ``unresolved`` if it states several, null if none."""
    per = evidence.where(F.col("arm_id").isNotNull() & F.col(value).isNotNull()).groupBy("paper_id", "arm_id").agg(F.min(value).alias("__least"), F.max(value).alias("__most"))
    scope = F.when(F.col("__least") == F.col("__most"), F.col("__least").cast("string")).when(F.col("__least").isNotNull(), "unresolved")
    return arms.join(per.withColumnRenamed("arm_id", "record_id"), KEY, "left").withColumn("scope", scope).drop("__least", "__most")


def repaired_arms(arms: DataFrame, repairs: DataFrame, value: str) -> DataFrame:
    """Repairs (paper_id, record_id, expected, value) set a value where it is still the expected one; ``repair`` tells applied, stale or none. An arm with several different repairs takes none."""
    one = repairs.groupBy(*KEY).agg(F.countDistinct(F.struct("expected", "value")).alias("__n"), F.min("expected").alias("__expected"), F.min("value").alias("__value"))
    fits = (F.col("__n") == 1) & F.col(value).eqNullSafe(F.col("__expected"))
    state = F.when(F.col("__n").isNull(), "none").when(F.col("__n") > 1, "ambiguous").when(fits, "applied").otherwise("stale")
    joined = arms.join(one, KEY, "left").withColumn("repair", state)
    return joined.withColumn(value, F.when(F.col("repair") == "applied", F.col("__value")).otherwise(F.col(value))).drop("__n", "__expected", "__value")


def rebuilt_corpus(spark: SparkSession, store: str, bundles: Sequence[Mapping[str, DataFrame]], identity: Sequence[str], scope: str, repairs: DataFrame, value: str, rules: Sequence[tuple[str, str, Column | str]] = ()) -> DataFrame:
    """``paper_id, arm_id, kept_as, scope, value, repair, outcomes, status``: bundles imported one after the other into a store that has to be
    new, then arms deduplicated, rescreened by their evidence, repaired, and their status made anew from conflicts and gaps."""
    if names_in(spark, store):
        raise FileExistsError(store)
    for bundle in bundles:
        drop(import_bundles(spark, store, bundle, rules))
    known = commits(spark, store)
    rows = 0 if known is None else known.agg(F.sum("inserted")).first()[0]
    return gathered(spark, rows, lambda papers: rebuilt_arms(corpus_tables(spark, store, papers=papers), identity, scope, dealt(repairs.where(papers)), value), "rebuilt-arms")


def rebuilt_arms(tables: Mapping[str, DataFrame], identity: Sequence[str], scope: str, repairs: DataFrame, value: str) -> DataFrame:
    """The arms of ``rebuilt_corpus`` from tables that have been imported."""
    touched = conflicted_arms(tables, conflicts(tables)).select("paper_id", F.col("arm_id").alias("record_id"), F.lit(True).alias("__conflict"))
    current = tables["arm"].withColumn("__last", F.max("run").over(Window.partitionBy(*KEY))).where("run = __last").drop("__last")
    arms = repaired_arms(rescreened(deduplicated_arms(current, identity), tables["evidence"], scope), repairs, value)
    outcomes = tables["outcome"].groupBy("paper_id", F.col("arm_id").alias("record_id")).agg(F.countDistinct("record_id").alias("outcomes"))
    whole = arms.join(outcomes, KEY, "left").join(touched, KEY, "left").withColumn("outcomes", F.coalesce("outcomes", F.lit(0)))
    gaps = readiness.reasons({"outcome": F.col("outcomes") > 0, "scope": F.col("scope").isNotNull() & (F.col("scope") != "unresolved"), "value": F.col(value).isNotNull()})
    state = readiness.status(F.lit(False), F.coalesce("__conflict", F.lit(False)), gaps)
    return whole.select("paper_id", F.col("record_id").alias("arm_id"), "kept_as", "scope", F.col(value).alias("value"), "repair", "outcomes", state.alias("status"))

