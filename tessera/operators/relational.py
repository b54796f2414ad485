"""Relational operators: latest records, key-set joins, polymorphic keys, upserts, ledgers and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key by ``order`` (given descending); a map-side maximum would lose the other columns' types, so a window."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def current(df: DataFrame, id_col: str, replaces_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows that no other row replaces, the highest id of each key."""
    replaced = df.where(F.col(replaces_col).isNotNull()).select(F.col(replaces_col).alias(id_col)).distinct()
    return latest(df.join(replaced, id_col, "left_anti"), keys, [F.desc(id_col)])


def keyed(df: DataFrame, id_col: str, keys: dict[str, Column]) -> DataFrame:
    """(id, key) rows, one per non-null key, named by kind."""
    each = F.array_compact(F.array(*(F.when(c.isNotNull(), F.concat(F.lit(f"{n}:"), c.cast("string"))) for n, c in keys.items())))
    return df.select(F.col(id_col), F.explode(each).alias("key")).distinct()


def known_as(candidates: DataFrame, existing: DataFrame, id_col: str, owner_col: str) -> DataFrame:
    """Candidates whose keys are known, with all owners and keys; of several owners of a key the smallest counts.

    Both tables hold (id, key) rows as from ``keyed``.
    """
    owners = existing.groupBy("key").agg(F.min(owner_col).alias("owner"))
    return candidates.join(owners, "key").groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set("owner")), ",").alias("duplicate_of"), F.array_join(F.array_sort(F.collect_set("key")), ",").alias("matching_keys"))


def set_relation(a: DataFrame, b: DataFrame, owner: str, member: str) -> DataFrame:
    """Per owner: how many members its two sets share and have alone, and whether they are disjoint, one within the other or overlap."""
    side = lambda df, name, other: df.select(owner, member, F.lit(True).alias(name), F.lit(False).alias(other))
    each = side(a, "a", "b").unionByName(side(b, "b", "a")).groupBy(owner, member).agg(F.bool_or("a").alias("a"), F.bool_or("b").alias("b"))
    per = each.groupBy(owner).agg(F.count_if(F.col("a") & F.col("b")).alias("shared"), F.count_if(~F.col("b")).alias("only_a"), F.count_if(~F.col("a")).alias("only_b"))
    relation = F.when(F.col("shared") == 0, "disjoint").when(F.col("only_a") == 0, "a_in_b").when(F.col("only_b") == 0, "b_in_a").otherwise("overlap")
    return per.withColumn("relation", relation)


def stratified(df: DataFrame, id_col: str, strata: Sequence[tuple[str, Column]], per_stratum: int) -> DataFrame:
    """The first ``per_stratum`` rows by id of each stratum in turn, without those taken by an earlier one."""
    taken = None
    for name, member in strata:
        pool = df.where(member) if taken is None else df.where(member).join(taken.select(id_col), id_col, "left_anti")
        own = pool.orderBy(id_col).limit(per_stratum).withColumn("stratum", F.lit(name))
        taken = own if taken is None else taken.unionByName(own)
    return taken


def unique_best(scored: DataFrame, key: str, score: str, least: float) -> DataFrame:
    """The best row of each key with at least ``least``, unless several share the best score."""
    w = Window.partitionBy(key)
    top = scored.where(F.col(score) >= least).withColumn("__best", F.max(score).over(w)).where(F.col(score) == F.col("__best"))
    return top.withColumn("__n", F.count("*").over(w)).where("__n = 1").drop("__best", "__n")


def unique_partner(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Each left with its only partner, or how many there are; a right claimed by several lefts confirms none."""
    per_left = pairs.groupBy(left).agg(F.countDistinct(right).alias("n"), F.min(right).alias("partner"))
    claims = per_left.where("n = 1").groupBy("partner").agg(F.count("*").alias("claims"))
    joined = per_left.join(claims, "partner", "left")
    status = F.when(F.col("n") > 1, "ambiguous").when(F.col("claims") > 1, "revoked").otherwise("confirmed")
    return joined.select(left, F.when(status == "confirmed", F.col("partner")).alias(right), status.alias("status"))


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The target after writing the source; ``action`` tells insert, update (a value changed, null-safe) or keep."""
    t = target.select(*keys, *(F.col(v).alias(f"__t_{v}") for v in values), F.lit(True).alias("__t"))
    s = source.select(*keys, *(F.col(v).alias(f"__s_{v}") for v in values), F.lit(True).alias("__s"))
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"__t_{v}").eqNullSafe(F.col(f"__s_{v}"))
    action = F.when(F.col("__t").isNull(), "insert").when(F.col("__s").isNotNull() & ~same, "update").otherwise("keep")
    return t.join(s, list(keys), "full").select(*keys, *(F.when(F.col("__s").isNotNull(), F.col(f"__s_{v}")).otherwise(F.col(f"__t_{v}")).alias(v) for v in values), action.alias("action"))


def import_decisions(ledger: DataFrame, incoming: DataFrame, key: str, content: str) -> DataFrame:
    """Each incoming record against the ledger: unchanged, conflict (known key, new content) or new."""
    known = ledger.select(key, F.col(content).alias("__content")).distinct()
    same = known.groupBy(key).agg(F.collect_set("__content").alias("__known"))
    decided = F.when(F.col("__known").isNull(), "new").when(F.array_contains("__known", F.col(content)), "unchanged").otherwise("conflict")
    return incoming.join(same, key, "left").withColumn("decision", decided).drop("__known")


def missing_parents(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key).distinct(), key, "left_anti")


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def violations(checks: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """One table (check, key) of all rows that break a rule; each check gives its broken rows and their key."""
    out = None
    for name, broken, key in checks:
        own = broken.select(F.lit(name).alias("check"), key.cast("string").alias("key"))
        out = own if out is None else out.unionByName(own)
    return out


def ordered_text(value: Column, order: Sequence[Column], separator: str = "; ") -> Column:
    """An aggregate: values joined in an order, nulls left out. For groups of bounded size."""
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*(o.alias(f"o{k}") for k, o in enumerate(order)), value.alias("v")))))
    return F.array_join(F.transform(rows, lambda x: x["v"]), separator)


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Each left row with the last right value at or before its time: one union, one sort, no pairs."""
    both = left.select(*keys, time, F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.schema[value].dataType).alias("__value")).unionByName(
        right.select(*keys, time, F.lit(0).alias("__side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("__row"), F.col(value).alias("__value"))
    )
    w = Window.partitionBy(*keys).orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("__seen", F.last("__value", ignorenulls=True).over(w)).where("__side = 1").select("__row.*", F.col("__seen").alias(value))


def streaks(df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column) -> DataFrame:
    """The longest run of consecutive failures of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    island = df.select(*keys, *order, failed.cast("int").alias("__f")).withColumn("__island", F.sum(1 - F.col("__f")).over(w))
    runs = island.groupBy(*keys, "__island").agg(F.sum("__f").alias("n"))
    return runs.groupBy(*keys).agg(F.max("n").alias("longest"))


def table_digest(df: DataFrame, digest: Column) -> DataFrame:
    """One row (n, digest) that changes with any row's content but not with order: no row has to meet another."""
    hashed = df.select(digest.alias("h"))
    parts = [F.sum(F.conv(F.substring("h", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")) for k in range(4)]
    return hashed.agg(F.count("*").alias("n"), F.concat_ws("-", *(p.cast("string") for p in parts)).alias("digest"))
