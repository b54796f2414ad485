"""Corpus imports and scoring: records from pages, bundles in order, links, corrections, facts and their match with requirements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.components import components
from tessera.operators.evidence import stable_id
from tessera.shared import partitions_for, written


def numbered_candidates(records: DataFrame, keys: DataFrame, id_col: str) -> DataFrame:
    """(number, cluster, records, sources): clusters of records that share keys, numbered by their first record.

    ``records`` (id, source), ``keys`` (id, key). Numbers are dense within ranges of clusters and offset by what lies
    before, so that no task sees all clusters.
    """
    firsts = keys.groupBy("key").agg(F.min(id_col).alias("b"))
    star = components(keys.join(firsts, "key").select(F.col(id_col).alias("a"), "b"))
    rooted = records.join(star.withColumnsRenamed({"a": id_col, "b": "cluster"}), id_col, "left").withColumn("cluster", F.coalesce("cluster", id_col))
    per = rooted.groupBy("cluster").agg(F.count("*").alias("records"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return dense_numbers(per, "cluster", "number")


def dense_numbers(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with numbers from 1 in order of a column, nulls last; rows with equal values are numbered in any order.

    Rows are range-partitioned by sampled bounds, numbered in their partition, and partitions follow each other by their sizes, a
    row each; far-off values widen no range.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions_for(spark), F.asc_nulls_last(order)).sortWithinPartitions(F.asc_nulls_last(order))
    place = F.col("__place")
    rows = written(dealt.withColumn("__place", F.monotonically_increasing_id()), "in-order").withColumn("__part", F.shiftright(place, 33))
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__before"))
    own = place.bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__before") + 1
    return rows.join(before, "__part").withColumn(name, own.cast("long")).drop("__part", "__place", "__before")


def found_or_created(incoming: DataFrame, existing: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Each incoming identity once, with the first existing id or a new one made from it, and whether it was created."""
    known = existing.groupBy(*identity).agg(F.min("evidence_id").alias("__id"))
    once = incoming.select(*identity).distinct().join(known, list(identity), "left")
    made = stable_id("ev-", *(F.col(c) for c in identity))
    return once.select(*identity, F.coalesce(F.col("__id").cast("string"), made).alias("evidence_id"), F.col("__id").isNull().alias("created"))


def linked(links: DataFrame, evidence: DataFrame, owners: DataFrame, evidence_id: str, owner: str) -> DataFrame:
    """Links with ``state``: unknown_evidence, unknown_owner, repeated (a later row of one link) or linked."""
    counted = links.groupBy(owner, evidence_id).agg(F.count("*").alias("rows"))
    e, o = evidence.select(evidence_id).distinct().withColumn("__e", F.lit(True)), owners.select(owner).distinct().withColumn("__o", F.lit(True))
    both = counted.join(e, evidence_id, "left").join(o, owner, "left")
    state = F.when(F.col("__e").isNull(), "unknown_evidence").when(F.col("__o").isNull(), "unknown_owner").when(F.col("rows") > 1, "repeated").otherwise("linked")
    return both.select(owner, evidence_id, "rows", state.alias("state"))


def corrected(records: DataFrame, corrections: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Records with the fields that corrections (key, field, value, no) give, of several the last; ``corrected`` lists them."""
    own = corrections.where(F.col("field").isin(*fields)).groupBy(key, "field").agg(F.max_by("value", "no").alias("value"))
    wide = own.groupBy(key).pivot("field", list(fields)).agg(F.first("value")).select(key, *(F.col(f).alias(f"__{f}") for f in fields))
    joined = records.join(wide, key, "left")
    names = F.array_join(F.array_compact(F.array(*(F.when(F.col(f"__{f}").isNotNull(), f) for f in fields))), ",")
    return joined.select(*(c for c in records.columns if c not in fields), *(F.coalesce(F.col(f"__{f}"), F.col(f).cast("string")).alias(f) for f in fields), names.alias("corrected"))


def ordered_bundles(manifest: DataFrame, bundles: DataFrame, key: str) -> DataFrame:
    """Every paper of the manifest in its order with what is to be imported: a bundle, its screening record only, or nothing yet; unlisted bundles last."""
    per = bundles.groupBy(key).agg(F.count("*").alias("bundles"), F.max("blocked").alias("blocked"))
    both = manifest.join(per, key, "full")
    kind = F.when(F.col("position").isNull(), "unlisted").when(F.col("bundles").isNull(), F.when(F.col("excluded"), "screening_only").otherwise("missing")).when(F.col("bundles") > 1, "ambiguous").when(F.col("blocked"), "blocked").otherwise("import")
    return both.select(key, "position", kind.alias("kind"))


def unioned_shapes(shapes: Mapping[str, DataFrame]) -> DataFrame:
    """(experiment, field, value, shape): results of several forms as facts of one form."""
    out = None
    for name, df in shapes.items():
        own = df.select(F.col("experiment"), F.col("field"), F.col("value").cast("string").alias("value"), F.lit(name).alias("shape"))
        out = own if out is None else out.unionByName(own)
    return out.where("value is not null")


def bound_requirements(requirements: DataFrame, experiments: DataFrame) -> DataFrame:
    """Each requirement (reference_id, paper, experiment) with its state: bound, unknown_experiment, other_paper or duplicate."""
    times = requirements.groupBy("reference_id").agg(F.count("*").alias("__n"))
    known = experiments.select("experiment", F.col("paper").alias("__paper")).dropDuplicates(["experiment"])
    both = requirements.join(times, "reference_id").join(known, "experiment", "left")
    state = F.when(F.col("__n") > 1, "duplicate").when(F.col("__paper").isNull(), "unknown_experiment").when(F.col("__paper") != F.col("paper"), "other_paper").otherwise("bound")
    return both.select("reference_id", "paper", "experiment", state.alias("state"))


def scored_requirements(requirements: DataFrame, facts: DataFrame) -> DataFrame:
    """(category, n, met, wrong_arm, recall): requirements (id, category, experiment, field, values) that a fact (experiment, field, value) meets.

    Values are an array of what is accepted, aliases included, compared in lower case. A value that is right but stands
    at another experiment counts as a wrong arm.
    """
    each = requirements.select("id", "category", "experiment", "field", F.explode(F.transform("values", F.lower)).alias("value")).distinct()
    own = facts.select("experiment", "field", F.lower("value").alias("value")).distinct()
    right = each.join(own, ["experiment", "field", "value"], "left_semi").select("id").distinct().withColumn("met", F.lit(True))
    somewhere = each.join(own.select("field", "value").distinct(), ["field", "value"], "left_semi").select("id").distinct().withColumn("seen", F.lit(True))
    rated = requirements.select("id", "category").distinct().join(right, "id", "left").join(somewhere, "id", "left")
    met, seen = F.coalesce("met", F.lit(False)), F.coalesce("seen", F.lit(False))
    return rated.groupBy("category").agg(F.count("*").alias("n"), F.count_if(met).alias("met"), F.count_if(seen & ~met).alias("wrong_arm"), F.round(F.count_if(met) / F.count("*"), 6).alias("recall"))


def safety_counts(facts: DataFrame, issued: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: facts of ids that were never issued, and numbers that their source does not print. ``facts`` (id, source, number)."""
    invented = facts.join(issued.select("id").distinct(), "id", "left_anti").agg(F.count("*").alias("invented_ids"))
    numbers = facts.where("number is not null").join(sources, "source", "left")
    unprinted = numbers.agg(F.count_if(~F.coalesce(F.col("text").contains(F.col("number")), F.lit(False))).alias("unsupported_numbers"))
    return invented.crossJoin(unprinted)  # one row each


def confusion(rows: DataFrame, key: str, predicted: str, wanted: str) -> DataFrame:
    """Per key: the four counts, precision and recall; null where there is nothing to divide by."""
    p, w = F.col(predicted), F.col(wanted)
    per = rows.groupBy(key).agg(F.count_if(p & w).alias("tp"), F.count_if(p & ~w).alias("fp"), F.count_if(~p & w).alias("fn"), F.count_if(~p & ~w).alias("tn"))
    share = lambda a, b: F.when(a + b > 0, F.round(a / (a + b), 6))
    return per.withColumns({"precision": share(F.col("tp"), F.col("fp")), "recall": share(F.col("tp"), F.col("fn"))})


def associated(records: DataFrame, experiments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each record (id, signature, keys) with the one experiment of its signature, or why there is none: no_inventory, unresolved, unmatched or ambiguous."""
    per = experiments.groupBy(*keys, "signature").agg(F.count("*").alias("__n"), F.min("experiment").alias("__e"))
    some = experiments.select(*keys).distinct().withColumn("__some", F.lit(True))
    both = records.join(per, [*keys, "signature"], "left").join(some, list(keys), "left")
    state = F.when(F.col("__some").isNull(), "no_inventory").when(F.col("signature").isNull(), "unresolved").when(F.col("__n").isNull(), "unmatched").when(F.col("__n") > 1, "ambiguous").otherwise("associated")
    return both.select("id", F.when(state == "associated", F.col("__e")).alias("experiment"), state.alias("state"))


def qualified_slots(slots: DataFrame, evidence: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """(record, slot, state, evidence): whether evidence of the record names each required slot: qualified by one piece, ambiguous by several, or open.

    ``slots`` (record), ``evidence`` (record, evidence_id, text); ``patterns`` by slot.
    """
    each = F.array(*(F.struct(F.lit(n).alias("slot"), F.col("text").rlike(p).alias("hit")) for n, p in patterns.items()))
    hits = evidence.select("record", "evidence_id", F.inline(each)).where("hit").groupBy("record", "slot").agg(F.countDistinct("evidence_id").alias("n"), F.min("evidence_id").alias("evidence"))
    wanted = slots.select("record", F.explode(F.array(*map(F.lit, patterns))).alias("slot"))
    full = wanted.join(hits, ["record", "slot"], "left")
    state = F.when(F.col("n").isNull(), "open").when(F.col("n") > 1, "ambiguous").otherwise("qualified")
    return full.select("record", "slot", state.alias("state"), F.when(F.col("n") == 1, F.col("evidence")).alias("evidence"))


def field_tasks(findings: DataFrame, evidence: DataFrame, most: int = 5) -> DataFrame:
    """A task per repairable field-level finding with the first evidence of its record, its checksum, and how much there is; others have none."""
    w = Window.partitionBy("record").orderBy("place", "evidence_id")
    first = evidence.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    lists = first.groupBy("record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "evidence_id"))), lambda x: x["evidence_id"].cast("string")), ",").alias("evidence"))
    tasks = findings.where("repairable").join(lists, "record", "left").withColumn("evidence", F.coalesce("evidence", F.lit("")))
    return tasks.select("finding", "record", "field", "evidence", F.sha2(F.concat_ws("|", F.col("finding").cast("string"), "field", "evidence"), 256).alias("checksum"))


def packet_order(texts: DataFrame, key: str, id_col: str, text: Column) -> DataFrame:
    """(key, id, same_as, place): evidence of one normalised text is given once, by its first id, and placed in order of id."""
    own = texts.select(key, id_col, F.sha2(text, 256).alias("__digest"))
    firsts = own.groupBy(key, "__digest").agg(F.min(id_col).alias("same_as"))
    w = Window.partitionBy(key).orderBy("same_as")
    return own.join(firsts.withColumn("place", F.row_number().over(w)), [key, "__digest"]).select(key, id_col, "same_as", "place")


def grouped_arms(rows: DataFrame, keys: Sequence[str], id_col: str, required: Sequence[str]) -> DataFrame:
    """Arms from rows of equal scientific keys: their rows, whether each required field has one value only, and an id that stands for the keys."""
    # least and greatest tell none, one and several values apart in one aggregate; distinct counts would copy every row once a field
    checks = [c for f in required for c in (F.min(f).alias(f"__least_{f}"), F.max(f).alias(f"__most_{f}"))]
    per = rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(id_col).alias("first_id"), *checks)
    problems = F.array_compact(F.array(*(F.when(F.col(f"__least_{f}").isNull(), f"missing:{f}").when(F.col(f"__least_{f}") != F.col(f"__most_{f}"), f"conflict:{f}") for f in required)))
    return per.select(*keys, "rows", "first_id", F.array_join(problems, ",").alias("problems"), stable_id("arm-", *(F.col(k) for k in keys)).alias("arm_id"))


def usage_totals(results: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Totals with nulls as nothing, and how many results lack a measure."""
    sums = [F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures]
    lacks = F.lit(False)
    for m in measures:
        lacks = lacks | F.col(m).isNull()
    return results.groupBy(key).agg(F.count("*").alias("results"), *sums, F.count_if(lacks).alias("unmeasured"))
