"""Evidence records: conflicts carried to arms, open gaps, structural comparison, validation, merges and accounting.

Arms (experiments) belong to formulations, these to papers; outcomes, components and evidence
hang on them. Each function joins by keys; lists held in one row belong to one record, task or
experiment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import digest
from tessera.operators.readiness import reasons
from tessera.shared import written

MATCH, OPEN, CLASH, UNASKED = "match", "unconfirmed", "contradiction", "not_applicable"


def contained(needles: DataFrame, hays: DataFrame, block: Sequence[str], needle: str, hay: str) -> DataFrame:
    """Rows of both tables where the needle's text lies within the hay's, in the same block. Blocks are of bounded size, as a paper's records are."""
    return needles.join(hays, list(block)).where(F.col(hay).contains(F.col(needle)))


def projection_audit(experiments: DataFrame, arms: DataFrame, reviews: DataFrame, screened_out: DataFrame) -> DataFrame:
    """A row per (paper, experiment_id): its disposition, how many arms bear its id and why.

    ``arms`` (paper, record_id) and ``reviews`` (paper, natural_key, review_status, review_no) hold the experiment's id
    within their keys. An arm counts before a review, of several reviews the last; then papers that are only screened.
    """
    own = experiments.select("paper", "experiment_id").distinct()
    projected = contained(own, arms, ["paper"], "experiment_id", "record_id").groupBy("paper", "experiment_id").agg(F.count("*").alias("n_arms"))
    reviewed = contained(own, reviews, ["paper"], "experiment_id", "natural_key").groupBy("paper", "experiment_id").agg(F.max_by("review_status", "review_no").alias("review_status"))
    both = own.join(projected, ["paper", "experiment_id"], "left").join(reviewed, ["paper", "experiment_id"], "left")
    both = both.join(screened_out.select("paper").distinct().withColumn("__out", F.lit(True)), "paper", "left")
    disposition = F.when(F.col("n_arms").isNotNull(), "projected").when(F.col("review_status").isNotNull(), F.col("review_status")).when(F.col("__out"), "screening_only").otherwise("unexplained")
    return both.select("paper", "experiment_id", disposition.alias("disposition"), F.coalesce("n_arms", F.lit(0)).alias("n_arms"), F.greatest(F.coalesce("n_arms", F.lit(0)) - 1, F.lit(0)).alias("extra_arms"))


def affected_arms(changes: DataFrame, identities: DataFrame, papers: DataFrame, links: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct (experiment_id, entity_type) of arms that changed entities reach.

    ``changes`` and ``identities`` share (paper_id, entity_type, natural_key), the latter adds entity_id. ``papers`` has
    (paper_id, experiment_id), and each of ``links`` (entity_id, experiment_id): one bridge, one join, whatever the path.
    """
    bridge = None
    for name, df in links.items():
        own = df.select(F.lit(name).alias("entity_type"), "entity_id", "experiment_id").where("experiment_id is not null")
        bridge = own if bridge is None else bridge.unionByName(own)
    # changes are few beside identities and links: they are hashed, and the others pass by them unsorted
    few = lambda df: df.distinct().hint("shuffle_hash")
    hit = identities.join(few(changes.select("paper_id", "entity_type", "natural_key")), ["paper_id", "entity_type", "natural_key"]).select("entity_type", "entity_id")
    found = bridge.join(few(hit), ["entity_type", "entity_id"]).select("experiment_id", "entity_type")
    whole = papers.join(few(changes.where("entity_type = 'paper'").select("paper_id")), "paper_id").select("experiment_id", F.lit("paper").alias("entity_type"))
    return found.unionByName(whole).distinct()


def with_conflicts(arms: DataFrame, affected: DataFrame) -> DataFrame:
    """Arms with their status after a conflict: quarantined ones stay so, others are in conflict, and none of these is eligible."""
    hit = affected.groupBy("experiment_id").agg(F.array_join(F.array_sort(F.collect_set("entity_type")), ",").alias("through"))
    is_hit = F.col("through").isNotNull()
    joined = arms.join(hit, "experiment_id", "left")
    return joined.withColumns({"status": F.when(is_hit & (F.col("status") != "quarantined"), "conflict").otherwise(F.col("status")), "eligible": F.col("eligible") & ~is_hit})


def standing(revisions: DataFrame) -> DataFrame:
    """Accepted revisions that no other supersedes."""
    replaced = revisions.where("supersedes is not null").select(F.col("supersedes").alias("revision_id")).distinct()
    return revisions.where("decision = 'accepted'").join(replaced, "revision_id", "left_anti")


def unresolved_missing(missing: DataFrame, revisions: DataFrame, arms: DataFrame) -> DataFrame:
    """Missing fields (experiment_id, field_name, resolved_by) that no standing revision covers.

    A revision speaks for its arm, for all arms of its formulation, or for an outcome of its arm, whose field is then
    named ``outcome:<id>:<field>``; all become (arm, field) and one anti-join decides.
    """
    active = standing(revisions)
    of_arm = active.where("entity_type in ('arm', 'experiment')").select(F.coalesce("entity_id", "experiment_id").alias("experiment_id"), "field_name")
    of_formulation = active.where("entity_type = 'formulation'").select(F.col("entity_id").alias("formulation_id"), "field_name").distinct().join(arms.select("formulation_id", "experiment_id"), "formulation_id").select("experiment_id", "field_name")
    of_outcome = active.where("entity_type = 'outcome'").select("experiment_id", F.concat_ws(":", F.lit("outcome"), F.col("entity_id").cast("string"), "field_name").alias("field_name"))
    covered = of_arm.unionByName(of_formulation).unionByName(of_outcome).distinct().withColumn("__covered", F.lit(True))
    return missing.join(covered, ["experiment_id", "field_name"], "left").where(F.col("resolved_by").isNull() | F.col("__covered").isNull()).drop("__covered")


def evidenced_outcomes(outcomes: DataFrame, links: DataFrame, evidence: DataFrame, revisions: DataFrame) -> DataFrame:
    """``outcomes`` (outcome_id, status) with ``evidenced``.

    It needs the latest link of a field and evidence whose status is the outcome's, and evidence that is manually
    verified, or cited by a standing revision (``review_revision_id`` in the link's JSON), or, for an automatically
    validated outcome, not rejected, in conflict or ambiguous.
    """
    revision = F.get_json_object("content_json", "$.review_revision_id").cast("long").alias("revision_id")
    cited = links.groupBy("outcome_id", "field_name", "evidence_id").agg(F.max_by(F.struct("verification_status", revision), "link_id").alias("l")).select("outcome_id", "evidence_id", "l.*")
    review = F.col("review_status")
    sure = (review == "manually_verified") | (F.col("verification_status") == "automatically_validated") & ~review.isin("rejected", "conflict", "ambiguous")
    state = F.coalesce(sure, F.lit(False)).alias("sure")
    judged = cited.join(evidence, "evidence_id").select("outcome_id", F.col("verification_status").alias("status"), "revision_id", state)
    # links that cite no revision don't join: their nulls would meet in one task
    backed = judged.where("not sure and revision_id is not null").join(standing(revisions).select("revision_id"), "revision_id", "left_semi")
    held = judged.where("sure").select("outcome_id", "status").unionByName(backed.select("outcome_id", "status")).distinct().withColumn("evidenced", F.lit(True))
    return outcomes.join(held, ["outcome_id", "status"], "left").withColumn("evidenced", F.coalesce("evidenced", F.lit(False)))


def sets_check(expected: Column, observed: Column) -> Column:
    """Of two arrays as sets: match, contradiction, unconfirmed where nothing is observed, not applicable where nothing is expected."""
    same = (F.size(F.array_except(expected, observed)) == 0) & (F.size(F.array_except(observed, expected)) == 0)
    return F.when(F.size(expected) == 0, UNASKED).when(F.size(observed) == 0, OPEN).when(same, MATCH).otherwise(CLASH)


def polarity_check(expected: Column, observed: Column) -> Column:
    return F.when(observed.isNull() | (expected == "neutral"), OPEN).when(expected == observed, MATCH).otherwise(CLASH)


def number_check(expected: Column, unit: Column, observed: Column, observed_unit: Column) -> Column:
    """Equal units and values within half of the last decimal of what is observed: 0.5 for whole numbers, 0.05 for 3.2, and at least 0.011."""
    decimals = F.length(F.regexp_extract(F.regexp_replace(F.format_number(F.abs(observed), 12), "0+$", ""), r"[.](\d*)$", 1))
    tolerance = F.when(F.abs(observed - F.round(observed)) < 1e-12, 0.5).otherwise(F.greatest(F.lit(0.011), F.lit(0.5) * F.pow(F.lit(10.0), -decimals)))
    return F.when(expected.isNull(), UNASKED).when(observed.isNull() | observed_unit.isNull(), OPEN).when((unit == observed_unit) & (F.abs(expected - observed) <= tolerance), MATCH).otherwise(CLASH)


def structural_coverage(candidates: DataFrame, outputs: DataFrame) -> DataFrame:
    """A row per candidate: ``verdict``, ``reason``, the ``output_id`` that was selected, and ``route``.

    Both tables have (paper, experiment, cells, endpoints, polarity, value, unit, evidence), candidates also
    candidate_id, eligible and confidence, outputs output_id; an output whose experiment is null has no association.
    Only pairs that share evidence can be confirmed or contradicted, so candidates meet outputs by (paper, evidence id).
    A pair is contradicted if only polarity or value differ, confirmed if nothing is open or differs. One output cannot
    confirm several candidates.
    """
    c = candidates.select("paper", "candidate_id", *(F.col(x).alias(f"c_{x}") for x in ("experiment", "cells", "endpoints", "polarity", "value", "unit")), F.explode(F.array_distinct("evidence")).alias("e"))
    o = outputs.select("paper", "output_id", *(F.col(x).alias(f"o_{x}") for x in ("experiment", "cells", "endpoints", "polarity", "value", "unit")), F.explode(F.array_distinct("evidence")).alias("e"))
    pairs = c.join(o, ["paper", "e"]).dropDuplicates(["paper", "candidate_id", "output_id"])
    checks = {
        "intervention": F.when(F.col("o_experiment").isNull(), OPEN).when(F.col("o_experiment") == F.col("c_experiment"), MATCH).otherwise(CLASH),
        "cells": sets_check(F.col("c_cells"), F.col("o_cells")),
        "relationship": sets_check(F.col("c_endpoints"), F.col("o_endpoints")),
        "polarity": polarity_check(F.col("c_polarity"), F.col("o_polarity")),
        "number": number_check(F.col("c_value"), F.col("c_unit"), F.col("o_value"), F.col("o_unit")),
    }
    seen = pairs.select("paper", "candidate_id", "output_id", *(x.alias(n) for n, x in checks.items()))
    identity = F.array("intervention", "cells", "relationship")
    known = F.forall(identity, lambda x: x.isin(MATCH, UNASKED))
    differs = (F.col("polarity") == CLASH) | (F.col("number") == CLASH)
    opened = F.exists(F.array(*checks), lambda x: x == OPEN)
    verdict = F.when(known & differs, "contradicted").when(opened | ~known, OPEN).otherwise("confirmed")
    rated = seen.withColumn("v", verdict)
    yes, no = F.when(F.col("v") == "confirmed", F.col("output_id")), F.when(F.col("v") == "contradicted", F.col("output_id"))
    per = rated.groupBy("paper", "candidate_id").agg(F.count(yes).alias("n"), F.min(yes).alias("yes"), F.min(no).alias("no"))
    claims = per.where("n = 1").groupBy("paper", F.col("yes").alias("output_id")).agg(F.count("*").alias("claims"))
    selected = F.when(F.col("n") == 1, F.col("yes")).when(F.coalesce("n", F.lit(0)) == 0, F.col("no"))
    full = candidates.select("paper", "candidate_id", "eligible", "confidence").join(per, ["paper", "candidate_id"], "left").withColumn("output_id", selected)
    full = full.join(claims, ["paper", "output_id"], "left").join(outputs.select("paper").distinct().withColumn("__any", F.lit(True)), "paper", "left")
    broad = F.coalesce(F.col("claims") > 1, F.lit(False))
    last = F.when(broad, OPEN).when(F.col("n") == 1, "confirmed").when((F.coalesce("n", F.lit(0)) == 0) & F.col("no").isNotNull(), "contradicted").otherwise(OPEN)
    why = F.when(broad, "one_output_for_several").when(F.col("n") == 1, "one_match").when(F.col("n") > 1, "several_matches").when(F.col("no").isNotNull(), "contradiction").when(F.col("__any"), "no_confirmed_match").otherwise("no_output")
    route = F.when(~F.col("eligible"), "human_review").when(broad, "bounded_repair").when(F.col("verdict") == "confirmed", "none").when(F.col("verdict") == "contradicted", "human_review").when(F.col("confidence") == "high", "bounded_repair").otherwise("human_review")
    return full.withColumns({"verdict": last, "reason": why}).select("paper", "candidate_id", "output_id", "verdict", "reason", route.alias("route"))


def findings(records: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, Column, bool]]) -> DataFrame:
    """(keys, code, repairable): a row per broken rule of each record; a rule that is null is not broken."""
    each = F.array_compact(F.array(*(F.when(broken, F.struct(F.lit(code).alias("code"), F.lit(repairable).alias("repairable"))) for code, broken, repairable in rules)))
    return records.select(*keys, F.inline(each))


def merged_fragments(fragments: DataFrame, findings_: DataFrame, records: DataFrame) -> DataFrame:
    """Each fragment (fragment_id, finding_id, source_hash, field, value) with its disposition.

    It applies if its finding (finding_id, record_id, field, repairable) exists and is repairable, it was made from the
    record's present source and gives exactly the field asked for; of several such, the first by id.
    """
    known = fragments.join(findings_.select("finding_id", "record_id", F.col("field").alias("__field"), "repairable"), "finding_id", "left")
    full = known.join(records.select("record_id", F.col("source_hash").alias("__hash")), "record_id", "left")
    first = F.when(F.col("record_id").isNull(), "unknown_finding").when(~F.col("repairable"), "not_repairable").when(~F.col("source_hash").eqNullSafe(F.col("__hash")), "other_source").when(F.col("field") != F.col("__field"), "other_field")
    rated = full.withColumn("disposition", first)
    chosen = rated.where("disposition is null").groupBy("finding_id").agg(F.min("fragment_id").alias("__chosen"))
    last = F.coalesce("disposition", F.when(F.col("fragment_id") == F.col("__chosen"), "applied").otherwise("second_result"))
    return rated.join(chosen, "finding_id", "left").select("fragment_id", "finding_id", last.alias("disposition"))


def response_problems(tasks: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """Per task, why its response is not valid (nothing, if it is); a task without one is ``no_response``.

    Tasks: ``candidates, evidence, existing`` (arrays), ``most_new``. Responses: ``recovered, unresolved, new_ids, cited``.
    """
    both = tasks.join(responses, key, "left")
    size = lambda a: F.size(a)
    answered = F.array_union("recovered", "unresolved")
    rules = {
        "in_both": size(F.array_intersect("recovered", "unresolved")) == 0,
        "not_all_accounted": (size(F.array_except("candidates", answered)) == 0) & (size(F.array_except(answered, "candidates")) == 0),
        "too_many_new": size("new_ids") <= F.col("most_new"),
        "new_ids_repeat": size(F.array_distinct("new_ids")) == size("new_ids"),
        "ids_reused": size(F.array_intersect("new_ids", "existing")) == 0,
        "unknown_evidence": size(F.array_except("cited", "evidence")) == 0,
    }
    return both.select(key, F.when(F.col("recovered").isNull(), F.array(F.lit("no_response"))).otherwise(reasons(rules)).alias("problems"))


def slot_accounting(slots: DataFrame, outcomes: DataFrame, accounting: DataFrame, identity: Sequence[str], allowed: DataFrame) -> DataFrame:
    """(slot_id, problem): every issued slot is to be accounted for once, with its identity and printed numbers only.

    ``outcomes`` (slot_id, identity, group, value), ``accounting`` (slot_id, disposition: extracted or not_explicit),
    ``allowed`` (group, value) are the numbers that the sources print.
    """
    row = lambda df, kind, said=F.lit(False): df.select("slot_id", F.lit(kind).alias("kind"), said.alias("said"))
    every = row(slots, 0).unionByName(row(accounting, 1, F.coalesce(F.col("disposition") == "extracted", F.lit(False)))).unionByName(row(outcomes, 2))
    n = lambda kind: F.count_if(F.col("kind") == kind)
    both = every.groupBy("slot_id").agg(n(0).alias("n_slots"), n(1).alias("n_accounts"), n(2).alias("n_outcomes"), F.bool_or("said").alias("said"))
    accounts, got, said = F.col("n_accounts"), F.col("n_outcomes"), F.col("said")
    problem = F.when((F.col("n_slots") == 0) | F.col("slot_id").isNull(), "invented").when(accounts == 0, "not_accounted").when((accounts > 1) | (got > 1), "repeated").when(said & (got == 0), "no_outcome").when(~said & (got > 0), "not_extracted")
    of_slots = both.select("slot_id", problem.alias("problem")).where("problem is not null")
    same = F.lit(True)
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    changed = outcomes.join(slots.select("slot_id", *(F.col(c).alias(f"__{c}") for c in identity)), "slot_id").where(~same).select("slot_id", F.lit("identity_changed").alias("problem"))
    unprinted = outcomes.where("value is not null").join(allowed.distinct().hint("shuffle_hash"), ["group", "value"], "left_anti").select("slot_id", F.lit("number_not_printed").alias("problem"))
    return of_slots.unionByName(changed.unionByName(unprinted).distinct())  # a slot's own problem is told once as it is


def issued_registry(registrations: DataFrame, key: str, order: str, fields: Sequence[str], evidence: str) -> DataFrame:
    """A row per issued id: the first value of each field, whether a later one differs, and the evidence of all registrations."""
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields]
    lows = [F.min(c).alias(f"__low_{c}") for c in fields] + [F.max(c).alias(f"__high_{c}") for c in fields]
    per = registrations.groupBy(key).agg(*first, *lows, F.array_join(F.array_sort(F.collect_set(F.col(evidence).cast("string"))), ",").alias("evidence"))
    conflict = reasons({c: F.coalesce(F.col(f"__low_{c}") == F.col(f"__high_{c}"), F.lit(True)) for c in fields})
    return per.select(key, *fields, F.array_join(conflict, ",").alias("conflicts"), (F.size(conflict) == 0).alias("valid"), "evidence")


def filled_places(cells: DataFrame, table: str) -> DataFrame:
    """(table, r, k, text) of the places that cells (r, k, row_span, column_span, place, text) fill with what they span, later ones over earlier ones."""
    filled = cells.select(table, "place", "text", F.explode(F.sequence("r", F.col("r") + F.greatest("row_span", F.lit(1)) - 1)).alias("r"), "k", "column_span").select(table, "place", "text", "r", F.explode(F.sequence("k", F.col("k") + F.greatest("column_span", F.lit(1)) - 1)).alias("k"))
    return filled.groupBy(table, "r", "k").agg(F.max_by("text", "place").alias("text"))


def dense_grid(cells: DataFrame, table: str) -> DataFrame:
    """(table, r, k, text) of every place of a table's grid, empty ones too."""
    top = filled_places(cells, table)
    sizes = top.groupBy(table).agg(F.max("r").alias("rows"), F.max("k").alias("columns"))
    every = sizes.select(table, F.explode(F.sequence(F.lit(0), "rows")).alias("r"), "columns").select(table, "r", F.explode(F.sequence(F.lit(0), "columns")).alias("k"))
    return every.join(top, [table, "r", "k"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def asked_grid(cells: DataFrame, claims: DataFrame, table: str) -> DataFrame:
    """The places of the ``dense_grid`` that can hold a claim's value: empty ones are told for tables only that have a claim with a blank value."""
    blank = claims.where(F.trim("value") == "").select(table).distinct()
    told = lambda df: df.withColumn("text", F.coalesce("text", F.lit("")))
    if blank.isEmpty():
        return told(filled_places(cells, table))
    return told(filled_places(cells.join(blank, table, "left_anti"), table)).unionByName(dense_grid(cells.join(blank, table, "left_semi"), table))


def supported_by_grid(claims: DataFrame, headers: DataFrame, grid: DataFrame, table: str, claim: str) -> DataFrame:
    """(table, claim), each once, of claims (table, subject, endpoint, value) that a row and a column header name and whose value stands where they cross.

    A header names a text if either lies within the other. Values and places are joined first, so only rows and columns
    that hold the value look at their headers.
    """
    either = lambda a, b: F.lower(a).contains(F.lower(b)) | F.lower(b).contains(F.lower(a))
    at = claims.join(grid.select(table, "r", "k", F.lower(F.trim("text")).alias("__value")), table).where(F.lower(F.trim("value")) == F.col("__value"))
    rows = headers.where("is_row_header").select(table, "r", F.col("text").alias("__row")).distinct()
    columns = headers.where("is_column_header").select(table, "k", F.col("text").alias("__column")).distinct()
    named = at.join(rows, [table, "r"]).where(either(F.col("subject"), F.col("__row"))).join(columns, [table, "k"]).where(either(F.col("endpoint"), F.col("__column")))
    return named.select(table, claim).distinct()


def recalled_outcomes(gold: DataFrame, found: DataFrame) -> DataFrame:
    """(paper, gold_id, recalled): a candidate of the paper at the same location with two common tokens, or with four, all of the value's among them.

    Both have (paper, location, tokens); gold has ``value_tokens``. Pairs meet by location, or by a token of the value. Rows that meet by token
    are numbers; their tokens join later. Spark takes lists of tokens for smaller than they are, so joins that carry them ask for a merge.
    """
    g = written(gold.select("paper", "gold_id", F.col("location").alias("__at"), F.col("tokens").alias("__tokens"), "value_tokens", F.monotonically_increasing_id().alias("__g")), "gold-rows")
    f = written(found.select("paper", F.col("location").alias("__at"), "tokens", F.monotonically_increasing_id().alias("__f")), "found-rows")
    near = g.join(f.hint("merge"), ["paper", "__at"]).where(F.size(F.array_intersect("__tokens", "tokens")) >= 2)
    by_token = f.select("paper", "__f", F.explode(F.array_distinct("tokens")).alias("__token"))
    asked = g.where(F.size("value_tokens") > 0).select("paper", "__g", F.element_at("value_tokens", 1).alias("__token"))
    met = asked.join(by_token.hint("merge"), ["paper", "__token"]).select("__g", "__f")
    common = F.array_intersect("__tokens", "tokens")
    whole = met.join(g.drop("__at").hint("merge"), "__g").join(f.select("__f", "tokens").hint("merge"), "__f")
    strong = whole.where((F.size(common) >= 4) & (F.size(F.array_except("value_tokens", common)) == 0))
    hit = near.select("paper", "gold_id").unionByName(strong.select("paper", "gold_id")).distinct().withColumn("recalled", F.lit(True))
    return gold.select("paper", "gold_id").join(hit, ["paper", "gold_id"], "left").withColumn("recalled", F.coalesce("recalled", F.lit(False)))


def first_of_equals(df: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """(id, digest, duplicate_of): the first row by id of equal content is the canonical one, others point to it."""
    own = df.select(id_col, digest.alias("digest"))
    firsts = own.groupBy("digest").agg(F.min(id_col).alias("__first"))
    return own.join(firsts, "digest").select(id_col, "digest", F.when(F.col(id_col) != F.col("__first"), F.col("__first")).alias("duplicate_of"))


def repair_tasks(candidates: DataFrame, evidence: DataFrame, most: int = 12, most_outcomes: int = 8) -> DataFrame:
    """A task per component: how many candidates, its first ``most`` distinct evidence ids in candidate order, how many new outcomes it may make, and a checksum.

    ``candidates`` (component, candidate_id), ``evidence`` (candidate_id, place, evidence_id).
    """
    per = candidates.groupBy("component").agg(F.countDistinct("candidate_id").alias("n"))
    seen = candidates.join(evidence, "candidate_id").groupBy("component", "evidence_id").agg(F.min(F.struct("candidate_id", "place")).alias("at"))
    w = Window.partitionBy("component").orderBy("at", "evidence_id")
    kept = seen.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    lists = kept.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("k", F.col("evidence_id").cast("string").alias("e")))).alias("l")).select("component", F.array_join(F.transform("l", lambda x: x["e"]), ",").alias("evidence"))
    allowance = F.least(F.lit(most_outcomes), F.greatest(F.lit(1), 2 * F.col("n"))).alias("most_new")
    tasks = per.join(lists, "component", "left").select("component", "n", allowance, F.coalesce("evidence", F.lit("")).alias("evidence"))
    return tasks.withColumn("checksum", F.sha2(F.concat_ws("|", F.col("component").cast("string"), F.col("n").cast("string"), "evidence"), 256))


def structural_signature(parts: Sequence[Column], subject: Column, object_: Column, plain: Column) -> Column:
    """JSON of the parts in order, nulls as empty texts; subject and object only where ``plain`` says that nothing else tells claims apart."""
    own = [F.coalesce(p, F.lit("")) for p in parts]
    return F.to_json(F.when(plain, F.array(*own, F.coalesce(subject, F.lit("")), F.coalesce(object_, F.lit("")))).otherwise(F.array(*own)))


def stable_id(prefix: str, *identity: Column) -> Column:
    """An id made from what it stands for, with nulls told from empty texts and no way to run fields together."""
    return F.concat(F.lit(prefix), digest(*identity).substr(1, 16))


def appended_once(known: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key is neither known nor came earlier in ``incoming``: writing them twice changes nothing. Equal keys are equal rows."""
    return incoming.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def last_registered(registrations: DataFrame, key: str, order: str) -> DataFrame:
    """The last registration of each key, all columns."""
    columns = [c for c in registrations.columns if c != key]
    return registrations.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("r")).select(key, "r.*")


def recovered(copies: DataFrame, key: str, root: str, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Per key, the first root in order where all checks pass, or what is wrong at the first root."""
    why = F.lit(None).cast("string")
    for name, good in reversed(checks):
        why = F.when(~F.coalesce(good, F.lit(False)), name).otherwise(why)
    rated = copies.select(key, F.col(root).alias("root"), why.alias("why"))
    per = rated.groupBy(key).agg(F.min(F.when(F.col("why").isNull(), F.col("root"))).alias("root"), F.min_by("why", "root").alias("why"))
    return per.select(key, "root", F.when(F.col("root").isNull(), F.col("why")).alias("blocked_by"))


def verified_manifest(frozen: DataFrame, present: DataFrame, key: str, digest: str) -> DataFrame:
    """Each key of either manifest: unchanged, changed, missing or added."""
    both = frozen.select(key, F.col(digest).alias("__a")).join(present.select(key, F.col(digest).alias("__b")), key, "full")
    state = F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "added").when(F.col("__a") == F.col("__b"), "unchanged").otherwise("changed")
    return both.select(key, state.alias("state"))


def route_envelope(candidates: Mapping[str, DataFrame], packet: DataFrame) -> DataFrame:
    """(paper, evidence_id, origin, in_packet): evidence that candidates of any origin cite, once each, the first origin named, and whether the packet has it."""
    each = None
    for rank, (name, df) in enumerate(candidates.items()):
        own = df.select("paper", "evidence_id", F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("origin")).alias("o"))
        each = own if each is None else each.unionByName(own)
    once = each.groupBy("paper", "evidence_id").agg(F.min("o")["origin"].alias("origin"))
    inside = packet.select("paper", "evidence_id").distinct().withColumn("__in", F.lit(True))
    return once.join(inside, ["paper", "evidence_id"], "left").select("paper", "evidence_id", "origin", F.coalesce("__in", F.lit(False)).alias("in_packet"))


def visual_referrals(records: DataFrame, visuals: DataFrame, passages: DataFrame, most: int = 3) -> DataFrame:
    """Each unresolved field-level finding with the one visual it refers to and its first passages, or why it is not referred.

    ``records`` (paper, finding_id, field_level, resolved, object), ``visuals`` (paper, object, page), ``passages`` (paper, object, place, passage).
    """
    per = visuals.groupBy("paper", "object").agg(F.countDistinct("page").alias("pages"), F.min("page").alias("page"))
    w = Window.partitionBy("paper", "object").orderBy("place", "passage")
    near = passages.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    lists = near.groupBy("paper", "object").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "passage"))), lambda x: x["passage"].cast("string")), ",").alias("passages"))
    why = F.when(~F.col("field_level"), "not_a_field").when(F.col("resolved"), "resolved").when(F.col("pages").isNull(), "no_visual").when(F.col("pages") > 1, "several_visuals").otherwise("referred")
    full = records.join(per, ["paper", "object"], "left").join(lists, ["paper", "object"], "left").withColumn("outcome", why)
    referred = F.col("outcome") == "referred"
    return full.select("paper", "finding_id", "outcome", F.when(referred, F.col("page")).alias("page"), F.when(referred, F.coalesce("passages", F.lit(""))).alias("passages"))
