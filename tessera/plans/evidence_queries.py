"""Queries of evidence records. Customers stand for papers, orders for arms, their priorities for formulations, lines for outcomes and claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import evidence as V
from tessera.plans.registry import Tables, query


def priority():
    return F.substring("o_orderpriority", 1, 1).cast("long")


def arms(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "quarantined").otherwise("complete")
    return t.orders.select(F.col("o_custkey").alias("paper_id"), F.col("o_orderkey").alias("experiment_id"), (F.col("o_custkey") * 10 + priority()).alias("formulation_id"), status.alias("status"), (status == "complete").alias("eligible"))


ARMS = """a AS (SELECT o_custkey AS paper_id, o_orderkey AS experiment_id, o_custkey * 10 + o_orderpriority[1]::BIGINT AS formulation_id, CASE WHEN o_orderstatus = 'P' THEN 'quarantined' ELSE 'complete' END AS status FROM orders)"""


@query("jon17_contained_ids", """
WITH n AS (SELECT DISTINCT o_custkey AS paper, 'x' || o_orderkey % 50 AS id FROM orders), h AS (SELECT o_custkey AS paper, o_orderkey, 'arm-x' || o_orderkey % 500 || '-' || o_orderstatus AS record_id FROM orders)
SELECT paper, id, o_orderkey FROM n JOIN h USING (paper) WHERE contains(record_id, id)""")
def jon17(t):
    """Ids that lie within the keys of records of the same paper."""
    needles = t.orders.select(F.col("o_custkey").alias("paper"), F.concat(F.lit("x"), F.col("o_orderkey") % 50).alias("id")).distinct()
    hays = t.orders.select(F.col("o_custkey").alias("paper"), "o_orderkey", F.concat(F.lit("arm-x"), F.col("o_orderkey") % 500, F.lit("-"), "o_orderstatus").alias("record_id"))
    return V.contained(needles, hays, ["paper"], "id", "record_id").select("paper", "id", "o_orderkey")


@query("pip27_projection_audit", """
WITH e AS (SELECT DISTINCT o_custkey AS paper, 'x' || o_orderkey % 50 AS id FROM orders), m AS (SELECT o_custkey AS paper, 'arm-x' || o_orderkey % 500 AS record_id FROM orders WHERE o_orderstatus = 'F'),
v AS (SELECT o_custkey AS paper, o_orderkey AS no, 'rev-x' || o_orderkey % 500 AS k, CASE WHEN o_totalprice > 200000 THEN 'accepted' ELSE 'review' END AS s FROM orders WHERE o_orderstatus <> 'F'),
p AS (SELECT paper, id, count(*) AS n FROM e JOIN m USING (paper) WHERE contains(record_id, id) GROUP BY 1, 2), r AS (SELECT paper, id, arg_max(s, no) AS s FROM e JOIN v USING (paper) WHERE contains(k, id) GROUP BY 1, 2),
o AS (SELECT c_custkey AS paper FROM customer WHERE c_acctbal < 0)
SELECT paper, id AS experiment_id, CASE WHEN n IS NOT NULL THEN 'projected' WHEN s IS NOT NULL THEN s WHEN paper IN (SELECT paper FROM o) THEN 'screening_only' ELSE 'unexplained' END AS disposition,
  coalesce(n, 0) AS n_arms, greatest(coalesce(n, 0) - 1, 0) AS extra_arms FROM e LEFT JOIN p USING (paper, id) LEFT JOIN r USING (paper, id)""")
def pip27(t):
    o = t.orders.select(F.col("o_custkey").alias("paper"), "o_orderkey", "o_orderstatus", "o_totalprice")
    experiments = o.select("paper", F.concat(F.lit("x"), F.col("o_orderkey") % 50).alias("experiment_id"))
    records = o.where("o_orderstatus = 'F'").select("paper", F.concat(F.lit("arm-x"), F.col("o_orderkey") % 500).alias("record_id"))
    reviews = o.where("o_orderstatus <> 'F'").select("paper", F.concat(F.lit("rev-x"), F.col("o_orderkey") % 500).alias("natural_key"), F.when(F.col("o_totalprice") > 200000, "accepted").otherwise("review").alias("review_status"), F.col("o_orderkey").alias("review_no"))
    return V.projection_audit(experiments, records, reviews, t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("paper")))


@query("ext06_conflict_propagation", f"""
WITH {ARMS}, f AS (SELECT DISTINCT paper_id, formulation_id FROM a), o AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS experiment_id FROM lineitem), e AS (SELECT DISTINCT l_partkey * 10000000 + l_orderkey AS id, l_orderkey AS experiment_id FROM lineitem),
hit AS (SELECT experiment_id, 'paper' AS via FROM a WHERE paper_id % 97 = 0 UNION SELECT experiment_id, 'formulation' FROM a WHERE formulation_id % 101 = 0 UNION SELECT experiment_id, 'chemical_component' FROM a WHERE (formulation_id * 3 + 1) % 103 = 0
  UNION SELECT experiment_id, 'experiment' FROM a WHERE experiment_id % 107 = 0 UNION SELECT experiment_id, 'outcome' FROM o WHERE id % 1009 = 0 UNION SELECT experiment_id, 'evidence' FROM e WHERE id % 1013 = 0),
h AS (SELECT experiment_id, string_agg(via, ',' ORDER BY via) AS through FROM hit GROUP BY 1)
SELECT experiment_id, through, CASE WHEN through IS NOT NULL AND status <> 'quarantined' THEN 'conflict' ELSE status END AS status, status = 'complete' AND through IS NULL AS eligible FROM a LEFT JOIN h USING (experiment_id)""")
def ext06(t):
    """Changed papers, formulations, components, arms, outcomes and evidence, and the arms that they put in conflict."""
    a = arms(t)
    pairs = {
        "formulation": a.select(F.col("formulation_id").alias("entity_id"), "experiment_id", "paper_id"),
        "chemical_component": a.select((F.col("formulation_id") * 3 + 1).alias("entity_id"), "experiment_id", "paper_id"),
        "experiment": a.select(F.col("experiment_id").alias("entity_id"), "experiment_id", "paper_id"),
    }
    entity = {"outcome": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "evidence": F.col("l_partkey") * 10000000 + F.col("l_orderkey")}
    papers_of = t.orders.select(F.col("o_orderkey").alias("experiment_id"), F.col("o_custkey").alias("paper_id"))
    links = {n: df.select("entity_id", "experiment_id") for n, df in pairs.items()} | {n: t.lineitem.select(c.alias("entity_id"), F.col("l_orderkey").alias("experiment_id")) for n, c in entity.items()}
    pairs |= {n: links[n].join(papers_of, "experiment_id") for n in entity}
    every = {"formulation": 101, "chemical_component": 103, "experiment": 107, "outcome": 1009, "evidence": 1013}
    identities = changes = None
    for name, df in pairs.items():
        own = df.select("paper_id", F.lit(name).alias("entity_type"), F.concat_ws("-", F.lit(name), F.col("entity_id").cast("string")).alias("natural_key"), "entity_id")
        changed = own.where(F.col("entity_id") % every[name] == 0).drop("entity_id")
        identities = own if identities is None else identities.unionByName(own)
        changes = changed if changes is None else changes.unionByName(changed)
    papers = t.customer.where("c_custkey % 97 = 0").select(F.col("c_custkey").alias("paper_id"), F.lit("paper").alias("entity_type"), F.concat_ws("-", F.lit("paper"), F.col("c_custkey").cast("string")).alias("natural_key"))
    affected = V.affected_arms(changes.unionByName(papers), identities, a.select("paper_id", "experiment_id"), links)
    return V.with_conflicts(a, affected).select("experiment_id", "through", "status", "eligible")


REVISIONS = """r AS (SELECT event_id AS revision_id, CASE WHEN value > 40 THEN 'accepted' ELSE 'rejected' END AS decision, CASE WHEN event_id % 5 = 0 THEN event_id - 1 END AS supersedes, ['arm', 'experiment', 'formulation', 'outcome'][event_id % 4 + 1] AS entity_type,
  user_id AS experiment_id, CASE event_id % 4 WHEN 2 THEN user_id % 20 WHEN 3 THEN event_id % 10 ELSE CASE WHEN event_id % 8 <> 0 THEN user_id END END AS entity_id, 'f' || event_id % 3 AS field_name FROM events),
s AS (SELECT * FROM r WHERE decision = 'accepted' AND revision_id NOT IN (SELECT supersedes FROM r WHERE supersedes IS NOT NULL))"""


def revisions(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    kind = F.when(k == 0, "arm").when(k == 1, "experiment").when(k == 2, "formulation").otherwise("outcome")
    entity = F.when(k == 2, F.col("user_id") % 20).when(k == 3, F.col("event_id") % 10).when(F.col("event_id") % 8 != 0, F.col("user_id"))
    return t.events.select(
        F.col("event_id").alias("revision_id"), F.when(F.col("value") > 40, "accepted").otherwise("rejected").alias("decision"), F.when(F.col("event_id") % 5 == 0, F.col("event_id") - 1).alias("supersedes"),
        kind.alias("entity_type"), F.col("user_id").alias("experiment_id"), entity.alias("entity_id"), F.concat(F.lit("f"), F.col("event_id") % 3).alias("field_name"),
    )


@query("ext10_unresolved_missing", f"""
WITH {REVISIONS}, m AS (SELECT DISTINCT user_id AS experiment_id, CASE WHEN event_id % 2 = 0 THEN 'f' || event_id % 3 ELSE 'outcome:' || event_id % 10 || ':f' || event_id % 3 END AS field_name, CASE WHEN user_id % 4 > 0 THEN 1 END AS resolved_by FROM events)
SELECT experiment_id, field_name FROM m WHERE resolved_by IS NULL OR NOT EXISTS (SELECT 1 FROM s WHERE (entity_type IN ('arm', 'experiment') AND coalesce(entity_id, s.experiment_id) = m.experiment_id AND s.field_name = m.field_name)
  OR (entity_type = 'formulation' AND entity_id = m.experiment_id % 20 AND s.field_name = m.field_name) OR (entity_type = 'outcome' AND s.experiment_id = m.experiment_id AND m.field_name = 'outcome:' || entity_id || ':' || s.field_name))""")
def ext10(t):
    own = F.concat(F.lit("f"), F.col("event_id") % 3)
    field = F.when(F.col("event_id") % 2 == 0, own).otherwise(F.concat(F.lit("outcome:"), F.col("event_id") % 10, F.lit(":"), own))
    missing = t.events.select(F.col("user_id").alias("experiment_id"), field.alias("field_name"), F.when(F.col("user_id") % 4 > 0, 1).alias("resolved_by")).distinct()
    users = t.events.select(F.col("user_id").alias("experiment_id"), (F.col("user_id") % 20).alias("formulation_id")).distinct()
    return V.unresolved_missing(missing, revisions(t), users).select("experiment_id", "field_name")


@query("ext11_outcome_evidence", f"""
WITH {REVISIONS}, l AS (SELECT event_id AS link_id, user_id AS outcome_id, event_type AS field_name, event_id % 200 AS evidence_id, ['automatically_validated', 'manually_verified', 'conflict'][event_id % 3 + 1] AS st, CASE WHEN event_id % 6 = 1 THEN event_id - 1 END AS rev FROM events),
last_ AS (SELECT * FROM l WHERE link_id IN (SELECT max(link_id) FROM l GROUP BY outcome_id, field_name, evidence_id)),
o AS (SELECT DISTINCT user_id AS outcome_id, CASE WHEN user_id % 2 = 0 THEN 'automatically_validated' ELSE 'manually_verified' END AS status FROM events)
SELECT outcome_id, status, EXISTS (SELECT 1 FROM last_ WHERE last_.outcome_id = o.outcome_id AND st = status AND (evidence_id % 7 = 4 OR rev IN (SELECT revision_id FROM s) OR (status = 'automatically_validated' AND evidence_id % 7 NOT IN (1, 2, 3)))) AS evidenced FROM o""")
def ext11(t):
    k = F.col("event_id") % 3
    state = F.when(k == 0, "automatically_validated").when(k == 1, "manually_verified").otherwise("conflict")
    content = F.to_json(F.struct(F.when(F.col("event_id") % 6 == 1, F.col("event_id") - 1).alias("review_revision_id")))
    links = t.events.select(F.col("event_id").alias("link_id"), F.col("user_id").alias("outcome_id"), F.col("event_type").alias("field_name"), (F.col("event_id") % 200).alias("evidence_id"), state.alias("verification_status"), content.alias("content_json"))
    e = F.col("id") % 7
    evidence = t.spark.range(200).select(F.col("id").alias("evidence_id"), F.when(e == 1, "rejected").when(e == 2, "conflict").when(e == 3, "ambiguous").when(e == 4, "manually_verified").otherwise("pending").alias("review_status"))
    outcomes = t.events.select(F.col("user_id").alias("outcome_id"), F.when(F.col("user_id") % 2 == 0, "automatically_validated").otherwise("manually_verified").alias("status")).distinct()
    return V.evidenced_outcomes(outcomes, links, evidence, revisions(t))


@query("pip10_ext21_structural_coverage", """
WITH r AS (SELECT DISTINCT l_orderkey AS paper, l_partkey * 100 + l_linenumber AS id, l_linenumber % 2 AS x, CASE WHEN l_partkey % 5 > 0 THEN l_returnflag END AS cell, CASE WHEN l_partkey % 7 > 0 THEN l_linestatus END AS ep,
  ['positive', 'negative', 'positive', 'neutral', 'positive'][l_partkey % 5 + 1] AS pol, CASE WHEN l_partkey % 3 > 0 THEN (l_partkey % 4)::DOUBLE END AS val, l_partkey % 3 AS e1, 10 + l_partkey % 2 AS e2 FROM lineitem),
c AS (SELECT * FROM r WHERE id % 2 = 1), o AS (SELECT paper, id, CASE WHEN id % 11 > 0 THEN x END AS x, cell, ep, CASE WHEN pol <> 'neutral' THEN pol END AS pol, val, e1, e2 FROM r WHERE id % 2 = 0),
pairs AS (SELECT c.paper, c.id AS cid, o.id AS oid,
  CASE WHEN o.x IS NULL THEN 'u' WHEN o.x = c.x THEN 'm' ELSE 'c' END AS i, CASE WHEN c.cell IS NULL THEN 'n' WHEN o.cell IS NULL THEN 'u' WHEN c.cell = o.cell THEN 'm' ELSE 'c' END AS cl, CASE WHEN c.ep IS NULL THEN 'n' WHEN o.ep IS NULL THEN 'u' WHEN c.ep = o.ep THEN 'm' ELSE 'c' END AS rl,
  CASE WHEN o.pol IS NULL OR c.pol = 'neutral' THEN 'u' WHEN c.pol = o.pol THEN 'm' ELSE 'c' END AS pl, CASE WHEN c.val IS NULL THEN 'n' WHEN o.val IS NULL THEN 'u' WHEN abs(c.val - o.val) <= 0.5 THEN 'm' ELSE 'c' END AS nm
  FROM c JOIN o ON c.paper = o.paper AND (c.e1 = o.e1 OR c.e2 = o.e2)),
v AS (SELECT *, CASE WHEN i IN ('m', 'n') AND cl IN ('m', 'n') AND rl IN ('m', 'n') AND (pl = 'c' OR nm = 'c') THEN 'contradicted' WHEN 'u' IN (i, cl, rl, pl, nm) OR 'c' IN (i, cl, rl) THEN 'unconfirmed' ELSE 'confirmed' END AS v FROM pairs),
p AS (SELECT paper, cid, count(*) FILTER (WHERE v = 'confirmed') AS n, min(oid) FILTER (WHERE v = 'confirmed') AS yes, min(oid) FILTER (WHERE v = 'contradicted') AS no FROM v GROUP BY 1, 2),
k AS (SELECT paper, yes AS oid, count(*) AS claims FROM p WHERE n = 1 GROUP BY 1, 2),
f AS (SELECT c.paper, c.id, CASE WHEN n = 1 THEN yes WHEN coalesce(n, 0) = 0 THEN no END AS sel, coalesce(n, 0) AS n, no FROM c LEFT JOIN p ON p.paper = c.paper AND p.cid = c.id),
g AS (SELECT f.*, coalesce(claims > 1, FALSE) AS broad, f.paper IN (SELECT paper FROM o) AS any_ FROM f LEFT JOIN k ON k.paper = f.paper AND k.oid = f.sel),
h AS (SELECT *, CASE WHEN broad THEN 'unconfirmed' WHEN n = 1 THEN 'confirmed' WHEN n = 0 AND no IS NOT NULL THEN 'contradicted' ELSE 'unconfirmed' END AS verdict FROM g)
SELECT paper, id AS candidate_id, sel AS output_id, verdict, CASE WHEN broad THEN 'one_output_for_several' WHEN n = 1 THEN 'one_match' WHEN n > 1 THEN 'several_matches' WHEN no IS NOT NULL THEN 'contradiction' WHEN any_ THEN 'no_confirmed_match' ELSE 'no_output' END AS reason,
  CASE WHEN id % 13 = 0 THEN 'human_review' WHEN broad THEN 'bounded_repair' WHEN verdict = 'confirmed' THEN 'none' WHEN verdict = 'contradicted' THEN 'human_review' WHEN id % 3 = 0 THEN 'bounded_repair' ELSE 'human_review' END AS route FROM h""")
def pip10(t):
    """Odd lines are candidates, even ones outputs, so every line has a role."""
    p = F.col("l_partkey")
    some = lambda c, k: F.when(p % k > 0, F.array(c)).otherwise(F.array().cast("array<string>"))
    polarity = F.when(p % 5 == 1, "negative").when(p % 5 == 3, "neutral").otherwise("positive")
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("paper"), (p * 100 + F.col("l_linenumber")).alias("id"), (F.col("l_linenumber") % 2).alias("experiment"), some("l_returnflag", 5).alias("cells"), some("l_linestatus", 7).alias("endpoints"),
        polarity.alias("polarity"), F.when(p % 3 > 0, (p % 4).cast("double")).alias("value"), F.lit("percent").alias("unit"), F.array(p % 3, 10 + p % 2).alias("evidence"),
    ).distinct()
    candidates = rows.where("id % 2 = 1").withColumnRenamed("id", "candidate_id").withColumns({"eligible": F.col("candidate_id") % 13 != 0, "confidence": F.when(F.col("candidate_id") % 3 == 0, "high").otherwise("low")})
    outputs = rows.where("id % 2 = 0").withColumnRenamed("id", "output_id").withColumns({"experiment": F.when(F.col("output_id") % 11 > 0, F.col("experiment")), "polarity": F.when(F.col("polarity") != "neutral", F.col("polarity"))})
    return V.structural_coverage(candidates, outputs)


@query("pip12_validation_findings", """
WITH j AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN left(props, 4) ELSE props END AS props, value FROM events)
SELECT event_id, 'not_json' AS code, FALSE AS repairable FROM j WHERE NOT json_valid(props)
UNION ALL SELECT event_id, 'k_too_large', TRUE FROM j WHERE json_valid(props) AND (json_extract_string(props, '$.k'))::BIGINT > 50
UNION ALL SELECT event_id, 'unit_missing', TRUE FROM j WHERE json_valid(props) AND json_extract_string(props, '$.unit') IS NULL
UNION ALL SELECT event_id, 'value_negative', TRUE FROM j WHERE value < 0""")
def pip12(t):
    j = t.events.withColumn("props", F.when(F.col("event_id") % 17 == 0, F.substring("props", 1, 4)).otherwise(F.col("props")))
    valid = F.get_json_object("props", "$").isNotNull()
    rules = [("not_json", ~valid, False), ("k_too_large", valid & (F.get_json_object("props", "$.k").cast("long") > 50), True), ("unit_missing", valid & F.get_json_object("props", "$.unit").isNull(), True), ("value_negative", F.col("value") < 0, True)]
    return V.findings(j, ["event_id"], rules)


@query("pip14_merged_fragments", """
WITH f AS (SELECT o_orderkey AS fragment_id, o_custkey AS finding_id, CASE WHEN o_orderkey % 10 = 0 THEN -1 ELSE c_nationkey END AS h, CASE WHEN o_orderkey % 7 = 0 THEN 'name' ELSE 'segment' END AS field, c_custkey AS rec, c_acctbal, c_nationkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 5 > 0),
d AS (SELECT *, CASE WHEN rec IS NULL THEN 'unknown_finding' WHEN c_acctbal < 0 THEN 'not_repairable' WHEN h IS DISTINCT FROM c_nationkey THEN 'other_source' WHEN field <> 'segment' THEN 'other_field' END AS x FROM f),
c AS (SELECT finding_id, min(fragment_id) AS first_ FROM d WHERE x IS NULL GROUP BY 1)
SELECT fragment_id, finding_id, coalesce(x, CASE WHEN fragment_id = first_ THEN 'applied' ELSE 'second_result' END) AS disposition FROM d LEFT JOIN c USING (finding_id)""")
def pip14(t):
    findings = t.customer.where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("finding_id"), F.col("c_custkey").alias("record_id"), F.lit("segment").alias("field"), (F.col("c_acctbal") >= 0).alias("repairable"))
    records = t.customer.select(F.col("c_custkey").alias("record_id"), F.col("c_nationkey").alias("source_hash"))
    made = t.orders.join(records.withColumnRenamed("record_id", "o_custkey"), "o_custkey", "left")
    fragments = made.select(F.col("o_orderkey").alias("fragment_id"), F.col("o_custkey").alias("finding_id"), F.when(F.col("o_orderkey") % 10 == 0, -1).otherwise(F.col("source_hash")).alias("source_hash"), F.when(F.col("o_orderkey") % 7 == 0, "name").otherwise("segment").alias("field"))
    return V.merged_fragments(fragments, findings, records)


@query("ext49_response_problems", """
WITH t AS (SELECT l_orderkey AS k, list_distinct(list(l_linenumber)) AS cand, list_distinct(list(l_partkey)) AS ev, list_distinct(list(l_suppkey) FILTER (WHERE l_linenumber > 4)) AS ex FROM lineitem GROUP BY 1),
r AS (SELECT l_orderkey AS k, coalesce(list_distinct(list(l_linenumber) FILTER (WHERE l_returnflag = 'R')), []) AS rec, coalesce(list_distinct(list(l_linenumber) FILTER (WHERE l_returnflag <> 'R' AND l_discount < 0.095)), []) AS unr,
  coalesce(list(l_suppkey) FILTER (WHERE l_linenumber < 3), []) AS new_, list(CASE WHEN l_tax > 0.079 THEN -1 ELSE l_partkey END) AS cited FROM lineitem WHERE l_orderkey % 9 > 0 GROUP BY 1),
x AS (SELECT t.k, rec, list_filter([CASE WHEN len(list_intersect(rec, unr)) > 0 THEN 'in_both' END, CASE WHEN len(list_distinct(list_concat(rec, unr))) < len(cand) THEN 'not_all_accounted' END, CASE WHEN len(new_) > 4 THEN 'too_many_new' END,
  CASE WHEN len(list_distinct(new_)) < len(new_) THEN 'new_ids_repeat' END, CASE WHEN len(list_intersect(new_, coalesce(ex, []))) > 0 THEN 'ids_reused' END, CASE WHEN list_contains(cited, -1) THEN 'unknown_evidence' END], lambda v: v IS NOT NULL) AS p FROM t LEFT JOIN r USING (k))
SELECT k, CASE WHEN rec IS NULL THEN 'no_response' ELSE array_to_string(p, ',') END AS problems FROM x""")
def ext49(t):
    keyed = t.lineitem.withColumn("k", F.col("l_orderkey"))
    only = lambda c, v: F.when(c, v)
    tasks = keyed.groupBy("k").agg(F.collect_set("l_linenumber").alias("candidates"), F.collect_set("l_partkey").alias("evidence"), F.collect_set(only(F.col("l_linenumber") > 4, F.col("l_suppkey"))).alias("existing")).withColumn("most_new", F.lit(4))
    responses = keyed.where("k % 9 > 0").groupBy("k").agg(
        F.collect_set(only(F.col("l_returnflag") == "R", F.col("l_linenumber"))).alias("recovered"), F.collect_set(only((F.col("l_returnflag") != "R") & (F.col("l_discount") < 0.095), F.col("l_linenumber"))).alias("unresolved"),
        F.collect_list(only(F.col("l_linenumber") < 3, F.col("l_suppkey"))).alias("new_ids"), F.collect_list(F.when(F.col("l_tax") > 0.079, F.lit(-1)).otherwise(F.col("l_partkey"))).alias("cited"),
    )
    return V.response_problems(tasks, responses, "k").select("k", F.array_join("problems", ",").alias("problems"))


@query("pip15_ext29_slot_accounting", """
WITH s AS (SELECT l_orderkey * 10 + l_linenumber AS slot_id, min(l_partkey) AS part FROM lineitem WHERE l_suppkey % 8 > 0 GROUP BY 1), o AS (SELECT l_orderkey * 10 + l_linenumber AS slot_id, l_partkey AS part, l_orderkey AS g, CASE WHEN l_tax > 0.02 THEN l_quantity END AS v FROM lineitem WHERE l_returnflag = 'R'),
a AS (SELECT l_orderkey * 10 + l_linenumber AS slot_id, count(*) AS n, bool_or(l_returnflag <> 'A') AS ex FROM lineitem WHERE l_linenumber < 7 GROUP BY 1), n AS (SELECT slot_id, count(*) AS n FROM o GROUP BY 1), w AS (SELECT DISTINCT l_orderkey AS g, l_quantity AS v FROM lineitem WHERE l_linestatus = 'F'),
b AS (SELECT slot_id, s.slot_id IS NOT NULL AS slot, a.n AS accounts, coalesce(n.n, 0) AS got, coalesce(ex, FALSE) AS ex FROM (SELECT slot_id FROM s UNION SELECT slot_id FROM a UNION SELECT slot_id FROM o) LEFT JOIN s USING (slot_id) LEFT JOIN a USING (slot_id) LEFT JOIN n USING (slot_id))
SELECT slot_id, CASE WHEN NOT slot THEN 'invented' WHEN accounts IS NULL THEN 'not_accounted' WHEN accounts > 1 OR got > 1 THEN 'repeated' WHEN ex AND got = 0 THEN 'no_outcome' ELSE 'not_extracted' END AS problem FROM b WHERE NOT slot OR accounts IS NULL OR accounts > 1 OR got > 1 OR (ex AND got = 0) OR (NOT ex AND got > 0)
UNION SELECT slot_id, 'identity_changed' FROM o JOIN s USING (slot_id) WHERE o.part <> s.part UNION SELECT slot_id, 'number_not_printed' FROM o WHERE v IS NOT NULL AND (g, v) NOT IN (SELECT (g, v) FROM w)""")
def pip15(t):
    rows = t.lineitem.withColumns({"slot_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "part": F.col("l_partkey"), "group": F.col("l_orderkey")})
    slots = rows.where("l_suppkey % 8 > 0").groupBy("slot_id").agg(F.min("part").alias("part"))
    outcomes = rows.where("l_returnflag = 'R'").select("slot_id", "part", "group", F.when(F.col("l_tax") > 0.02, F.col("l_quantity")).alias("value"))
    accounting = rows.where("l_linenumber < 7").select("slot_id", F.when(F.col("l_returnflag") != "A", "extracted").otherwise("not_explicit").alias("disposition"))
    return V.slot_accounting(slots, outcomes, accounting, ["part"], rows.where("l_linestatus = 'F'").select("group", F.col("l_quantity").alias("value")))


@query("ext27_issued_registry", """
WITH r AS (SELECT user_id, event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS candidate, CASE WHEN user_id % 5 > 0 THEN 'cell' || user_id % 4 ELSE 'cell' || event_id % 2 END AS cell, event_id % 7 AS e FROM events)
SELECT user_id, arg_min(candidate, event_id) FILTER (WHERE candidate IS NOT NULL) AS candidate, arg_min(cell, event_id) AS cell, concat_ws(',', CASE WHEN count(DISTINCT candidate) > 1 THEN 'candidate' END, CASE WHEN count(DISTINCT cell) > 1 THEN 'cell' END) AS conflicts,
  count(DISTINCT candidate) <= 1 AND count(DISTINCT cell) <= 1 AS valid, string_agg(DISTINCT e::VARCHAR, ',' ORDER BY e::VARCHAR) AS evidence FROM r GROUP BY 1""")
def ext27(t):
    cell = F.when(F.col("user_id") % 5 > 0, F.concat(F.lit("cell"), F.col("user_id") % 4)).otherwise(F.concat(F.lit("cell"), F.col("event_id") % 2))
    r = t.events.select("user_id", "event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("candidate"), cell.alias("cell"), (F.col("event_id") % 7).alias("e"))
    return V.issued_registry(r, "user_id", "event_id", ["candidate", "cell"], "e")


CELLS = """c AS (SELECT l_orderkey AS t, l_linenumber - 1 AS r, (l_partkey % 4)::INTEGER AS k, (1 + l_suppkey % 2)::INTEGER AS rs, (1 + (l_partkey % 3 = 0)::INTEGER)::INTEGER AS ks, l_partkey * 1000000 + l_suppkey * 1000 + l_quantity::BIGINT * 10 + (l_returnflag = 'R')::INTEGER AS place, l_returnflag || l_linestatus AS text FROM lineitem),
x AS (SELECT t, unnest(range(r, r + rs)) AS r, k, ks, place, text FROM c), y AS (SELECT t, r::INTEGER AS r, unnest(range(k, k + ks)) AS k, place, text FROM x),
top AS (SELECT t, r, k::INTEGER AS k, max(struct_pack(p := place, v := text)).v AS text FROM y GROUP BY 1, 2, 3), z AS (SELECT t, max(r) AS rows_, max(k) AS columns_ FROM top GROUP BY 1),
g AS (SELECT t, r::INTEGER AS r, unnest(range(columns_ + 1))::INTEGER AS k FROM (SELECT t, unnest(range(rows_ + 1)) AS r, columns_ FROM z)),
grid AS (SELECT g.t, g.r, g.k, coalesce(text, '') AS text FROM g LEFT JOIN top USING (t, r, k))"""


def cells(t: Tables) -> DataFrame:
    place = F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 1000 + F.col("l_quantity").cast("long") * 10 + (F.col("l_returnflag") == "R").cast("int")
    return t.lineitem.select(
        F.col("l_orderkey").alias("t"), (F.col("l_linenumber") - 1).cast("int").alias("r"), (F.col("l_partkey") % 4).cast("int").alias("k"), (1 + F.col("l_suppkey") % 2).cast("int").alias("row_span"),
        (1 + (F.col("l_partkey") % 3 == 0).cast("int")).alias("column_span"), F.struct(place.alias("p"), F.concat("l_returnflag", "l_linestatus").alias("v")).alias("place"), F.concat("l_returnflag", "l_linestatus").alias("text"),
    )


@query("ext03_dense_grid", f"WITH {CELLS} SELECT t, r, k, text FROM grid")
def ext03(t):
    return V.dense_grid(cells(t), "t").select("t", "r", "k", "text")


@query("ext04_grid_support", f"""
WITH {CELLS}, h AS (SELECT DISTINCT t, r, k, text, k = 0 AS rh, r = 0 AS ch FROM c), q AS (SELECT DISTINCT l_orderkey AS t, l_orderkey * 10 + l_linenumber AS claim, l_returnflag || l_linestatus || '-x' AS subject, lower(l_returnflag) AS endpoint, l_returnflag || l_linestatus AS value FROM lineitem)
SELECT DISTINCT q.t, q.claim FROM q JOIN grid ON grid.t = q.t AND lower(trim(grid.text)) = lower(trim(q.value)) JOIN h a ON a.t = q.t AND a.rh AND a.r = grid.r AND (contains(lower(q.subject), lower(a.text)) OR contains(lower(a.text), lower(q.subject)))
JOIN h b ON b.t = q.t AND b.ch AND b.k = grid.k AND (contains(lower(q.endpoint), lower(b.text)) OR contains(lower(b.text), lower(q.endpoint)))""")
def ext04(t):
    own = cells(t)
    headers = own.select("t", "r", "k", "text", (F.col("k") == 0).alias("is_row_header"), (F.col("r") == 0).alias("is_column_header"))
    flag = F.concat("l_returnflag", "l_linestatus")
    claims = t.lineitem.select(F.col("l_orderkey").alias("t"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim"), F.concat(flag, F.lit("-x")).alias("subject"), F.lower("l_returnflag").alias("endpoint"), flag.alias("value"))
    return V.supported_by_grid(claims, headers, V.asked_grid(own, claims, "t"), "t", "claim")


@query("ext25_recalled_outcomes", r"""
WITH w AS (SELECT conv_id AS paper, turn, role, list_filter(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')), lambda x: length(x) >= 2 AND x NOT IN ('the', 'and', 'of', 'in', 'to', 'a', 'an', 'was', 'were', 'with', 'from', 'for', 'after', 'outcome', 'cells', 'cell', 'reported')) AS w, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS all_ FROM conversations),
g AS (SELECT paper, turn AS gold_id, turn // 2 AS at, w, list_distinct(all_[1:2]) AS v FROM w WHERE turn % 2 = 0), c AS (SELECT paper, turn // 2 AS at, w FROM w WHERE turn % 2 = 1)
SELECT DISTINCT paper, gold_id, EXISTS (SELECT 1 FROM c WHERE c.paper = g.paper AND ((c.at = g.at AND len(list_intersect(c.w, g.w)) >= 2) OR (len(list_intersect(c.w, g.w)) >= 4 AND len(g.v) > 0 AND list_has_all(list_intersect(c.w, g.w), g.v)))) AS recalled FROM g""")
def ext25(t):
    """Even turns are the gold records, the odd ones what was found; turns in pairs share a location."""
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    rows = t.conversations.select(F.col("conv_id").alias("paper"), "turn", F.floor(F.col("turn") / 2).alias("location"), F.filter(F.array_distinct(words), lambda x: (F.length(x) >= 2) & ~x.isin(*X.OUTCOME_STOP_WORDS)).alias("tokens"), F.array_distinct(F.slice(words, 1, 2)).alias("value_tokens"))
    gold = rows.where("turn % 2 = 0").withColumnRenamed("turn", "gold_id")
    return V.recalled_outcomes(gold, rows.where("turn % 2 = 1").select("paper", "location", "tokens")).distinct()


@query("ext55_duplicate_content", "SELECT doc_id, sha256(text) AS digest, CASE WHEN doc_id <> min(doc_id) OVER (PARTITION BY sha256(text)) THEN min(doc_id) OVER (PARTITION BY sha256(text)) END AS duplicate_of FROM documents")
def ext55(t):
    return V.first_of_equals(t.documents, "doc_id", F.sha2("text", 256))


@query("ext02_repair_tasks", """
WITH c AS (SELECT p_brand AS component, p_partkey AS candidate_id FROM part), e AS (SELECT DISTINCT l_partkey AS candidate_id, l_linenumber AS place, l_suppkey AS evidence_id FROM lineitem),
f AS (SELECT component, evidence_id, min(struct_pack(c := candidate_id, p := place)) AS pos FROM c JOIN e USING (candidate_id) GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY pos, evidence_id) AS k FROM f),
l AS (SELECT component, string_agg(evidence_id::VARCHAR, ',' ORDER BY k) AS evidence FROM k WHERE k <= 12 GROUP BY 1), n AS (SELECT component, count(*) AS n FROM c GROUP BY 1)
SELECT component, n, least(8, greatest(1, 2 * n)) AS most_new, coalesce(evidence, '') AS evidence, sha256(component || '|' || n || '|' || coalesce(evidence, '')) AS checksum FROM n LEFT JOIN l USING (component)""")
def ext02(t):
    candidates = t.part.select(F.col("p_brand").alias("component"), F.col("p_partkey").alias("candidate_id"))
    evidence = t.lineitem.select(F.col("l_partkey").alias("candidate_id"), F.col("l_linenumber").alias("place"), F.col("l_suppkey").alias("evidence_id")).distinct()
    return V.repair_tasks(candidates, evidence)
