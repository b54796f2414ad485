"""Queries of canonical forms, slices, repairs and package checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import canonical as K
from tessera.functions import text as X
from tessera.operators import relational as R
from tessera.plans.registry import query
from tessera.plans.text_queries import SENTENCES, sentences


@query("str05_str06_str07_canonical_facts", r"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 3 WHEN 0 THEN 'ratio' WHEN 1 THEN 'unit' ELSE 'text' END AS rule,
  CASE l_linenumber % 3 WHEN 0 THEN l_partkey || ':10:1.5' WHEN 1 THEN 'mg/kg' ELSE 'dose ' || l_partkey || ' of 2' END AS value FROM lineitem""")
def str05(t):
    k = F.col("l_linenumber") % 3
    field = F.when(k == 0, "molar_ratio").when(k == 1, "dose_unit").otherwise("note")
    raw = F.when(k == 0, F.concat("l_partkey", F.lit(" : 10.0 :1.50"))).when(k == 1, "Milligrams / KG").otherwise(F.concat(F.lit("Dose  "), "l_partkey", F.lit(" of 2.00")))
    value, rule = K.canonical_fact(field, raw, {"milligrams": "mg", "kilograms": "kg"})
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", rule.alias("rule"), value.alias("value"))


@query("agg15_family_groups", """
WITH g AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10 AS source, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10 AS source, count(*) AS n_all, count(DISTINCT l_orderkey) >= 2 AS confident FROM lineitem GROUP BY ALL)
SELECT * FROM g JOIN c USING (l_returnflag, l_linestatus, l_linenumber, source)""")
def agg15(t):
    """Groups with their members in rows of their own, as a group's members have no bound."""
    keys = ["l_returnflag", "l_linestatus", "l_linenumber", "source"]
    own = t.lineitem.withColumn("source", F.col("l_suppkey") % 10)
    per = own.groupBy(*keys, "l_orderkey").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.sum("n").alias("n_all"), (F.count("*") >= 2).alias("confident"))
    return own.groupBy(*keys, "l_partkey").agg(F.count("*").alias("n")).join(per, keys)


@query("agg18_slice_reconciliation", """
WITH s AS (SELECT l_orderkey, l_linenumber AS name, l_suppkey % 2 AS slice, min(l_returnflag) AS a, min(l_shipdate) AS b FROM lineitem GROUP BY 1, 2, 3),
g AS (SELECT l_orderkey, name, count(*) AS slices, count(DISTINCT a) AS variants, min(a) AS a FROM s GROUP BY 1, 2)
SELECT l_orderkey, name, slices, CASE WHEN variants = 1 THEN a END AS value, variants > 1 AS conflict FROM g""")
def agg18(t):
    s = t.lineitem.groupBy("l_orderkey", F.col("l_linenumber").alias("name"), (F.col("l_suppkey") % 2).alias("slice")).agg(F.min("l_returnflag").alias("a"))
    g = s.groupBy("l_orderkey", "name").agg(F.count("*").alias("slices"), F.min("a").alias("low"), F.max("a").alias("high"))
    return g.select("l_orderkey", "name", "slices", F.when(F.col("low") == F.col("high"), F.col("low")).alias("value"), (F.col("low") != F.col("high")).alias("conflict"))


@query("pip02_enriched_records", """
WITH a AS (SELECT l_partkey AS p, max(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT l_partkey AS p, max(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
SELECT p_partkey, coalesce(a.d, b.d) AS last_date, CASE WHEN a.p IS NOT NULL THEN 'first' WHEN b.p IS NOT NULL THEN 'second' ELSE 'none' END AS origin FROM part LEFT JOIN a ON a.p = p_partkey LEFT JOIN b ON b.p = p_partkey""")
def pip02(t):
    from tessera.sources.bibliography import enriched

    side = lambda flag: t.lineitem.where(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_shipdate").alias("last_date"))
    return enriched(t.part.select("p_partkey"), side("R"), side("N"), "p_partkey", ["last_date"])


@query("pip23_agreed_values", """
WITH v AS (SELECT l_orderkey, min(l_returnflag) AS v, count(DISTINCT l_returnflag) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o_orderkey, CASE WHEN n = 1 THEN v ELSE o_orderstatus END AS value, CASE WHEN n = 1 THEN 'applied' WHEN n > 1 THEN 'unresolved' ELSE 'kept' END AS how FROM orders LEFT JOIN v ON l_orderkey = o_orderkey""")
def pip23(t):
    v = t.lineitem.where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("high"))
    same = F.col("low") == F.col("high")
    return t.orders.join(v, "o_orderkey", "left").select("o_orderkey", F.when(same, F.col("low")).otherwise(F.col("o_orderstatus")).alias("value"), F.when(same, "applied").when(F.col("low").isNotNull(), "unresolved").otherwise("kept").alias("how"))


@query("pip24_compare_and_set", """
WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'WRONG' END AS expected, 'NEW' AS new FROM customer WHERE c_custkey % 4 < 2)
SELECT c_custkey, CASE WHEN expected = c_mktsegment THEN new ELSE c_mktsegment END AS segment, CASE WHEN k IS NULL THEN 'untouched' WHEN expected = c_mktsegment THEN 'repaired' ELSE 'refused' END AS outcome FROM customer LEFT JOIN r ON k = c_custkey""")
def pip24(t):
    repairs = t.customer.where("c_custkey % 4 < 2").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("WRONG").alias("expected"), F.lit("NEW").alias("new"))
    holds = F.col("expected") == F.col("c_mktsegment")
    return t.customer.join(repairs, "c_custkey", "left").select("c_custkey", F.when(holds, F.col("new")).otherwise(F.col("c_mktsegment")).alias("segment"), F.when(F.col("expected").isNull(), "untouched").when(holds, "repaired").otherwise("refused").alias("outcome"))


@query("pip36_package_validation", """
SELECT 'id_not_unique' AS "check", doc_id::VARCHAR AS key FROM documents GROUP BY doc_id HAVING count(*) > 1 UNION ALL SELECT 'label_without_document', doc_id::VARCHAR FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'quantity_over_100', l_orderkey::VARCHAR FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity::BIGINT) > 100 UNION ALL SELECT 'language_not_required', doc_id::VARCHAR FROM documents WHERE lang NOT IN ('en', 'de', 'fr')""")
def pip36(t):
    totals = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q")).where("q > 100")
    return R.violations([
        ("id_not_unique", R.duplicated(t.documents, ["doc_id"]), F.col("doc_id")),
        ("label_without_document", R.missing_parents(t.labels, t.documents, "doc_id"), F.col("doc_id")),
        ("quantity_over_100", totals, F.col("l_orderkey")),
        ("language_not_required", t.documents.where("lang not in ('en', 'de', 'fr')"), F.col("doc_id")),
    ])


@query("snk03_surrogate_keys", """
SELECT row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS number, conv_id, turn, role FROM conversations""")
def snk03(t):
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return t.conversations.select(F.row_number().over(w).cast("long").alias("number"), "conv_id", "turn", "role")


@query("snk04_ledger_changes", """
WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS f, l_returnflag AS v FROM lineitem WHERE l_suppkey % 2 = 0), i AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS f, l_returnflag AS v FROM lineitem WHERE l_suppkey % 2 = 1)
SELECT i.k, i.f, i.v, CASE WHEN NOT EXISTS (SELECT 1 FROM l WHERE l.k = i.k AND l.f = i.f) THEN 'insert' WHEN EXISTS (SELECT 1 FROM l WHERE l.k = i.k AND l.f = i.f AND l.v = i.v) THEN 'unchanged' ELSE 'error_on_change' END AS action FROM i""")
def snk04(t):
    """Even suppliers are the ledger, odd ones come in, so every row has a role."""
    return ledger_changes(t, "l_suppkey % 2 = 0", "l_suppkey % 2 = 1")


def ledger_changes(t, held, comes):
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("f"), F.col("l_returnflag").alias("v"), F.struct("l_orderkey", "l_linenumber").alias("key"), "l_suppkey")
    incoming = rows.where(comes).drop("l_suppkey").distinct()
    found = R.import_decisions(rows.where(held), incoming, "key", "v")
    action = F.when(F.col("decision") == "new", "insert").when(F.col("decision") == "unchanged", "unchanged").otherwise("error_on_change")
    return found.select("k", "f", "v", action.alias("action"))


@query("pip11_routing", """
WITH a AS (SELECT o_orderkey AS k, 'validation' AS route FROM orders WHERE o_orderstatus = 'P'), b AS (SELECT DISTINCT l_orderkey AS k, 'coverage' AS route FROM lineitem WHERE l_discount > 0.04), c AS (SELECT DISTINCT l_orderkey AS k, 'inventory' AS route FROM lineitem WHERE l_discount <= 0.04),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE k NOT IN (SELECT k FROM a) UNION ALL SELECT * FROM c WHERE k NOT IN (SELECT k FROM a) AND k NOT IN (SELECT k FROM b))
SELECT route, count(*) AS n, count(DISTINCT k) AS records FROM u GROUP BY route""")
def pip11(t):
    """Findings of three kinds; what an earlier route has is not routed again."""
    routes = [("validation", t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("k"))), ("coverage", t.lineitem.where("l_discount > 0.04").select(F.col("l_orderkey").alias("k")).distinct()), ("inventory", t.lineitem.where("l_discount <= 0.04").select(F.col("l_orderkey").alias("k")).distinct())]
    ranks = None
    for n, (name, df) in enumerate(routes):
        own = df.select("k", F.struct(F.lit(n).alias("n"), F.lit(name).alias("route")).alias("r"))
        ranks = own if ranks is None else ranks.unionByName(own)
    return ranks.groupBy("k").agg(F.min("r").alias("r")).groupBy(F.col("r.route").alias("route")).agg(F.count("*").alias("n"), F.count("k").alias("records"))


@query("snk06_fill_forward", """
SELECT event_id, last_value(CASE WHEN event_id % 4 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events""")
def fill(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.events.select("event_id", F.last(F.when(F.col("event_id") % 4 == 0, F.col("event_type")), ignorenulls=True).over(w).alias("carried"))
