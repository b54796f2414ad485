"""Canonical facts from documents of three families, made of customers with their orders and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.facts import Rule, projected
from tessera.plans.registry import query

RULES = [
    Rule("graph", "/paper/name", "paper", "paper", "title"),
    Rule("graph", "/experiments/*/id", "arm", "arm", "id", "/experiments/$1/id"),
    Rule("graph", "/experiments/*/status", "arm", "arm", "status", "/experiments/$1/id"),
    Rule("graph", "/experiments/*/dose/value", "arm", "arm", "dose", "/experiments/$1/id", "/experiments/$1/dose/evidence_ids"),
    Rule("graph", "/experiments/*/dose/evidence_ids/*", "evidence", "evidence", "id", "/experiments/$1/id"),
    Rule("slices", "/slices/*/*/status", "arm", "$1", "status", "$2"),
    Rule("results", "/*/order", "arm", "arm", "id", "/$1/order"),
    Rule("results", "/*/lines", "arm", "arm", "lines", "/$1/order"),
]


def papers(t):
    """(paper, family, payload): a graph of experiments, a map of slices or a list of results, one a customer."""
    cited = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set("l_partkey")).alias("ids"), F.count("*").alias("n"))
    orders = t.orders.join(cited, "o_orderkey", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<long>"))).withColumn("n", F.coalesce("n", F.lit(0)))
    text = F.col("o_orderkey").cast("string")
    dose = F.struct(F.floor("o_totalprice").alias("value"), F.transform("ids", lambda x: x.cast("string")).alias("evidence_ids"))
    row = F.struct("o_orderkey", F.struct(text.alias("id"), F.col("o_orderstatus").alias("status"), dose.alias("dose")).alias("arm"), F.struct(text.alias("order"), F.col("n").alias("lines")).alias("result"))
    per = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    slice_ = F.map_from_entries(F.collect_list(F.struct(text, F.struct(F.col("o_orderstatus").alias("status"), F.floor("o_totalprice").alias("total")))))
    slices = orders.where("o_custkey % 3 = 1").groupBy("o_custkey", "o_orderpriority").agg(slice_.alias("arms")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "arms"))).alias("slices"))
    whole = t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey").join(slices, F.col("c_custkey") == F.col("o_custkey"), "left")
    family = F.element_at(F.array(F.lit("graph"), F.lit("slices"), F.lit("results")), (F.col("c_custkey") % 3 + 1).cast("int"))
    graph = F.to_json(F.struct(F.struct(F.col("c_name").alias("name")).alias("paper"), F.coalesce(F.transform("rows", lambda x: x["arm"]), F.array()).alias("experiments"), F.col("c_nationkey").alias("extra")))
    results = F.coalesce(F.to_json(F.transform("rows", lambda x: x["result"])), F.lit("[]"))
    payload = F.when(family == "graph", graph).when(family == "slices", F.coalesce(F.to_json(F.struct("slices")), F.lit("{}"))).otherwise(results)
    return whole.select(F.col("c_custkey").alias("paper"), family.alias("family"), payload.alias("payload"))


@query("jsn02_ext17_ext24_canonical_facts", """
WITH l AS (SELECT l_orderkey, list_sort(list_distinct(list(l_partkey))) AS ids, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT o_custkey AS id, o_orderkey, o_orderkey::VARCHAR AS arm, o_orderstatus AS status, o_orderpriority AS slice, floor(o_totalprice)::BIGINT::VARCHAR AS price, coalesce(ids, []) AS ids, coalesce(n, 0) AS n,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
g AS (SELECT * FROM o WHERE id % 3 = 0), s AS (SELECT * FROM o WHERE id % 3 = 1), r AS (SELECT * FROM o WHERE id % 3 = 2), none AS (SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)),
f AS (
SELECT c_custkey AS id, '/paper/name' AS pointer, 'paper' AS namespace, 'paper' AS entity, 'title' AS field, c_name AS value, NULL AS arm, '' AS evidence FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, '/extra', NULL, NULL, NULL, c_nationkey::VARCHAR, NULL, '' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT id, '/experiments', NULL, NULL, NULL, '[]', NULL, '' FROM none WHERE id % 3 = 0
UNION ALL SELECT id, '/experiments/' || i || '/id', 'arm', 'arm', 'id', arm, arm, '' FROM g
UNION ALL SELECT id, '/experiments/' || i || '/status', 'arm', 'arm', 'status', status, arm, '' FROM g
UNION ALL SELECT id, '/experiments/' || i || '/dose/value', 'arm', 'arm', 'dose', price, arm, array_to_string(list_sort(list_transform(ids, lambda x: x::VARCHAR)), ',') FROM g
UNION ALL SELECT id, '/experiments/' || i || '/dose/evidence_ids', NULL, NULL, NULL, '[]', NULL, '' FROM g WHERE len(ids) = 0
UNION ALL SELECT id, '/experiments/' || i || '/dose/evidence_ids/' || (k - 1), 'evidence', 'evidence', 'id', ids[k]::VARCHAR, arm, '' FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS k FROM g)
UNION ALL SELECT id, '/slices/' || slice || '/' || arm || '/status', 'arm', slice, 'status', status, arm, '' FROM s
UNION ALL SELECT id, '/slices/' || slice || '/' || arm || '/total', NULL, NULL, NULL, price, NULL, '' FROM s
UNION ALL SELECT id, '', NULL, NULL, NULL, CASE WHEN id % 3 = 1 THEN '{}' ELSE '[]' END, NULL, '' FROM none WHERE id % 3 > 0
UNION ALL SELECT id, '/' || i || '/order', 'arm', 'arm', 'id', arm, arm, '' FROM r
UNION ALL SELECT id, '/' || i || '/lines', 'arm', 'arm', 'lines', n::VARCHAR, arm, '' FROM r)
SELECT *, CASE WHEN field IS NULL THEN 'quarantined' ELSE 'projected' END AS disposition FROM f""")
def jsn02(t):
    """Every leaf of every document by the rules of its family; what no rule covers is quarantined."""
    facts = projected(papers(t), "paper", "family", "payload", RULES)
    return facts.select("id", "pointer", "namespace", "entity", "field", "value", "arm", F.array_join("evidence", ",").alias("evidence"), "disposition")
