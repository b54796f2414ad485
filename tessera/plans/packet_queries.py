"""Queries of scoped packets and their isolation. Orders stand for scopes, parts for evidence, some suppliers for gold records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import packets as P
from tessera.plans.registry import query

GOLD = "s_acctbal < 2000"


def lineage(t):
    """Orders refer to the parts of their lines, parts to their first and last supplier, suppliers to their nation."""
    node = lambda kind, c: F.concat(F.lit(f"{kind}:"), c)
    link = lambda src, dst: (src.alias("src"), dst.alias("dst"))
    ends = t.lineitem.groupBy("l_partkey").agg(F.array_distinct(F.array(F.min("l_suppkey"), F.max("l_suppkey"))).alias("s"))
    of_parts = ends.select("l_partkey", F.explode("s").alias("s")).select(*link(node("p", F.col("l_partkey")), node("s", F.col("s"))))
    of_orders = t.lineitem.select(*link(node("o", F.col("l_orderkey")), node("p", F.col("l_partkey"))))
    of_suppliers = t.supplier.select(*link(node("s", F.col("s_suppkey")), node("n", F.col("s_nationkey"))))
    gold = t.supplier.where(GOLD).select(node("s", F.col("s_suppkey")).alias("node"))
    public = t.part.select(node("p", F.col("p_partkey")).alias("node"))
    items = t.orders.select(F.col("o_custkey").alias("packet"), node("o", F.col("o_orderkey")).alias("item"))
    return items, of_parts.unionByName(of_orders).unionByName(of_suppliers), gold, public


#: Two links lead from an order to a gold supplier, and a nation that only gold suppliers have is a link further.
LEAKS_SQL = f"""
gold AS (SELECT 's:' || s_suppkey AS leak, s_suppkey FROM supplier WHERE {GOLD}),
ends AS (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1 UNION SELECT l_partkey, max(l_suppkey) FROM lineitem GROUP BY 1),
near AS (SELECT l_partkey, min(leak) AS leak FROM ends JOIN gold ON s = s_suppkey GROUP BY 1),
hit AS (SELECT l_orderkey, min(struct_pack(leak := leak, via := 'p:' || l_partkey)) AS m FROM lineitem JOIN near USING (l_partkey) GROUP BY 1),
leaks AS (SELECT o_custkey AS packet, 'o:' || o_orderkey AS item, 2::INTEGER AS hops, m.leak AS leak, m.via AS via FROM orders JOIN hit ON l_orderkey = o_orderkey)"""


@query("ext42_leaks", f"WITH {LEAKS_SQL} SELECT * FROM leaks")
def ext42_leaks(t):
    """Orders in a customer's packet that lead to a gold record, with the way to the nearest one."""
    return P.leaks(*lineage(t))


@query("ext42_isolation_proof", f"WITH {LEAKS_SQL} SELECT o_custkey AS packet, count(*) AS items, count(item) AS leaked, count(item) = 0 AS passed FROM orders LEFT JOIN leaks ON item = 'o:' || o_orderkey GROUP BY 1")
def ext42_proof(t):
    """Whether a customer's packet of orders is free of what only gold reaches."""
    items, *rest = lineage(t)
    return P.isolation_proof(items, P.leaks(items, *rest))


@query("ext42_issued_targets", """
WITH f AS (SELECT l_orderkey AS paper, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS experiment, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_suppkey END AS candidate, l_linestatus AS field, l_partkey AS value FROM lineitem),
r AS (SELECT *, 'REC-' || left(sha256('=' || paper || '|' || CASE WHEN experiment IS NULL THEN '=shared' ELSE '=' || experiment || '|' || coalesce('=' || candidate, '-') END), 16) AS record_id FROM f)
SELECT paper, experiment, candidate, field, value, record_id, 'FACT-' || left(sha256('=' || paper || '|=' || record_id || '|=' || field || '|=' || value), 16) AS fact_id, 'ENT-' || left(sha256('=' || paper || '|=' || record_id || '|=' || field || '|=' || value), 16) AS entity_id FROM r""")
def ext42_targets(t):
    """Lines as facts of an order; first lines are its shared facts."""
    facts = t.lineitem.select(
        F.col("l_orderkey").alias("paper"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("experiment"),
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("candidate"),
        F.col("l_linestatus").alias("field"),
        F.col("l_partkey").alias("value"),
        *(F.lit(None).cast("string").alias(c) for c in ("record_id", "fact_id", "entity_id")),
    )
    return P.issued_facts(facts)


@query("pip45_scoped_packets", """
WITH f AS (SELECT l_orderkey, l_partkey, min(l_linenumber) AS place FROM lineitem GROUP BY 1, 2), i AS (SELECT *, length(p_name) AS chars, row_number() OVER (PARTITION BY l_orderkey ORDER BY place, l_partkey) - 1 AS n FROM f LEFT JOIN part ON p_partkey = l_partkey),
a AS (SELECT *, n // 4 AS g, count(*) OVER w AS c, sum(chars) OVER w AS total, n % 4 AS k FROM i WINDOW w AS (PARTITION BY l_orderkey, n // 4)),
b AS (SELECT *, CASE WHEN total > 24 AND c > 1 AND k >= c // 2 THEN 1 ELSE 0 END AS h, CASE WHEN total > 24 THEN 1 ELSE 0 END AS cut FROM a),
d AS (SELECT *, count(*) OVER w AS c2, sum(chars) OVER w AS total2, row_number() OVER (w ORDER BY k) - 1 AS k2 FROM b WINDOW w AS (PARTITION BY l_orderkey, g, h)),
e AS (SELECT *, CASE WHEN total2 > 24 AND c2 > 1 AND k2 >= c2 // 2 THEN 1 ELSE 0 END AS h2 FROM d)
SELECT l_orderkey AS scope, min(n)::INTEGER AS part, string_agg(l_partkey::VARCHAR, ',' ORDER BY n) AS evidence, sum(coalesce(chars, 0))::BIGINT AS chars, CASE WHEN bool_or(p_partkey IS NULL) THEN 'absent' WHEN bool_or(chars > 24) THEN 'too_long' END AS problem
FROM e GROUP BY l_orderkey, g, h, h2""")
def pip45_packets(t):
    """The parts of an order in packets of at most four, and of at most 24 characters of their names."""
    scopes = t.lineitem.select((F.col("l_orderkey") % 100).alias("paper"), F.col("l_orderkey").alias("scope"), F.col("l_linenumber").alias("position"), F.col("l_partkey").alias("evidence_id"))
    made = P.scoped_packets(scopes, t.part.select(F.col("p_partkey").alias("evidence_id"), F.col("p_name").alias("text")), 4, 24)
    return made.select("scope", "part", F.array_join(F.col("evidence_ids").cast("array<string>"), ",").alias("evidence"), "chars", "problem")
