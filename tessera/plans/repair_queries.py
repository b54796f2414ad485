"""Queries of gated repairs, propagated pairs, anchors and context tasks. Orders stand for papers, their lines for records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import repairs as R
from tessera.plans.registry import query


@query("pip14_gated_repairs")
def pip14_gated(t):
    """Orders as papers, odd lines as candidates, even ones as outputs that some lines repair: every second order has a repair that gives an output its
    experiment, every third one that changes its value; each stays only if no candidate's verdict falls."""
    p = F.col("l_partkey")
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("paper"), "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_returnflag").alias("flag")).select(
        "paper", F.col("l_linenumber").alias("id"), (F.col("l_linenumber") % 3).cast("string").alias("experiment"), F.array("flag").alias("cells"), F.array().cast("array<string>").alias("endpoints"),
        F.lit("positive").alias("polarity"), (p % 4).cast("double").alias("value"), F.lit("%").alias("unit"), F.array((p % 3).cast("string")).alias("evidence"),
    )
    candidates = rows.where("id % 2 = 1").withColumnRenamed("id", "candidate_id").withColumns({"eligible": F.lit(True), "confidence": F.lit("high")})
    given = rows.where("id % 2 = 0").withColumnRenamed("id", "output_id")
    outputs = given.withColumn("experiment", F.when(F.col("output_id") != 2, F.col("experiment")))
    named = given.where("output_id = 2 and paper % 2 = 0").withColumn("repair_id", F.lit(1))
    changed = given.where("output_id = 4 and paper % 3 = 0").withColumn("value", F.col("value") + 1).withColumn("repair_id", F.lit(2))
    return R.gated_repairs(candidates, outputs, named.unionByName(changed).select("repair_id", *outputs.columns))


@query("ext38_propagated_pairs")
def ext38_pairs(t):
    """Lines of an order as arms, each with two possible treatments by part and supplier."""
    choices = F.explode(F.array(F.col("l_partkey") % 6, 10 + F.col("l_suppkey") % 4))
    possible = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("arm"), choices.alias("treatment"))
    return R.propagated_pairs(possible, ["l_orderkey"], "arm", "treatment")


@query("pip15_anchor_accounting", """
WITH a AS (SELECT o_custkey AS paper, o_orderkey AS anchor_id FROM orders),
c AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_custkey + 1 ELSE o_custkey END AS paper, l_returnflag AS entry_id, CASE WHEN l_quantity > 49 THEN -o_orderkey ELSE o_orderkey END AS anchor_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
n AS (SELECT paper, anchor_id, count(DISTINCT entry_id) AS entries FROM c GROUP BY 1, 2)
SELECT paper, anchor_id, coalesce(entries, 0) AS entries, CASE WHEN a.anchor_id IS NULL THEN CASE WHEN anchor_id IN (SELECT o_orderkey FROM orders) THEN 'foreign' ELSE 'invented' END WHEN entries IS NULL THEN 'omitted' WHEN entries > 1 THEN 'doubled' ELSE 'exact' END AS state
FROM a FULL JOIN n USING (paper, anchor_id)""")
def pip15_anchors(t):
    """Orders as a customer's anchors, flags of their lines as entries that cite them; some cite another customer's anchor or one that nobody has."""
    anchors = t.orders.select(F.col("o_custkey").alias("paper"), F.col("o_orderkey").alias("anchor_id"))
    lines = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    paper = F.when(F.col("o_orderkey") % 50 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    anchor = F.when(F.col("l_quantity") > 49, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    return R.anchor_accounting(anchors, lines.select(paper.alias("paper"), F.col("l_returnflag").alias("entry_id"), anchor.alias("anchor_id")))


@query("ext40_context_tasks", """
WITH n AS (SELECT o_custkey AS paper, o_orderpriority AS kind, o_orderkey, (row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) - 1) // 3 + 1 AS task FROM orders),
p AS (SELECT paper, kind, task, array_to_string(list_sort(list(o_orderkey::VARCHAR)), ',') AS anchors FROM n GROUP BY 1, 2, 3),
i AS (SELECT *, concat_ws('/', paper, kind, task, '') AS task_id, sha256(concat_ws('|', '=' || paper, '=' || kind, '=' || anchors)) AS checksum FROM p)
SELECT paper, kind, task::INTEGER AS task, task_id, anchors, checksum, CASE WHEN paper % 5 = 0 THEN 'no_response' WHEN paper % 5 = 1 THEN 'changed_task' WHEN paper % 5 = 2 THEN 'repeated' ELSE 'valid' END AS state FROM i""")
def ext40(t):
    """A customer's orders of one priority in tasks of three, and responses held against what was issued: some are missing, made from other content or sent twice."""
    anchors = t.orders.select(F.col("o_custkey").alias("paper"), F.col("o_orderpriority").alias("kind"), "o_orderkey", F.lit(1).alias("size"))
    tasks = R.context_tasks(anchors, ["kind"], "o_orderkey", "size", 3)
    sent = tasks.where("paper % 5 > 0").select("task_id", F.when(F.col("paper") % 5 == 1, F.lit("other")).otherwise(F.col("checksum")).alias("checksum"))
    states = R.response_states(tasks, sent.unionByName(tasks.where("paper % 5 = 2").select("task_id", "checksum")))
    return tasks.join(states, "task_id").select("paper", "kind", "task", "task_id", F.array_join("anchors", ",").alias("anchors"), "checksum", "state")
