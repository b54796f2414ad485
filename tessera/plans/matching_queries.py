"""Queries of matching, packing, clustering and readiness operators, and of the pipelines made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import numbers as N
from tessera.functions import text as X
from tessera.operators import assignment as A
from tessera.operators import readiness as D
from tessera.operators import relational as R
from tessera.operators.clusters import absorbed_in_rounds, incremental_groups
from tessera.operators.components import components
from tessera.operators.retrieval import next_in_order
from tessera.plans.registry import Tables, query
from tessera.shared import written


def items(t: Tables) -> DataFrame:
    """Line items with an id of their own within the order."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return t.lineitem.withColumn("item", F.row_number().over(w))


ITEMS = "items AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)::INTEGER AS item FROM lineitem)"


@query("mat01_most_pairs")
def mat01(t):
    return A.most_pairs(t.lineitem, ["l_orderkey"], "l_linenumber", "l_suppkey")


@query("mat02_heaviest_pairs")
def mat02(t):
    scored = t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.max("l_discount").alias("score"))
    return A.heaviest_pairs(scored, ["l_orderkey"], "l_linenumber", "l_suppkey", "score", 0.042)


@query("mat03_most_then_heaviest_pairs")
def mat03(t):
    scored = t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.max("l_quantity").cast("double").alias("score"))
    return A.heaviest_pairs(scored, ["l_orderkey"], "l_linenumber", "l_suppkey", "score", 8.0, count_first=True)


@query("mat04_greedy_pairs")
def mat04(t):
    scored = t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.max("l_quantity").cast("double").alias("score"))
    return A.greedy_pairs(scored, ["l_orderkey"], "l_linenumber", "l_suppkey", "score", 7.0)


@query("mat05_consumption", """
WITH a AS (SELECT l_orderkey AS k, l_linenumber AS link, count(*) AS n FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 1, 2), g AS (SELECT l_orderkey AS k, l_linenumber AS link, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
x AS (SELECT k, link, coalesce(a.n, 0) AS answers, coalesce(g.n, 0) AS gold FROM a FULL JOIN g USING (k, link)), e AS (SELECT *, sum(gold) OVER (PARTITION BY k) > 0 AS known FROM x)
SELECT k, result, sum(n)::BIGINT AS n FROM (
  SELECT k, 'correct' AS result, least(answers, gold) AS n FROM e UNION ALL SELECT k, 'missed', gold - least(answers, gold) FROM e UNION ALL
  SELECT k, CASE WHEN gold > 0 THEN 'duplicate' WHEN known THEN 'wrong_link' ELSE 'unsupported' END, answers - least(answers, gold) FROM e) WHERE n > 0 GROUP BY 1, 2""")
def mat05(t):
    answers = t.lineitem.where("l_linestatus <> 'F'").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("link"))
    gold = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("link"))
    return A.consumed(answers, gold, "k", "link")


@query("top08_diverse", f"""
WITH {ITEMS}, p AS (SELECT *, CASE WHEN l_quantity >= 5 AND row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_quantity DESC, item) = 1 THEN 1 ELSE 2 END AS pass FROM items),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY pass, l_quantity DESC, item)::INTEGER AS place FROM p)
SELECT l_orderkey, item, l_returnflag, place FROM r WHERE place <= 3""")
def top08(t):
    return A.diverse(items(t), ["l_orderkey"], "item", "l_returnflag", "l_quantity", 5, 3).select("l_orderkey", "item", "l_returnflag", "place")


@query("top09_within_budget", f"""
WITH RECURSIVE {ITEMS}, o AS (SELECT l_orderkey, item, l_quantity AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, item) AS n FROM items),
r AS (SELECT l_orderkey, item, n, q <= 100 AS selected, 100 - CASE WHEN q <= 100 THEN q ELSE 0 END AS left_ FROM o WHERE n = 1 UNION ALL
  SELECT o.l_orderkey, o.item, o.n, o.q <= left_, left_ - CASE WHEN o.q <= left_ THEN o.q ELSE 0 END FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.n = r.n + 1)
SELECT l_orderkey, item, selected, CASE WHEN selected THEN 'selected' ELSE 'over_budget' END AS reason FROM r""")
def top09(t):
    return A.within_budget(items(t).select("l_orderkey", "item", "l_quantity", "l_extendedprice"), ["l_orderkey"], "item", "l_quantity", "l_extendedprice", 100)


@query("top10_top11_next_fit", f"""
WITH RECURSIVE {ITEMS}, o AS (SELECT l_orderkey, item, l_quantity::INTEGER AS q FROM items),
r AS (SELECT l_orderkey, item, 1 AS task, q AS used, 1 AS n FROM o WHERE item = 1 UNION ALL
  SELECT o.l_orderkey, o.item, task + (used + q > 80 OR n + 1 > 3)::INTEGER, CASE WHEN used + q > 80 OR n + 1 > 3 THEN q ELSE used + q END, CASE WHEN used + q > 80 OR n + 1 > 3 THEN 1 ELSE n + 1 END FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.item = r.item + 1)
SELECT l_orderkey, item, task FROM r""")
def top10(t):
    own = items(t).select("l_orderkey", "item", F.col("l_quantity").cast("int").alias("size"), F.lit(1).alias("one"))
    return A.next_fit(own, ["l_orderkey"], "item", ["size", "one"], [80, 3])


@query("top12_chunks", f"WITH {ITEMS} SELECT l_orderkey, item, ((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, item) - 1) // 2)::INTEGER AS chunk FROM items")
def top12(t):
    return A.chunked(items(t), ["l_orderkey"], ["l_shipdate", "item"], 2).select("l_orderkey", "item", "chunk")


@query("set04_incremental_clusters", """
WITH RECURSIVE k AS (SELECT p_partkey AS i, concat_ws('|', p_brand, p_type, p_size) AS k FROM part UNION SELECT p_partkey, concat_ws('|', p_type, floor(p_retailprice)::BIGINT) FROM part),
e AS (SELECT DISTINCT i, p FROM (SELECT i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM k) WHERE p IS NOT NULL),
up AS (SELECT i, p AS a FROM e UNION SELECT up.i, e.p FROM up JOIN e ON e.i = up.a)
SELECT p_partkey, coalesce(min(a), p_partkey) AS cluster FROM part LEFT JOIN up ON i = p_partkey GROUP BY p_partkey""")
def set04(t):
    """Parts as records with two keys each, replayed in order of id: a part joins the earliest group that has one of its keys."""
    keys = R.keyed(t.part, "p_partkey", {"kind": F.concat_ws("|", "p_brand", "p_type", "p_size"), "price": F.concat_ws("|", "p_type", F.floor("p_retailprice"))})
    return incremental_groups(t.part, "p_partkey", keys, "key")


@query("set09_absorbed")
def set09(t):
    own = t.part.select("p_brand", "p_partkey", F.array_distinct(F.split(F.concat_ws(" ", "p_type", F.col("p_size").cast("string")), " ")).alias("tokens"), F.array("p_type").alias("source"))
    return absorbed_in_rounds(own.withColumn("evidence", F.array().cast("array<string>")), ["p_brand"], "p_partkey", "tokens", "evidence", "source")


@query("set09_consolidated_candidates")
def set09_consolidated(t):
    """Parts as outcome candidates of a brand: texts of their name, type and size, figures by size, evidence by name and price, their type as source."""
    tokens = F.split(F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("size"), "p_size")), " ")
    evidence = F.array(F.concat_ws("|", "p_name", F.floor("p_retailprice")))
    figure = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("Fig "), F.col("p_size") % 3))
    own = t.part.select("p_brand", "p_partkey", tokens.alias("tokens"), evidence.alias("evidence"), F.array("p_type").alias("sources"), figure.alias("figure"))
    return absorbed_in_rounds(own, ["p_brand"], "p_partkey", "tokens", "evidence", "sources", F.col("figure"))


@query("set10_rooted_components")
def set10(t):
    return rooted_components(t.lineitem, t.orders)


def rooted_components(lineitem, orders):
    edges = lineitem.select(F.col("l_orderkey").alias("a"), (-F.col("l_partkey")).alias("b"))
    star = components(edges)
    lone = edges.where("a = b or a is null or b is null").select(F.explode(F.array("a", "b")).alias("node")).where("node is not null")
    rooted = star.toDF("node", "root").union(star.select("b", "b")).union(lone.select("node", "node"))
    labelled = rooted.groupBy("node").agg(F.min("root").alias("root"))  # a root is the least of its component
    anchors = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("node"))
    # written, as Spark then knows how few they are: a component's nodes meet in no task, unless there are many roots
    kept = written(anchors.join(star.toDF("node", "root"), "node", "left").select(F.coalesce("root", "node").alias("root")).distinct(), "roots")
    return labelled.join(kept, "root", "left_semi").select("node", "root")


ARMS_SQL = """
arms AS (SELECT o_orderkey, o_custkey, o_orderstatus = 'P' AS conflict, o_orderpriority LIKE '5%' AS quarantined,
  list_filter([CASE WHEN NOT o_totalprice > 50000 THEN 'dose' END, CASE WHEN NOT coalesce(n, 0) >= 2 THEN 'evidence' END, CASE WHEN NOT (o_orderstatus = 'F' OR o_totalprice > 200000) THEN 'destination' END], lambda x: x IS NOT NULL) AS missing
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
stated AS (SELECT *, CASE WHEN quarantined THEN 'quarantined' WHEN conflict THEN 'conflict' WHEN len(missing) > 0 THEN 'incomplete' ELSE 'complete' END AS status FROM arms)"""


def arms(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    price = F.col("o_totalprice")
    missing = D.reasons({"dose": price > 50000, "evidence": F.col("n") >= 2, "destination": D.one_of(F.col("o_orderstatus") == "F", price > 200000)})
    own = t.orders.join(per, "o_orderkey", "left").withColumn("missing", missing)
    return own.withColumn("status", D.status(F.col("o_orderpriority").startswith("5"), F.col("o_orderstatus") == "P", F.col("missing")))


@query("pip20_pip21_status_and_eligibility", f"WITH {ARMS_SQL} SELECT o_orderkey, status, array_to_string(missing, ',') AS missing, status = 'complete' AS eligible FROM stated")
def pip20(t):
    return arms(t).select("o_orderkey", "status", F.array_join("missing", ",").alias("missing"), (F.col("status") == "complete").alias("eligible"))


@query("pip22_readiness_labels", f"""
WITH {ARMS_SQL} SELECT CASE WHEN status IN ('conflict', 'quarantined') THEN status WHEN len(missing) = 0 THEN 'ready' WHEN len(missing) <= 1 THEN 'almost' ELSE 'gap' END AS label, count(*) AS n FROM stated GROUP BY 1""")
def pip22(t):
    return arms(t).groupBy(D.queue_label(F.col("status"), F.col("missing"), 1).alias("label")).agg(F.count("*").alias("n"))


@query("pip25_rerun_queue", f"""
WITH {ARMS_SQL}, e AS (SELECT o_custkey, o_orderkey, unnest(missing) AS field FROM stated)
SELECT o_custkey, string_agg(DISTINCT field, ',' ORDER BY field) AS fields, count(DISTINCT o_orderkey) AS records FROM e GROUP BY o_custkey""")
def pip25(t):
    return D.rerun_queue(arms(t).withColumn("record", F.col("o_orderkey")), "o_custkey", "missing")


@query("pip31_gap_queue", f"""
WITH {ARMS_SQL} SELECT o_orderkey, len(missing)::INTEGER AS blockers, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN status IN ('conflict', 'quarantined') THEN 1 ELSE 0 END, len(missing), o_orderkey)::INTEGER AS place FROM stated WHERE len(missing) BETWEEN 1 AND 3""")
def pip31(t):
    w = Window.partitionBy("o_custkey").orderBy(F.col("status").isin("conflict", "quarantined").cast("int"), F.size("missing"), "o_orderkey")
    return arms(t).where(F.size("missing").between(1, 3)).select("o_orderkey", F.size("missing").alias("blockers"), F.row_number().over(w).alias("place"))


@query("pip32_state_tokens", """
SELECT c_custkey, sha256(concat_ws('|', '=' || c_mktsegment, '=' || coalesce(n, 0))) AS token FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def pip32(t):
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.join(per, "c_custkey", "left").select("c_custkey", X.digest(F.col("c_mktsegment"), F.coalesce("n", F.lit(0))).alias("token"))


@query("prj20_pip20_verification", """
WITH v AS (SELECT l_orderkey, CASE WHEN l_discount > 0.09 THEN 'conflict' WHEN l_discount > 0.08 THEN 'rejected' WHEN l_tax > 0.07 THEN 'manual' WHEN l_tax > 0.02 THEN 'automatic' ELSE 'none' END AS s FROM lineitem)
SELECT l_orderkey, CASE WHEN bool_or(s = 'conflict') THEN 'conflict' WHEN bool_or(s = 'rejected') THEN 'rejected' WHEN bool_or(s = 'manual') THEN 'manual' WHEN bool_or(s = 'automatic') THEN 'automatic' ELSE 'unreviewed' END AS verification FROM v GROUP BY 1""")
def prj20(t):
    state = F.when(F.col("l_discount") > 0.09, "conflict").when(F.col("l_discount") > 0.08, "rejected").when(F.col("l_tax") > 0.07, "manual").when(F.col("l_tax") > 0.02, "automatic").otherwise("none")
    return t.lineitem.groupBy("l_orderkey").agg(F.collect_set(state).alias("s")).select("l_orderkey", D.verification(F.col("s")).alias("verification"))


@query("pip18_accounting", """
WITH c AS (SELECT o_orderkey AS k FROM orders), d AS (SELECT CASE WHEN l_linenumber > 6 THEN -l_orderkey - 1 ELSE l_orderkey END AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(c.k, d.k) AS k, CASE WHEN c.k IS NULL THEN 'unknown' WHEN n IS NULL THEN 'omitted' WHEN n > 1 THEN 'repeated' ELSE 'exact' END AS accounting FROM c FULL JOIN d ON c.k = d.k""")
def pip18(t):
    return D.accounted(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.when(F.col("l_linenumber") > 6, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey")).alias("k")), "k")


@query("pip03_start_batch", r"""
WITH known AS (SELECT DISTINCT sha256(text) AS key FROM documents WHERE doc_id % 4 = 0),
s AS (SELECT doc_id, lang, CASE WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'exclude' WHEN n_chars >= 200 THEN 'include' ELSE 'manual_review' END AS decision FROM documents WHERE doc_id % 4 <> 0 AND sha256(text) NOT IN (SELECT key FROM known)),
c AS (SELECT lang, decision, count(*) AS n FROM s GROUP BY 1, 2), f AS (SELECT lang, decision FROM (VALUES ('en'), ('de'), ('fr'), ('es')) a(lang), (VALUES ('include'), ('exclude'), ('manual_review')) b(decision))
SELECT f.lang, f.decision, coalesce(n, 0) AS n FROM f LEFT JOIN c ON c.lang = f.lang AND c.decision = f.decision""")
def pip03(t):
    """Novel documents screened, counted by language and decision with zeros."""
    docs = t.documents.withColumn("key", F.sha2("text", 256))
    novel = docs.where("doc_id % 4 <> 0").join(docs.where("doc_id % 4 = 0").select("key").distinct(), "key", "left_anti")
    decision = F.when(F.col("text").rlike("[#$%&*]{3}"), "exclude").when(F.col("n_chars") >= 200, "include").otherwise("manual_review")
    per = novel.groupBy("lang", decision.alias("decision")).agg(F.count("*").alias("n"))
    fixed = t.spark.createDataFrame([(a, b) for a in ("en", "de", "fr", "es") for b in ("include", "exclude", "manual_review")], "lang string, decision string")
    return fixed.join(per, ["lang", "decision"], "left").select("lang", "decision", F.coalesce("n", F.lit(0)).alias("n"))


@query("pip05_pip06_budgeted_packet")
def pip05(t):
    """Distinct sentences of each document within a token budget, those with numbers first."""
    each = t.documents.select("doc_id", F.explode(F.array_distinct(X.sentences(F.col("text")))).alias("sentence"))
    w = Window.partitionBy("doc_id").orderBy("sentence")
    sized = each.select("doc_id", F.row_number().over(w).alias("item"), N.estimated_tokens(F.col("sentence")).cast("int").alias("tokens"), F.when(F.col("sentence").rlike("[0-9]"), 120).otherwise(20).alias("priority"))
    return A.within_budget(sized, ["doc_id"], "item", "tokens", "priority", 400)


@query("pip28_pip29_combined_table", """
SELECT n_name, count(DISTINCT c_custkey) AS customers, count(DISTINCT o_orderkey) AS orders, count(l_orderkey) AS lines FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY n_name""")
def pip28(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    orders = t.orders.join(lines, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.sum("lines").alias("lines"))
    buyers = t.customer.join(orders, "c_custkey", "left").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("lines").alias("lines"))
    return t.nation.join(buyers, "n_nationkey", "left").na.fill(0).select("n_name", "customers", "orders", "lines")


@query("src06_metadata_upsert", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE 'old' END AS run FROM customer WHERE c_custkey % 6 <> 1""")
def src06(t):
    """Results replaced by key, and removed for keys that failed."""
    old = t.customer.select("c_custkey", F.lit("old").alias("run"))
    new = t.customer.where("c_custkey % 4 = 0 and c_custkey % 6 <> 1").select("c_custkey", F.lit("new").alias("run"))
    failed = t.customer.where("c_custkey % 6 = 1").select("c_custkey")
    return old.join(new, "c_custkey", "left_anti").unionByName(new).join(failed, "c_custkey", "left_anti")


@query("src10_first_matching_item", """
WITH c AS (SELECT p.p_partkey, min(q.p_partkey) AS found FROM part p JOIN part q ON q.p_partkey > p.p_partkey AND (q.p_name = p.p_name OR (q.p_brand = p.p_brand AND q.p_size = p.p_size AND q.p_type = p.p_type)) GROUP BY 1)
SELECT p_partkey, found FROM c""")
def src10(t):
    """The first later item that agrees in one key or another: the next in the order of each key, never an OR, and no key's rows in one task."""
    out = None
    for key in (["p_name"], ["p_brand", "p_size", "p_type"]):
        own = next_in_order(t.part.select("p_partkey", F.concat_ws("|", *key).alias("key")), "key", "p_partkey").where("next is not null").select("p_partkey", F.col("next").alias("found"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy("p_partkey").agg(F.min("found").alias("found"))
