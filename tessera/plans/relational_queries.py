"""Queries of joins, aggregates, windows, set operations, sinks and checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import relational as R
from tessera.plans.registry import query


@query("jon01_jon20_inner_chain", """
SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def jon01(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name", "r_name")


@query("jon02_jon03_left_outer", """
SELECT d.doc_id, quality, CASE WHEN toxic = 1 THEN 'toxic' END AS mark FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.quality = 1""")
def jon02(t):
    good = t.labels.where("quality = 1")
    return t.documents.select("doc_id").join(good, "doc_id", "left").select("doc_id", "quality", F.when(F.col("toxic") == 1, "toxic").alias("mark"))


@query("jon04_semi_of_paths", """
SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') OR EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_returnflag = 'R')""")
def jon04(t):
    direct = t.orders.where("o_orderstatus = 'F'").select("o_custkey")
    linked = t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_custkey")
    return t.customer.join(direct.unionByName(linked), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("jon05_jon06_anti", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def jon05(t):
    return R.missing_parents(t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), t.lineitem, "l_orderkey").select(F.col("l_orderkey").alias("o_orderkey"))


@query("jon07_other_owner", """
SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS owners FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_suppkey) > 1""")
def jon07(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.countDistinct("l_suppkey").alias("owners")).where("owners > 1")


@query("jon08_polymorphic", """
WITH e AS (SELECT 'customer' AS entity_type, c_custkey AS entity_id, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier),
r AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'customer' ELSE 'supplier' END AS entity_type, user_id AS entity_id FROM events)
SELECT event_id, entity_type, nation FROM r LEFT JOIN e USING (entity_type, entity_id)""")
def jon08(t):
    entities = t.customer.select(F.lit("customer").alias("entity_type"), F.col("c_custkey").alias("entity_id"), F.col("c_nationkey").alias("nation")).unionByName(t.supplier.select(F.lit("supplier").alias("entity_type"), F.col("s_suppkey").alias("entity_id"), F.col("s_nationkey").alias("nation")))
    rows = t.events.select("event_id", F.when(F.col("event_id") % 2 == 0, "customer").otherwise("supplier").alias("entity_type"), F.col("user_id").alias("entity_id"))
    return rows.join(entities, ["entity_type", "entity_id"], "left").select("event_id", "entity_type", "nation")


@query("jon09_win01_latest", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def jon09(t):
    return R.latest(t.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("jon10_win02_current_revision", """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN event_id - 1 END AS replaces FROM events),
k AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.replaces = e.event_id))
SELECT user_id, max(event_id) AS event_id FROM k GROUP BY user_id""")
def jon10(t):
    e = t.events.select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("event_id") - 1).alias("replaces"))
    return R.current(e, "event_id", "replaces", ["user_id"]).select("user_id", "event_id")


@query("jon11_known_candidates", """
WITH k AS (SELECT doc_id, 'text:' || sha256(text) AS key FROM documents UNION SELECT doc_id, 'line:' || sha256(string_split(text, chr(10))[1]) FROM documents),
owner AS (SELECT key, min(doc_id) AS owner FROM k WHERE doc_id % 2 = 0 GROUP BY key)
SELECT doc_id, string_agg(DISTINCT owner::VARCHAR, ',' ORDER BY owner::VARCHAR) AS duplicate_of, string_agg(DISTINCT key, ',' ORDER BY key) AS matching_keys FROM k JOIN owner USING (key) WHERE doc_id % 2 = 1 GROUP BY doc_id""")
def jon11(t):
    """Even ids are known, odd ids are candidates, so every document has a role."""
    keys = R.keyed(t.documents, "doc_id", {"text": F.sha2("text", 256), "line": F.sha2(F.split("text", "\n")[0], 256)})
    known = keys.where("doc_id % 2 = 0").withColumnRenamed("doc_id", "owner_id")
    return R.known_as(keys.where("doc_id % 2 = 1"), known, "doc_id", "owner_id").withColumn("duplicate_of", F.array_join(F.array_sort(F.split("duplicate_of", ",")), ","))


@query("jon12_jsn09_set_overlap", """
WITH m AS (SELECT l_suppkey, l_partkey, bool_or(l_returnflag = 'R') AS a, bool_or(l_returnflag <> 'R') AS b FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, count(*) FILTER (WHERE a AND b) AS shared, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE b AND NOT a) AS only_b,
  CASE WHEN count(*) FILTER (WHERE a AND b) = 0 THEN 'disjoint' WHEN count(*) FILTER (WHERE a AND NOT b) = 0 THEN 'a_in_b' WHEN count(*) FILTER (WHERE b AND NOT a) = 0 THEN 'b_in_a' ELSE 'overlap' END AS relation FROM m GROUP BY 1""")
def jon12(t):
    """Parts that a supplier's returned lines and its other lines have in common."""
    returned = F.col("l_returnflag") == "R"
    return R.set_relation(t.lineitem.where(returned), t.lineitem.where(~returned), "l_suppkey", "l_partkey")


@query("jon13_jon15_win08_best_or_abstain", """
WITH s AS (SELECT DISTINCT l_orderkey, l_suppkey, (CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 3 ELSE 0 END + l_linenumber)::INTEGER AS score FROM lineitem),
b AS (SELECT *, max(score) OVER (PARTITION BY l_orderkey) AS best FROM s WHERE score >= 6),
n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM b WHERE score = best)
SELECT l_orderkey, l_suppkey, score FROM n WHERE n = 1""")
def jon13(t):
    score = F.when(F.col("l_returnflag") == "R", 4).otherwise(0) + F.when(F.col("l_linestatus") == "F", 3).otherwise(0) + F.col("l_linenumber")
    scored = t.lineitem.select("l_orderkey", "l_suppkey", score.cast("int").alias("score")).distinct()
    return R.unique_best(scored, "l_orderkey", "score", 6)


@query("jon14_mat06_unique_partner", """
WITH p AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
n AS (SELECT l_orderkey, count(*) AS n, min(l_suppkey) AS partner FROM p GROUP BY 1),
c AS (SELECT partner, count(*) AS claims FROM n WHERE n = 1 GROUP BY 1)
SELECT l_orderkey, CASE WHEN n = 1 AND claims = 1 THEN partner END AS l_suppkey, CASE WHEN n > 1 THEN 'ambiguous' WHEN claims > 1 THEN 'revoked' ELSE 'confirmed' END AS status FROM n LEFT JOIN c USING (partner)""")
def jon14(t):
    return R.unique_partner(t.lineitem.select("l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey")


@query("jon16_conservative_score", """
SELECT l_orderkey, l_linenumber, l_partkey, (CASE WHEN p_size > 48 THEN -1 ELSE CASE WHEN l_quantity > 25 THEN 4 ELSE 0 END + CASE WHEN p_size > 25 THEN 3 ELSE 0 END END)::INTEGER AS score FROM lineitem JOIN part ON p_partkey = l_partkey""")
def jon16(t):
    score = F.when(F.col("p_size") > 48, -1).otherwise(F.when(F.col("l_quantity") > 25, 4).otherwise(0) + F.when(F.col("p_size") > 25, 3).otherwise(0))
    return t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", score.cast("int").alias("score"))


@query("jon18_win05_neighbours", """
SELECT event_id, lag(event_id) OVER w AS before, lead(event_id) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def jon18(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", F.lag("event_id").over(w).alias("before"), F.lead("event_id").over(w).alias("after"))


@query("jon19_location_match", """
SELECT DISTINCT a.l_orderkey, a.l_linenumber, 'exact' AS how FROM lineitem a JOIN orders ON o_orderkey = a.l_orderkey AND o_orderdate = a.l_shipdate
UNION SELECT DISTINCT a.l_orderkey, a.l_linenumber, 'month' FROM lineitem a JOIN orders ON o_orderkey = a.l_orderkey AND o_orderdate <> a.l_shipdate AND date_trunc('month', o_orderdate) = date_trunc('month', a.l_shipdate)""")
def jon19(t):
    both = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    how = F.when(F.col("o_orderdate") == F.col("l_shipdate"), "exact").when(F.trunc("o_orderdate", "month") == F.trunc("l_shipdate", "month"), "month")
    return both.select("l_orderkey", "l_linenumber", how.alias("how")).where("how is not null").distinct()


@query("jon22_nearest", """
WITH p AS (SELECT a.event_id, b.event_id AS near, abs(b.value - a.value) AS distance FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND date_trunc('day', a.ts) = date_trunc('day', b.ts))
SELECT event_id, arg_min(near, struct_pack(d := distance, n := near)) AS near FROM p GROUP BY event_id""")
def jon22(t):
    e = t.events.withColumn("day", F.date_trunc("day", "ts"))
    a = e.where("event_type = 'click'").select("event_id", "user_id", "day", "value")
    b = e.where("event_type = 'purchase'").select(F.col("event_id").alias("near"), "user_id", "day", F.col("value").alias("other"))
    return a.join(b, ["user_id", "day"]).groupBy("event_id").agg(F.min_by("near", F.struct(F.abs(F.col("other") - F.col("value")), F.col("near"))).alias("near"))


@query("jon23_counts_per_parent", """
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders, (SELECT count(*) FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey) AS n_lines FROM customer""")
def jon23(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    per = t.orders.join(lines, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.sum(F.coalesce("n", F.lit(0))).alias("n_lines"))
    return t.customer.select("c_custkey").join(per, "c_custkey", "left").na.fill(0, ["n_orders", "n_lines"])


@query("jon24_set02_reconcile", """
WITH e AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P'), a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'F')
SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' ELSE 'unexpected' END AS what FROM e FULL JOIN a ON e.k = a.k WHERE e.k IS NULL OR a.k IS NULL""")
def jon24(t):
    expected = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("e"))
    actual = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k")).distinct().withColumn("a", F.lit(1))
    return expected.join(actual, "k", "full").where("e is null or a is null").select("k", F.when(F.col("a").isNull(), "missing").otherwise("unexpected").alias("what"))


@query("jon25_alias_match", """
WITH x AS (SELECT p_partkey, upper(p_name) AS alias FROM part UNION SELECT p_partkey, upper(p_brand || ' ' || p_type) FROM part), r AS (SELECT alias, min(p_partkey) AS found FROM x GROUP BY 1)
SELECT p_partkey AS gold, min(found) AS found, count(*) AS aliases FROM x JOIN r USING (alias) GROUP BY 1""")
def jon25(t):
    """Each part with the first that shares an alias (itself, if none does): a row per part, however common an alias is."""
    x = t.part.select(F.col("p_partkey").alias("gold"), F.explode(F.array_distinct(F.array(F.upper("p_name"), F.upper(F.concat_ws(" ", "p_brand", "p_type"))))).alias("alias"))
    return x.join(x.groupBy("alias").agg(F.min("gold").alias("found")), "alias").groupBy("gold").agg(F.min("found").alias("found"), F.count("*").alias("aliases"))


@query("jon26_as_of", """
SELECT e.event_id, max(b.event_id) AS last_purchase FROM events e LEFT JOIN events b ON b.user_id = e.user_id AND b.event_type = 'purchase' AND b.ts <= e.ts AND e.event_type = 'click'
AND b.ts = (SELECT max(x.ts) FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'purchase' AND x.ts <= e.ts) WHERE e.event_type = 'click' GROUP BY e.event_id""")
def jon26(t):
    clicks = t.events.where("event_type = 'click'").select("user_id", "ts", "event_id")
    buys = t.events.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_purchase"))
    return R.as_of(clicks, buys, ["user_id"], "ts", "last_purchase").select("event_id", "last_purchase")


@query("agg01_table_counts", """
SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders""")
def agg01(t):
    out = None
    for name in ("customer", "documents", "lineitem", "orders"):
        own = getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = own if out is None else out.unionByName(own)
    return out


@query("agg02_status_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def agg02(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("agg03_set13_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def agg03(t):
    return R.duplicated(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("agg04_agg05_conflicts", """
SELECT (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_partkey) > 1)) AS conflicting, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS keys""")
def agg04(t):
    per = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg((F.min("l_partkey") != F.max("l_partkey")).alias("several"))
    return per.agg(F.count_if("several").alias("conflicting"), F.count("*").alias("keys"))


@query("agg06_exploded_counts", """
SELECT word, count(*) AS n, count(*) FILTER (WHERE parts > 1) AS of_several FROM (SELECT unnest(string_split(p_type, ' ')) AS word, len(string_split(p_type, ' ')) AS parts FROM part) GROUP BY word""")
def agg06(t):
    words = t.part.select(F.split("p_type", " ").alias("w")).select(F.size("w").alias("parts"), F.explode("w").alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"), F.count_if(F.col("parts") > 1).alias("of_several"))


@query("agg07_zero_filled", """
SELECT r_name, s AS status, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey AND o_orderstatus = s) AS n FROM region, (VALUES ('F'), ('O'), ('P'), ('X')) v(s)""")
def agg07(t):
    per = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    fixed = t.region.select("r_regionkey", "r_name", F.explode(F.array(*map(F.lit, "FOPX"))).alias("status"))
    return fixed.join(per.withColumnRenamed("n_regionkey", "r_regionkey"), ["r_regionkey", "status"], "left").select("r_name", "status", F.coalesce("n", F.lit(0)).alias("n"))


@query("agg08_agg13_ordered_text", """
SELECT o_custkey, string_agg(o_orderpriority, '; ' ORDER BY o_orderdate, o_orderkey) AS priorities FROM orders GROUP BY o_custkey""")
def agg08(t):
    return t.orders.groupBy("o_custkey").agg(R.ordered_text(F.col("o_orderpriority"), [F.col("o_orderdate"), F.col("o_orderkey")]).alias("priorities"))


@query("agg09_pivot", """
SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS finished, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS opened,
       string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS others FROM orders GROUP BY o_custkey""")
def agg09(t):
    own = lambda c: X.blank_to_null(R.ordered_text(F.when(c, F.col("o_orderkey").cast("string")), [F.col("o_orderkey")], ","))
    s = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(own(s == "F").alias("finished"), own(s == "O").alias("opened"), own(~s.isin("F", "O")).alias("others"))


@query("agg10_agg12_fallback", """
SELECT o_custkey, coalesce(min(o_orderpriority) FILTER (WHERE o_orderstatus = 'P'), string_agg(DISTINCT o_orderpriority, '/' ORDER BY o_orderpriority)) AS label FROM orders GROUP BY o_custkey""")
def agg10(t):
    names = F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "/")
    return t.orders.groupBy("o_custkey").agg(F.coalesce(F.min(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))), names).alias("label"))


@query("agg11_set_union", """
SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey""")
def agg11(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"), F.countDistinct("l_partkey").alias("parts"))


@query("agg14_signature_groups", """
SELECT sha256(l_returnflag || '|' || l_linestatus || '|' || (l_quantity::INTEGER % 10)) AS signature, min(l_orderkey) AS first_order, count(*) AS n, bool_or(l_discount > 0.09) AS review FROM lineitem GROUP BY 1""")
def agg14(t):
    signature = F.sha2(F.concat_ws("|", "l_returnflag", "l_linestatus", (F.col("l_quantity").cast("int") % 10).cast("string")), 256)
    return t.lineitem.groupBy(signature.alias("signature")).agg(F.min("l_orderkey").alias("first_order"), F.count("*").alias("n"), F.bool_or(F.col("l_discount") > 0.09).alias("review"))


@query("agg16_complementary", """
SELECT l_orderkey, l_linenumber, CASE WHEN count(DISTINCT l_quantity) > 1 THEN 'conflict' WHEN count(DISTINCT l_suppkey) > 1 THEN 'complementary' ELSE 'single' END AS status FROM lineitem GROUP BY 1, 2""")
def agg16(t):
    status = F.when(F.min("l_quantity") != F.max("l_quantity"), "conflict").when(F.min("l_suppkey") != F.max("l_suppkey"), "complementary").otherwise("single")
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(status.alias("status"))


@query("agg17_merge_or_quarantine", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY ALL), c AS (SELECT l_orderkey, l_linenumber, count(*) AS k, sum(n)::BIGINT AS n, min(v) AS v FROM f GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, CASE WHEN k = 1 THEN v END AS value, n, CASE WHEN k = 1 THEN 'merged' ELSE 'quarantined' END AS status FROM c""")
def agg17(t):
    per = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("high"), F.count("*").alias("n"))
    one = F.col("low") == F.col("high")
    return per.select("l_orderkey", "l_linenumber", F.when(one, F.col("low")).alias("value"), "n", F.when(one, "merged").otherwise("quarantined").alias("status"))


@query("agg19_shared_context", """
WITH g AS (SELECT DISTINCT o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderstatus END AS context FROM orders),
n AS (SELECT *, count(DISTINCT context) FILTER (WHERE context <> 'unknown') OVER (PARTITION BY o_custkey) AS known, max(context) FILTER (WHERE context <> 'unknown') OVER (PARTITION BY o_custkey) AS only_one FROM g)
SELECT DISTINCT o_custkey, CASE WHEN context = 'unknown' AND known = 1 THEN only_one ELSE context END AS context FROM n WHERE NOT (context = 'unknown' AND known > 1)""")
def agg19(t):
    g = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_orderstatus")).alias("context")).distinct()
    w = Window.partitionBy("o_custkey")
    own = F.when(F.col("context") != "unknown", F.col("context"))
    n = g.withColumns({"known": F.count(own).over(w), "only_one": F.max(own).over(w)})
    return n.where("not (context = 'unknown' and known > 1)").select("o_custkey", F.when((F.col("context") == "unknown") & (F.col("known") == 1), F.col("only_one")).otherwise(F.col("context")).alias("context")).distinct()


@query("agg20_agg23_recall", """
WITH r AS (SELECT o_custkey % 7 AS category, o_orderkey, o_orderstatus = 'F' AS relevant, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS found FROM orders)
SELECT category, round(CASE WHEN sum(relevant::INT) > 0 THEN sum((relevant AND found)::INT) / sum(relevant::INT) ELSE 0 END, 6) AS recall, round(CASE WHEN sum(found::INT) > 0 THEN sum((relevant AND found)::INT) / sum(found::INT) ELSE 0 END, 6) AS precision_, bool_and(found) AS complete FROM r GROUP BY category""")
def agg20(t):
    flagged = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    r = t.orders.join(flagged, "o_orderkey", "left").select((F.col("o_custkey") % 7).alias("category"), (F.col("o_orderstatus") == "F").alias("relevant"), F.coalesce("hit", F.lit(False)).alias("found"))
    both, share = F.count_if(F.col("relevant") & F.col("found")), lambda n: F.round(F.coalesce(F.try_divide(F.count_if(F.col("relevant") & F.col("found")), n), F.lit(0.0)), 6)
    return r.groupBy("category").agg(share(F.count_if("relevant")).alias("recall"), share(F.count_if("found")).alias("precision_"), F.bool_and("found").alias("complete"))


@query("agg21_recall_at_k", """
WITH h AS (SELECT o_custkey, o_orderstatus = 'F' AS good, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT o_custkey, min(rank) FILTER (WHERE good) AS first_hit, coalesce(min(rank) FILTER (WHERE good) <= 3, false) AS hit_at_3 FROM h GROUP BY o_custkey""")
def agg21(t):
    h = t.orders.withColumn("rank", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("long"))
    first = F.min(F.when(F.col("o_orderstatus") == "F", F.col("rank")))
    return h.groupBy("o_custkey").agg(first.alias("first_hit"), F.coalesce(first <= 3, F.lit(False)).alias("hit_at_3"))


@query("agg25_coverage", """
SELECT l_suppkey, count(DISTINCT l_returnflag) = 3 AS covered, concat_ws(',', CASE WHEN NOT bool_or(l_returnflag = 'A') THEN 'A' END, CASE WHEN NOT bool_or(l_returnflag = 'N') THEN 'N' END, CASE WHEN NOT bool_or(l_returnflag = 'R') THEN 'R' END) AS missing FROM lineitem GROUP BY l_suppkey""")
def agg25(t):
    return flag_coverage(t.lineitem)


def flag_coverage(lineitem):
    per = lineitem.groupBy("l_suppkey").agg(F.array_except(F.array(*map(F.lit, "ANR")), F.collect_set("l_returnflag")).alias("left"))
    return per.select("l_suppkey", (F.size("left") == 0).alias("covered"), F.array_join("left", ",").alias("missing"))


@query("agg27_accounting", """
SELECT l_returnflag AS disposition, count(*) AS n, (SELECT count(*) FROM lineitem) AS total, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS omitted FROM lineitem GROUP BY 1""")
def agg27(t):
    per = t.lineitem.groupBy(F.col("l_returnflag").alias("disposition")).agg(F.count("*").alias("n"))
    omitted = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.count("*").alias("omitted"))
    total = t.lineitem.agg(F.count("*").alias("total"))
    return per.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(omitted)).select("disposition", "n", "total", "omitted")  # one row each


@query("agg28_win09_streaks", """
WITH i AS (SELECT user_id, (value < 50)::INT AS f, sum(1 - (value < 50)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, max(n)::BIGINT AS longest FROM (SELECT user_id, island, sum(f) AS n FROM i GROUP BY 1, 2) GROUP BY user_id""")
def agg28(t):
    return R.streaks(t.events, ["user_id"], ["ts", "event_id"], F.col("value") < 50)


@query("agg29_set11_fingerprints", """
WITH f AS (SELECT l_orderkey, CASE WHEN bool_or(l_partkey % 50 = 0) THEN NULL ELSE sha256(string_agg(l_partkey || ':' || l_quantity::INTEGER, ';' ORDER BY l_partkey, l_quantity::INTEGER)) END AS fp FROM lineitem GROUP BY l_orderkey)
SELECT fp AS fingerprint, count(*) AS n FROM f GROUP BY fp""")
def agg29(t):
    parts = F.array_sort(F.collect_list(F.struct("l_partkey", F.col("l_quantity").cast("int").alias("q"))))
    text = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["l_partkey"], x["q"])), ";")
    per = t.lineitem.groupBy("l_orderkey").agg(F.when(~F.bool_or(F.col("l_partkey") % 50 == 0), F.sha2(text, 256)).alias("fingerprint"))
    return per.groupBy("fingerprint").agg(F.count("*").alias("n"))


@query("agg31_expected_counts", "SELECT o_custkey, sum(n)::BIGINT AS expected FROM (SELECT o_custkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders) GROUP BY 1")
def agg31(t):
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return t.orders.join(per, "o_orderkey", "left").groupBy("o_custkey").agg(F.sum(F.coalesce("n", F.lit(0))).alias("expected"))


@query("agg32_totals_and_parts", "SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg32(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).select(F.coalesce("l_returnflag", F.lit("all")).alias("flag"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n")


@query("win06_next_start", "SELECT event_id, epoch_us(lead(ts) OVER w) - epoch_us(ts) AS gap_us, event_id = last_value(event_id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def win06(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", (F.unix_micros(F.lead("ts").over(w).cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))).alias("gap_us"), F.lead("event_id").over(w).isNull().alias("final"))


@query("win07_numbering", "SELECT o_orderkey, 'candidate_' || lpad((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::VARCHAR, 5, '0') AS candidate FROM orders")
def win07(t):
    k = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t.orders.select("o_orderkey", F.concat(F.lit("candidate_"), F.lpad(k.cast("string"), 5, "0")).alias("candidate"))


@query("win11_continuation", "SELECT conv_id, turn, text || CASE WHEN lead(role) OVER w = role THEN ' ' || lead(text) OVER w ELSE '' END AS joined FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)")
def win11(t):
    w = Window.partitionBy("conv_id").orderBy("turn", "text")
    return t.conversations.select("conv_id", "turn", F.concat("text", F.when(F.lead("role").over(w) == F.col("role"), F.concat(F.lit(" "), F.lead("text").over(w))).otherwise("")).alias("joined"))


@query("top01_top02_ordering", """
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, coalesce(o_orderdate, TIMESTAMP '1900-01-01'), o_orderkey) AS k FROM orders) WHERE k = 1""")
def top01(t):
    priority = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    return R.latest(t.orders, ["o_custkey"], [priority, F.coalesce("o_orderdate", F.lit("1900-01-01").cast("timestamp")), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("top07_stratified", """
WITH f AS (SELECT doc_id FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 5), g AS (SELECT doc_id FROM documents WHERE source = 'src0' AND doc_id NOT IN (SELECT doc_id FROM f) ORDER BY doc_id LIMIT 5),
h AS (SELECT doc_id FROM documents WHERE n_chars > 3000 AND doc_id NOT IN (SELECT doc_id FROM f UNION SELECT doc_id FROM g) ORDER BY doc_id LIMIT 5)
SELECT 'german' AS stratum, doc_id FROM f UNION ALL SELECT 'first_source', doc_id FROM g UNION ALL SELECT 'long', doc_id FROM h""")
def top07(t):
    docs = t.documents.select("doc_id", "lang", "source", "n_chars")
    return R.stratified(docs, "doc_id", [("german", F.col("lang") == "de"), ("first_source", F.col("source") == "src0"), ("long", F.col("n_chars") > 3000)], 5).select("stratum", "doc_id")


@query("top13_overlap_ranking", r"""
WITH s AS (SELECT p_partkey, (contains(lower(p_name), '1'))::INT + (contains(lower(p_type), 'steel'))::INT + (contains(lower(p_brand), '3'))::INT AS score FROM part)
SELECT p_partkey, score FROM s WHERE score > 0 ORDER BY score DESC, p_partkey DESC LIMIT 20""")
def top13(t):
    score = F.lower("p_name").contains("1").cast("int") + F.lower("p_type").contains("steel").cast("int") + F.lower("p_brand").contains("3").cast("int")
    return t.part.select("p_partkey", score.alias("score")).where("score > 0").orderBy(F.desc("score"), F.desc("p_partkey")).limit(20)


@query("top14_top15_top16_best_of", """
SELECT source, arg_max(doc_id, struct_pack(n := n_chars, d := -doc_id)) AS largest, min(doc_id) AS first_one FROM documents GROUP BY source""")
def top14(t):
    return t.documents.groupBy("source").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("largest"), F.min("doc_id").alias("first_one"))


@query("top17_top18_preferred", """
SELECT p.p_partkey, coalesce(a.l_returnflag, b.l_returnflag, 'none') AS preferred FROM part p
LEFT JOIN (SELECT l_partkey, min(l_returnflag) AS l_returnflag FROM lineitem WHERE l_discount > 0.04 GROUP BY 1) a ON a.l_partkey = p.p_partkey
LEFT JOIN (SELECT l_partkey, max(l_returnflag) AS l_returnflag FROM lineitem WHERE l_discount <= 0.04 GROUP BY 1) b ON b.l_partkey = p.p_partkey""")
def top17(t):
    a = t.lineitem.where("l_discount > 0.04").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_returnflag").alias("a"))
    b = t.lineitem.where("l_discount <= 0.04").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_returnflag").alias("b"))
    return t.part.select("p_partkey").join(a, "p_partkey", "left").join(b, "p_partkey", "left").select("p_partkey", F.coalesce("a", "b", F.lit("none")).alias("preferred"))


@query("prj01_prj02_listing_filter", """
SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND contains(lower(c_name), '1') AND c_acctbal > 0""")
def prj01(t):
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.lower("c_name").contains("1") & (F.col("c_acctbal") > 0)).select("c_custkey")


@query("prj03_prj04_display", "SELECT event_id, coalesce(CASE WHEN event_id % 5 > 0 THEN event_type END, 'NA') AS kind, event_id || ' ' || user_id || ' u' AS shown FROM events")
def prj03(t):
    return t.events.select("event_id", X.display(F.when(F.col("event_id") % 5 > 0, F.col("event_type"))).alias("kind"), F.concat_ws(" ", "event_id", "user_id", F.lit("u")).alias("shown"))


@query("prj05_prj06_prj07_has_value", """
SELECT event_id, event_id % 4 IN (2, 3) AS reported, event_id % 4 IN (2, 3) OR event_id % 5 = 0 AS usable FROM events""")
def prj05(t):
    k = F.col("event_id")
    raw = F.when(k % 4 == 0, " Not Reported ").when(k % 4 == 1, "N/A").when(k % 4 == 2, "x").otherwise(F.col("event_type"))
    return t.events.select("event_id", X.has_value(raw).alias("reported"), (X.has_value(raw) | (k % 5 == 0)).alias("usable"))


@query("prj08_prj11_screening", r"""
SELECT doc_id, CASE WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'exclude' WHEN n_chars >= 200 AND regexp_matches(text, '\.') AND lang = 'en' THEN 'include' ELSE 'manual_review' END AS decision,
  CASE WHEN regexp_matches(text, '[#$%&*]{3}') THEN '' ELSE concat_ws(',', CASE WHEN n_chars < 200 THEN 'LENGTH' END, CASE WHEN NOT regexp_matches(text, '\.') THEN 'SENTENCES' END, CASE WHEN lang <> 'en' THEN 'LANGUAGE' END) END AS unmet FROM documents""")
def prj08(t):
    out = F.col("text").rlike("[#$%&*]{3}")
    unmet = F.array_compact(F.array(F.when(F.col("n_chars") < 200, "LENGTH"), F.when(~F.col("text").rlike(r"\."), "SENTENCES"), F.when(F.col("lang") != "en", "LANGUAGE")))
    return t.documents.select("doc_id", F.when(out, "exclude").when(F.size(unmet) == 0, "include").otherwise("manual_review").alias("decision"), F.when(out, "").otherwise(F.array_join(unmet, ",")).alias("unmet"))


@query("prj15_complexity", """
WITH a AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_returnflag) AS families FROM lineitem GROUP BY 1)
SELECT l_orderkey, (CASE WHEN n >= 8 THEN 2 WHEN n >= 4 THEN 1 ELSE 0 END + CASE WHEN families >= 3 THEN 2 WHEN families >= 2 THEN 1 ELSE 0 END)::INTEGER AS score, CASE WHEN n >= 8 THEN 2 WHEN n >= 4 THEN 1 ELSE 0 END + CASE WHEN families >= 3 THEN 2 WHEN families >= 2 THEN 1 ELSE 0 END >= 4 AS complex FROM a""")
def prj15(t):
    a = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.countDistinct("l_returnflag").alias("families"))
    score = F.when(F.col("n") >= 8, 2).when(F.col("n") >= 4, 1).otherwise(0) + F.when(F.col("families") >= 3, 2).when(F.col("families") >= 2, 1).otherwise(0)
    return a.select("l_orderkey", score.alias("score"), (score >= 4).alias("complex"))


@query("prj17_prj18_tags_and_gaps", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS tag, CASE WHEN o_orderstatus = 'P' THEN 'conflict' WHEN o_totalprice > 300000 THEN 'unclear' WHEN o_orderpriority = '1-URGENT' THEN 'complete' ELSE 'not_reported' END AS gap FROM orders""")
def prj17(t):
    labels = F.create_map(F.lit("F"), F.lit("final"), F.lit("O"), F.lit("open"))
    gap = F.when(F.col("o_orderstatus") == "P", "conflict").when(F.col("o_totalprice") > 300000, "unclear").when(F.col("o_orderpriority") == "1-URGENT", "complete").otherwise("not_reported")
    return t.orders.select("o_orderkey", F.coalesce(F.try_element_at(labels, F.col("o_orderstatus")), F.lit("other")).alias("tag"), gap.alias("gap"))


@query("prj19_prj20_completeness", """
SELECT l_orderkey, bool_or(l_returnflag = 'A') AND bool_or(l_returnflag = 'N') AND bool_or(l_returnflag = 'R') AS all_roles, sum(l_quantity::BIGINT)::BIGINT BETWEEN 98 AND 102 AS about_100 FROM lineitem GROUP BY 1""")
def prj19(t):
    return t.lineitem.groupBy("l_orderkey").agg((F.size(F.array_except(F.array(*map(F.lit, "ANR")), F.collect_set("l_returnflag"))) == 0).alias("all_roles"), F.sum(F.col("l_quantity").cast("long")).between(98, 102).alias("about_100"))


@query("prj22_prj23_leak_guard", """
SELECT event_id, 'k' AS field FROM events WHERE regexp_matches(props, '"k"')""")
def prj22(t):
    keys = t.events.select("event_id", F.explode(F.map_keys(F.from_json("props", "map<string,string>"))).alias("field"))
    return keys.where(F.col("field").rlike("(?i)gold|answer|^k$"))


@query("set01_statuses", """
SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'rejected' ELSE 'accepted' END AS status, 'direct' AS via FROM lineitem UNION ALL SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'accepted' ELSE 'review' END, 'link' FROM orders""")
def set01(t):
    direct = t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") == "R", "rejected").otherwise("accepted").alias("status"), F.lit("direct").alias("via"))
    return direct.unionByName(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("review").alias("status"), F.lit("link").alias("via")))


@query("set03_ordered_distinct", """
SELECT conv_id, string_agg(role, ',' ORDER BY first_turn, role) AS roles FROM (SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY 1, 2) GROUP BY conv_id""")
def set03(t):
    firsts = t.conversations.groupBy("conv_id", "role").agg(F.min("turn").alias("first_turn"))
    return firsts.groupBy("conv_id").agg(R.ordered_text(F.col("role"), [F.col("first_turn"), F.col("role")], ",").alias("roles"))


@query("set05_set06_remap", """
WITH m AS (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_brand, p_type, p_size) AS kept FROM part)
SELECT l_orderkey, l_linenumber, l_partkey, kept FROM lineitem JOIN m ON p_partkey = l_partkey WHERE kept <> l_partkey""")
def set05(t):
    key = ["p_brand", "p_type", "p_size"]
    firsts = t.part.groupBy(*key).agg(F.min("p_partkey").alias("kept"))
    mapping = t.part.join(firsts, key).where("kept <> p_partkey").select(F.col("p_partkey").alias("l_partkey"), "kept")
    return t.lineitem.join(mapping, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "kept")


@query("set08_fact_dedup", "SELECT l_partkey, l_suppkey, count(*) - 1 AS repeated FROM lineitem GROUP BY 1, 2")
def set08(t):
    return t.lineitem.groupBy("l_partkey", "l_suppkey").agg((F.count("*") - 1).alias("repeated"))


@query("set12_jsn04_identity", """
SELECT event_id, sha256('=' || user_id || '|=' || event_type || '|' || CASE WHEN event_id % 2 = 0 THEN '=' || event_id ELSE '-' END) AS identity FROM events""")
def set12(t):
    return t.events.select("event_id", X.digest(F.col("user_id"), F.col("event_type"), F.when(F.col("event_id") % 2 == 0, F.col("event_id"))).alias("identity"))


@query("set14_snk06_append_absent", """
SELECT doc_id, 'known' AS origin FROM labels UNION ALL SELECT doc_id, 'added' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def set14(t):
    known = t.labels.select("doc_id", F.lit("known").alias("origin"))
    return known.unionByName(t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id", F.lit("added").alias("origin")))


@query("set15_pip37_overlay", """
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE -1 END AS quality, CASE WHEN l.doc_id IS NULL THEN 'base' ELSE 'replaced' END AS origin FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.toxic = 0""")
def set15(t):
    new = t.labels.where("toxic = 0").select("doc_id", "quality", F.lit("replaced").alias("o"))
    return t.documents.select("doc_id").join(new, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("o", F.lit("base")).alias("origin"))


@query("snk02_import_decisions", """
WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS key, l_partkey AS content FROM lineitem WHERE l_suppkey % 2 = 0), i AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS key, l_partkey AS content FROM lineitem)
SELECT key, content, CASE WHEN key NOT IN (SELECT key FROM k) THEN 'new' WHEN EXISTS (SELECT 1 FROM k WHERE k.key = i.key AND k.content = i.content) THEN 'unchanged' ELSE 'conflict' END AS decision FROM i""")
def snk02(t):
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), F.col("l_partkey").alias("content"), "l_suppkey")
    return R.import_decisions(rows.where("l_suppkey % 2 = 0"), rows.select("key", "content").distinct(), "key", "content")


@query("snk05_upsert", """
WITH t AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0), s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'changed' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 5 <> 0)
SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.v ELSE t.v END AS v, CASE WHEN t.k IS NULL THEN 'insert' WHEN s.k IS NOT NULL AND t.v IS DISTINCT FROM s.v THEN 'update' ELSE 'keep' END AS action FROM t FULL JOIN s ON t.k = s.k""")
def snk05(t):
    target = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    source = t.customer.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, "changed").otherwise(F.col("c_mktsegment")).alias("v"))
    return R.upserted(target, source, ["k"], ["v"])


@query("snk08_table_digest")
def snk08(t):
    out = None
    for name, df in (("customer", t.customer), ("orders", t.orders), ("labels", t.labels)):
        own = R.table_digest(df, X.digest(*(F.col(c) for c in df.columns))).withColumn("name", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out


@query("snk14_snk15_migration", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN 'early' END AS note, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN o IS NULL THEN 'idle' ELSE 'active' END AS state FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON o = c_custkey""")
def snk14(t):
    """Rows of a table of the old form join those of the new one, with the new column empty and the state filled in."""
    new = t.customer.where("c_custkey % 10 = 0").select("c_custkey", "c_name", "c_acctbal", F.lit("early").alias("note"))
    both = t.customer.where("c_custkey % 10 <> 0").select("c_custkey", "c_name", "c_acctbal").unionByName(new, allowMissingColumns=True)
    active = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("o", F.lit(1))
    state = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("o").isNull(), "idle").otherwise("active")
    return both.join(active, "c_custkey", "left").select("c_custkey", "c_name", "note", state.alias("state"))


@query("pip26_integrity_checks", """
SELECT 'orphan_label' AS "check", doc_id::VARCHAR AS key FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'order_without_line', o_orderkey::VARCHAR FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'repeated_line', l_orderkey || '-' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'bad_discount', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_discount > 0.095""")
def pip26(t):
    line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return R.violations([
        ("orphan_label", R.missing_parents(t.labels, t.documents, "doc_id"), F.col("doc_id")),
        ("order_without_line", t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"), F.col("o_orderkey")),
        ("repeated_line", R.duplicated(t.lineitem, ["l_orderkey", "l_linenumber"]), line),
        ("bad_discount", t.lineitem.where("l_discount > 0.095"), line),
    ])


@query("pip30_nested_detail", """
SELECT c_custkey, string_agg(o_orderkey || ':' || n, ',' ORDER BY o_orderkey) AS orders_and_lines FROM customer JOIN (SELECT o_custkey, o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) ON o_custkey = c_custkey GROUP BY c_custkey""")
def pip30(t):
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    lines = t.orders.join(per, "o_orderkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return lines.groupBy(F.col("o_custkey").alias("c_custkey")).agg(R.ordered_text(F.concat_ws(":", "o_orderkey", "n"), [F.col("o_orderkey")], ",").alias("orders_and_lines"))
