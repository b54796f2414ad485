"""Queries of corpus imports and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evidence as V
from tessera.operators import assignment as A
from tessera.operators import imports as M
from tessera.operators import readiness as D
from tessera.operators import relational as R
from tessera.plans.registry import query
from tessera.sources import manifests as S


@query("pip01_ext01_win07_candidate_index")
def pip01(t):
    """Parts of two sources, clustered by shared name and by brand, size and type, numbered in order of their first part."""
    records = t.part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "first").otherwise("second").alias("source"))
    keys = t.part.select("p_partkey", F.explode(F.array(F.concat_ws("|", F.lit("n"), "p_name", "p_brand"), F.concat_ws("|", F.lit("t"), "p_brand", "p_size", "p_type"))).alias("key")).distinct()
    return M.numbered_candidates(records, keys, "p_partkey")


@query("win07_dense_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS number FROM orders")
def win07(t):
    return M.dense_numbers(t.orders.select("o_orderkey"), "o_orderkey", "number")


@query("ext12_found_or_created", """
WITH e AS (SELECT l_partkey, l_linenumber, min(l_orderkey) AS id FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), i AS (SELECT DISTINCT l_partkey, l_linenumber FROM lineitem)
SELECT l_partkey, l_linenumber, coalesce(id::VARCHAR, 'ev-' || left(sha256('=' || l_partkey || '|=' || l_linenumber), 16)) AS evidence_id, id IS NULL AS created FROM i LEFT JOIN e USING (l_partkey, l_linenumber)""")
def ext12(t):
    return M.found_or_created(t.lineitem, t.lineitem.where("l_returnflag = 'R'").withColumn("evidence_id", F.col("l_orderkey")), ["l_partkey", "l_linenumber"])


@query("ext19_ext08_evidence_links", """
WITH l AS (SELECT l_orderkey AS owner, l_partkey AS e, count(*) AS rows FROM lineitem GROUP BY 1, 2)
SELECT owner, e, rows, CASE WHEN e NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) THEN 'unknown_evidence' WHEN owner NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') THEN 'unknown_owner' WHEN rows > 1 THEN 'repeated' ELSE 'linked' END AS state FROM l""")
def ext19(t):
    links = t.lineitem.select(F.col("l_orderkey").alias("owner"), F.col("l_partkey").alias("e"))
    return M.linked(links, t.part.where("p_size > 5").select(F.col("p_partkey").alias("e")), t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("owner")), "e", "owner")


@query("ext18_ext44_corrected_records", """
WITH c AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'c_mktsegment' WHEN o_orderkey % 3 = 1 THEN 'c_name' ELSE 'other' END AS field, arg_max(o_orderpriority, o_orderkey) AS v FROM orders GROUP BY 1, 2)
SELECT c_custkey, coalesce(s.v, c_mktsegment) AS c_mktsegment, coalesce(n.v, c_name) AS c_name, concat_ws(',', CASE WHEN s.v IS NOT NULL THEN 'c_mktsegment' END, CASE WHEN n.v IS NOT NULL THEN 'c_name' END) AS corrected
FROM customer LEFT JOIN c s ON s.k = c_custkey AND s.field = 'c_mktsegment' LEFT JOIN c n ON n.k = c_custkey AND n.field = 'c_name'""")
def ext18(t):
    k = F.col("o_orderkey") % 3
    field = F.when(k == 0, "c_mktsegment").when(k == 1, "c_name").otherwise("other")
    corrections = t.orders.select(F.col("o_custkey").alias("c_custkey"), field.alias("field"), F.col("o_orderpriority").alias("value"), F.col("o_orderkey").alias("no"))
    return M.corrected(t.customer.select("c_custkey", "c_mktsegment", "c_name"), corrections, "c_custkey", ["c_mktsegment", "c_name"])


@query("ext16_pip41_ordered_bundles", """
WITH m AS (SELECT c_custkey AS k, c_custkey * 2 AS position, c_acctbal < 0 AS excluded FROM customer), b AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey - 1 ELSE o_custkey END AS k, count(*) AS n, max(o_orderstatus = 'P') AS blocked FROM orders GROUP BY 1)
SELECT coalesce(m.k, b.k) AS k, position, CASE WHEN position IS NULL THEN 'unlisted' WHEN n IS NULL THEN CASE WHEN excluded THEN 'screening_only' ELSE 'missing' END WHEN n > 1 THEN 'ambiguous' WHEN blocked THEN 'blocked' ELSE 'import' END AS kind FROM m FULL JOIN b ON m.k = b.k""")
def ext16(t):
    manifest = t.customer.select(F.col("c_custkey").alias("k"), (F.col("c_custkey") * 2).alias("position"), (F.col("c_acctbal") < 0).alias("excluded"))
    return M.ordered_bundles(manifest, t.orders.select(F.when(F.col("o_orderkey") % 5 == 0, -F.col("o_orderkey") - 1).otherwise(F.col("o_custkey")).alias("k"), (F.col("o_orderstatus") == "P").alias("blocked")), "k")


@query("ext28_ext17_unified_shapes", """
SELECT l_orderkey AS experiment, 'flag' AS field, l_returnflag AS value, 'map' AS shape FROM lineitem UNION ALL SELECT o_orderkey, 'status', o_orderstatus, 'compact' FROM orders UNION ALL SELECT l_orderkey, 'supplier', l_suppkey::VARCHAR, 'visual' FROM lineitem""")
def ext28(t):
    shape = lambda df, e, f, v: df.select(F.col(e).alias("experiment"), F.lit(f).alias("field"), F.col(v).alias("value"))
    return M.unioned_shapes({"map": shape(t.lineitem, "l_orderkey", "flag", "l_returnflag"), "compact": shape(t.orders, "o_orderkey", "status", "o_orderstatus"), "visual": shape(t.lineitem, "l_orderkey", "supplier", "l_suppkey")})


@query("ext22_bound_requirements", """
WITH r AS (SELECT l_partkey * 10 + l_linenumber AS id, l_orderkey % 500 AS paper, l_orderkey AS e FROM lineitem), n AS (SELECT id, count(*) AS n FROM r GROUP BY 1), x AS (SELECT o_orderkey AS e, o_custkey % 500 AS p FROM orders WHERE o_orderstatus <> 'P')
SELECT id AS reference_id, paper, e AS experiment, CASE WHEN n > 1 THEN 'duplicate' WHEN p IS NULL THEN 'unknown_experiment' WHEN p <> paper THEN 'other_paper' ELSE 'bound' END AS state FROM r JOIN n USING (id) LEFT JOIN x USING (e)""")
def ext22(t):
    requirements = t.lineitem.select((F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("reference_id"), (F.col("l_orderkey") % 500).alias("paper"), F.col("l_orderkey").alias("experiment"))
    return M.bound_requirements(requirements, t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("experiment"), (F.col("o_custkey") % 500).alias("paper")))


@query("ext23_ext24_scored_requirements", """
WITH q AS (SELECT DISTINCT l_orderkey * 100 + l_linenumber AS id, l_returnflag AS category, l_orderkey AS e, l_linenumber AS f, [lower(l_linestatus), 's' || l_suppkey] AS v FROM lineitem WHERE l_partkey % 3 > 0),
f AS (SELECT DISTINCT l_orderkey AS e, l_linenumber AS f, 's' || l_suppkey AS v FROM lineitem WHERE l_partkey % 2 = 0), u AS (SELECT id, category, e, f, unnest(v) AS v FROM q),
r AS (SELECT DISTINCT id, category, id IN (SELECT id FROM u JOIN f USING (e, f, v)) AS met, id IN (SELECT id FROM u JOIN (SELECT DISTINCT f, v FROM f) USING (f, v)) AS seen FROM q)
SELECT category, count(*) AS n, count(*) FILTER (WHERE met) AS met, count(*) FILTER (WHERE seen AND NOT met) AS wrong_arm, round(count(*) FILTER (WHERE met) / count(*), 6) AS recall FROM r GROUP BY 1""")
def ext23(t):
    own = F.concat(F.lit("S"), "l_suppkey")
    requirements = t.lineitem.where("l_partkey % 3 > 0").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"), F.col("l_returnflag").alias("category"), F.col("l_orderkey").alias("experiment"), F.col("l_linenumber").alias("field"), F.array("l_linestatus", own).alias("values")).distinct()
    return M.scored_requirements(requirements, t.lineitem.where("l_partkey % 2 = 0").select(F.col("l_orderkey").alias("experiment"), F.col("l_linenumber").alias("field"), own.alias("value")))


@query("ext23_safety_counts", """
WITH f AS (SELECT conv_id AS id, conv_id * 7 + turn AS source, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS number FROM conversations)
SELECT (SELECT count(*) FROM f WHERE id NOT IN (SELECT doc_id FROM labels)) AS invented_ids, (SELECT count(*) FROM f LEFT JOIN documents ON doc_id = f.source WHERE number IS NOT NULL AND NOT coalesce(contains(documents.text, number), FALSE)) AS unsupported_numbers""")
def ext23_safety(t):
    number = F.regexp_extract("text", "([0-9]+)", 1)
    facts = t.conversations.select(F.col("conv_id").alias("id"), (F.col("conv_id") * 7 + F.col("turn")).alias("source"), F.when(number != "", number).alias("number"))
    return M.safety_counts(facts, t.labels.select(F.col("doc_id").alias("id")), t.documents.select(F.col("doc_id").alias("source"), "text"))


@query("ext26_confusion", """
WITH r AS (SELECT l_returnflag AS k, l_discount > 0.05 AS p, l_tax > 0.04 AS w FROM lineitem), c AS (SELECT k, count(*) FILTER (WHERE p AND w) AS tp, count(*) FILTER (WHERE p AND NOT w) AS fp, count(*) FILTER (WHERE NOT p AND w) AS fn, count(*) FILTER (WHERE NOT p AND NOT w) AS tn FROM r GROUP BY 1)
SELECT *, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall FROM c""")
def ext26(t):
    return M.confusion(t.lineitem.select(F.col("l_returnflag").alias("k"), (F.col("l_discount") > 0.05).alias("p"), (F.col("l_tax") > 0.04).alias("w")), "k", "p", "w")


@query("ext37_associated_visuals", """
WITH r AS (SELECT DISTINCT l_orderkey AS paper, l_orderkey * 1000000 + l_partkey * 100 + l_linenumber AS id, CASE WHEN l_partkey % 5 > 0 THEN l_returnflag || l_linestatus END AS sig FROM lineitem), x AS (SELECT DISTINCT l_orderkey AS paper, l_returnflag || l_linestatus AS sig, l_suppkey AS e FROM lineitem WHERE l_linenumber <= 2),
p AS (SELECT paper, sig, count(*) AS n, min(e) AS e FROM x GROUP BY 1, 2), s AS (SELECT r.*, CASE WHEN r.paper NOT IN (SELECT paper FROM x) THEN 'no_inventory' WHEN r.sig IS NULL THEN 'unresolved' WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'associated' END AS state, e FROM r LEFT JOIN p ON p.paper = r.paper AND p.sig = r.sig)
SELECT id, CASE WHEN state = 'associated' THEN e END AS experiment, state FROM s""")
def ext37(t):
    signature = F.concat("l_returnflag", "l_linestatus")
    records = t.lineitem.select(F.col("l_orderkey").alias("paper"), (F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_partkey") % 5 > 0, signature).alias("signature")).distinct()
    experiments = t.lineitem.where("l_linenumber <= 2").select(F.col("l_orderkey").alias("paper"), signature.alias("signature"), F.col("l_suppkey").alias("experiment")).distinct()
    return M.associated(records, experiments, ["paper"])


@query("pip17_qualified_slots", """
WITH e AS (SELECT o_orderkey AS record, l_partkey AS id, l_returnflag || l_linestatus || l_linenumber AS text FROM orders JOIN lineitem ON l_orderkey = o_orderkey), s(slot, p) AS (VALUES ('returned', 'R'), ('open', 'O'), ('first', '1$')),
h AS (SELECT record, slot, count(DISTINCT id) AS n, min(id) AS e FROM e, s WHERE regexp_matches(text, p) GROUP BY 1, 2)
SELECT o_orderkey AS record, s.slot, CASE WHEN n IS NULL THEN 'open' WHEN n > 1 THEN 'ambiguous' ELSE 'qualified' END AS state, CASE WHEN n = 1 THEN e END AS evidence FROM orders CROSS JOIN s LEFT JOIN h ON record = o_orderkey AND h.slot = s.slot""")
def pip17(t):
    evidence = t.lineitem.select(F.col("l_orderkey").alias("record"), F.col("l_partkey").alias("evidence_id"), F.concat("l_returnflag", "l_linestatus", "l_linenumber").alias("text"))
    return M.qualified_slots(t.orders.select(F.col("o_orderkey").alias("record")), evidence, {"returned": "R", "open": "O", "first": "1$"})


@query("pip13_field_tasks", """
WITH p AS (SELECT l_orderkey AS record, string_agg(id::VARCHAR, ',' ORDER BY k) AS evidence FROM (SELECT l_orderkey, l_partkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS k FROM lineitem) WHERE k <= 5 GROUP BY 1)
SELECT o_orderkey * 10 AS finding, o_orderkey AS record, 'dose' AS field, coalesce(evidence, '') AS evidence, sha256((o_orderkey * 10) || '|dose|' || coalesce(evidence, '')) AS checksum FROM orders LEFT JOIN p ON record = o_orderkey WHERE o_orderstatus <> 'P'""")
def pip13(t):
    findings = t.orders.select((F.col("o_orderkey") * 10).alias("finding"), F.col("o_orderkey").alias("record"), F.lit("dose").alias("field"), (F.col("o_orderstatus") != "P").alias("repairable"))
    return M.field_tasks(findings, t.lineitem.select(F.col("l_orderkey").alias("record"), F.col("l_partkey").alias("evidence_id"), F.col("l_linenumber").alias("place")))


@query("ext41_packet_order", """
WITH o AS (SELECT conv_id, turn, sha256(lower(trim(text))) AS d FROM conversations), f AS (SELECT conv_id, d, min(turn) AS same_as FROM o GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY same_as)::INTEGER AS place FROM f)
SELECT conv_id, turn, same_as, place FROM o JOIN r USING (conv_id, d)""")
def ext41(t):
    return M.packet_order(t.conversations, "conv_id", "turn", F.lower(F.trim("text")))


@query("ext38_pip16_grouped_arms", """
SELECT l_orderkey, l_returnflag, count(*) AS rows, min(l_partkey) AS first_id, concat_ws(',', CASE count(DISTINCT l_linestatus) WHEN 0 THEN 'missing:l_linestatus' WHEN 1 THEN NULL ELSE 'conflict:l_linestatus' END, CASE WHEN count(DISTINCT CASE WHEN l_tax > 0.01 THEN l_linenumber END) = 0 THEN 'missing:dose' WHEN count(DISTINCT CASE WHEN l_tax > 0.01 THEN l_linenumber END) > 1 THEN 'conflict:dose' END) AS problems,
  'arm-' || left(sha256('=' || l_orderkey || '|=' || l_returnflag), 16) AS arm_id FROM lineitem GROUP BY 1, 2""")
def ext38(t):
    return M.grouped_arms(t.lineitem.withColumn("dose", F.when(F.col("l_tax") > 0.01, F.col("l_linenumber"))), ["l_orderkey", "l_returnflag"], "l_partkey", ["l_linestatus", "dose"])


@query("ext43_usage_totals", """
SELECT user_id, count(*) AS results, sum(coalesce((json_extract_string(props, '$.k'))::BIGINT, 0))::BIGINT AS input, sum(CASE WHEN event_type = 'click' THEN 3 ELSE 0 END)::BIGINT AS output, count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL OR event_type <> 'click') AS unmeasured FROM events GROUP BY 1""")
def ext43(t):
    results = t.events.select("user_id", F.get_json_object("props", "$.k").cast("long").alias("input"), F.when(F.col("event_type") == "click", F.lit(3).cast("long")).alias("output"))
    return M.usage_totals(results, "user_id", ["input", "output"])


@query("pip44_manifest_coverage", """
WITH d AS (SELECT DISTINCT source FROM documents), l AS (SELECT source, count(*) AS n, count(labels.doc_id) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
SELECT source, n, labelled, CASE WHEN labelled = 0 THEN 'uncovered' WHEN labelled * 3 < n THEN 'thin' ELSE 'covered' END AS state FROM l""")
def pip44(t):
    """Each source of the manifest: how many of its artifacts are covered."""
    per = t.documents.join(t.labels.select("doc_id", F.lit(1).alias("hit")), "doc_id", "left").groupBy("source").agg(F.count("*").alias("n"), F.count("hit").alias("labelled"))
    return per.withColumn("state", F.when(F.col("labelled") == 0, "uncovered").when(F.col("labelled") * 3 < F.col("n"), "thin").otherwise("covered"))


@query("pip46_ext46_review_rows", """
WITH e AS (SELECT l_orderkey AS k, l_linenumber AS f, min(l_returnflag) AS extracted FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1, 2), s AS (SELECT l_orderkey AS k, l_linenumber AS f, max(l_returnflag) AS source FROM lineitem WHERE l_suppkey % 2 = 1 GROUP BY 1, 2)
SELECT coalesce(e.k, s.k) AS k, coalesce(e.f, s.f) AS f, '| ' || coalesce(e.k, s.k) || ' | ' || coalesce(e.f, s.f) || ' | ' || coalesce(extracted, 'NA') || ' | ' || coalesce(source, 'NA') || ' | ' || CASE WHEN extracted = source THEN 'same' WHEN extracted IS NULL OR source IS NULL THEN 'one side' ELSE 'differs' END || ' |' AS line FROM e FULL JOIN s ON e.k = s.k AND e.f = s.f""")
def pip46(t):
    """What was extracted beside what the source says, a line of a review table each."""
    side = lambda odd, f, name: t.lineitem.where(F.col("l_suppkey") % 2 == odd).groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("f")).agg(f("l_returnflag").alias(name))
    both = side(0, F.min, "extracted").join(side(1, F.max, "source"), ["k", "f"], "full")
    verdict = F.when(F.col("extracted") == F.col("source"), "same").when(F.col("extracted").isNull() | F.col("source").isNull(), "one side").otherwise("differs")
    cells = F.concat_ws(" | ", F.col("k").cast("string"), F.col("f").cast("string"), F.coalesce("extracted", F.lit("NA")), F.coalesce("source", F.lit("NA")), verdict)
    return both.select("k", "f", F.concat(F.lit("| "), cells, F.lit(" |")).alias("line"))


@query("ext36_ext35_bound_tasks", """
WITH t AS (SELECT o_orderkey AS k, sha256(o_orderstatus || o_orderpriority) AS h FROM orders), b AS (SELECT o_orderkey AS k, sha256(CASE WHEN o_orderkey % 6 = 0 THEN 'x' ELSE o_orderstatus END || o_orderpriority) AS h FROM orders WHERE o_orderkey % 11 > 0)
SELECT coalesce(t.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN t.k IS NULL THEN 'added' WHEN t.h = b.h THEN 'unchanged' ELSE 'changed' END AS state FROM t FULL JOIN b ON t.k = b.k""")
def ext36(t):
    """Tasks against the evidence that they were made from, by hash."""
    now = t.orders.select(F.col("o_orderkey").alias("k"), F.sha2(F.concat("o_orderstatus", "o_orderpriority"), 256).alias("h"))
    bound = t.orders.where("o_orderkey % 11 > 0").select(F.col("o_orderkey").alias("k"), F.sha2(F.concat(F.when(F.col("o_orderkey") % 6 == 0, "x").otherwise(F.col("o_orderstatus")), "o_orderpriority"), 256).alias("h"))
    return V.verified_manifest(now, bound, "k", "h")


@query("src11_full_text_sources", """
WITH s AS (SELECT l_orderkey AS k, l_linenumber AS rank, CASE max(l_partkey) % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'no_body' WHEN 2 THEN 'not_xml' ELSE 'no_article' END AS state FROM lineitem GROUP BY 1, 2)
SELECT k, coalesce(min(rank) FILTER (WHERE state = 'valid'), min(rank)) AS rank, CASE WHEN count(*) FILTER (WHERE state = 'valid') > 0 THEN 'valid' ELSE arg_min(state, rank) END AS state FROM s GROUP BY 1""")
def src11(t):
    """Each line number is a source of its order's full text; the first valid one in order counts."""
    k = F.max("l_partkey") % 4
    xml = F.when(k == 0, "<a:article xmlns:a='x'><a:body><p>t</p></a:body></a:article>").when(k == 1, "<article><front/></article>").when(k == 2, "<article><body>").otherwise("<page><body/></page>")
    copies = t.lineitem.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("rank")).agg(xml.alias("xml"))
    return S.first_valid_source(S.full_text_states(copies, ["k", "rank"], "xml"), "k", "rank")


@query("src26_scanned_artifacts", """
WITH f AS (SELECT page_id, url AS path, sha256(html) AS d FROM pages), r AS (SELECT *, regexp_extract(path, '/([a-zA-Z]+)[^/]*$', 1) AS paper, lower(regexp_extract(path, '[.]([^./]+)$', 1)) AS ending FROM f),
s AS (SELECT *, CASE WHEN contains(path, '?') OR contains(path, '#') THEN 'denied' WHEN ending NOT IN ('html', 'com') THEN 'other_kind' WHEN paper = '' THEN 'no_paper' END AS x FROM r), k AS (SELECT d, min(path) AS first_ FROM s WHERE x IS NULL GROUP BY 1)
SELECT path, paper, coalesce(x, CASE WHEN path = first_ THEN 'kept' ELSE 'duplicate' END) AS state FROM s LEFT JOIN k USING (d)""")
def src26(t):
    return S.scanned_artifacts(t.pages.select(F.col("url").alias("path"), F.sha2("html", 256).alias("sha256")), ["html", "com"], ["?", "#"], "/([a-zA-Z]+)[^/]*$")


@query("src25_flagged_rows", "SELECT o_orderkey, left(o_orderkey::VARCHAR, 2) AS paper FROM orders WHERE o_orderstatus = 'F' OR o_orderkey % 3 = 0")
def src25(t):
    flag = F.when(F.col("o_orderstatus") == "F", " Yes").when(F.col("o_orderkey") % 3 == 0, "1").when(F.col("o_orderkey") % 3 == 1, "no")
    return S.flagged_rows(t.orders.withColumn("flag", flag), "flag", "o_orderkey", "paper", 2).select("o_orderkey", "paper")


@query("pip19_import_chain", """
WITH k AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS key, l_partkey AS content FROM lineitem WHERE l_suppkey % 2 = 0), i AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS key, l_partkey AS content FROM lineitem WHERE l_suppkey % 2 = 1),
n AS (SELECT * FROM i WHERE key NOT IN (SELECT key FROM k)), c AS (SELECT DISTINCT key FROM i WHERE key IN (SELECT key FROM k) AND (key, content) NOT IN (SELECT (key, content) FROM k)),
a AS (SELECT key, min(content) AS content, count(*) AS n FROM (SELECT * FROM k UNION ALL SELECT * FROM n) GROUP BY 1),
s AS (SELECT a.key // 10 AS arm, CASE WHEN c.key IS NOT NULL THEN 'conflict' WHEN n > 1 THEN 'merged' ELSE 'plain' END AS kind, content FROM a LEFT JOIN c USING (key))
SELECT arm, count(*) AS records, count(*) FILTER (WHERE kind = 'merged') AS merged, CASE WHEN bool_or(kind = 'conflict') THEN 'conflict' WHEN count(*) < 2 THEN 'incomplete' ELSE 'complete' END AS status FROM s GROUP BY 1""")
def pip19(t):
    """A ledger of half the lines takes in the other half: new records are added, changed ones are conflicts, equal keys merge, and the arms' status is made anew."""
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), F.col("l_partkey").alias("content"), "l_suppkey")
    ledger, incoming = (rows.where(F.col("l_suppkey") % 2 == k).select("key", "content").distinct() for k in (0, 1))
    decided = R.import_decisions(ledger, incoming, "key", "content")
    merged = ledger.unionByName(decided.where("decision = 'new'").select("key", "content")).groupBy("key").agg(F.count("*").alias("n"))
    clashes = decided.where("decision = 'conflict'").select("key", F.lit(True).alias("clash")).distinct()
    per = merged.join(clashes, "key", "left").groupBy(F.floor(F.col("key") / 10).alias("arm")).agg(F.count("*").alias("records"), F.count_if((F.col("n") > 1) & F.col("clash").isNull()).alias("merged"), F.bool_or(F.coalesce("clash", F.lit(False))).alias("clash"))
    missing = F.when(F.col("records") < 2, F.array(F.lit("records"))).otherwise(F.array().cast("array<string>"))
    return per.select("arm", "records", "merged", D.status(F.lit(False), F.col("clash"), missing).alias("status"))


@query("pip45_ext42_sealed_packets", """
WITH i AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem), c AS (SELECT *, (n - 1) // 3 AS g FROM i)
SELECT l_orderkey, g::INTEGER AS chunk, string_agg('T' || n, ',' ORDER BY n) AS targets, sha256(l_orderkey || '|' || g || '|' || string_agg(l_partkey::VARCHAR, ',' ORDER BY n)) AS seal FROM c GROUP BY l_orderkey, g""")
def pip45(t):
    """Evidence of a paper in packets of three, with target ids issued in order and a seal over what a packet holds."""
    from pyspark.sql import Window

    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    rows = A.chunked(t.lineitem, ["l_orderkey"], order, 3).withColumn("n", F.row_number().over(w))
    own = F.array_sort(F.collect_list(F.struct("n", F.col("l_partkey").cast("string").alias("e"))))
    per = rows.groupBy("l_orderkey", "chunk").agg(own.alias("l"))
    seal = F.sha2(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("chunk").cast("string"), F.array_join(F.transform("l", lambda x: x["e"]), ",")), 256)
    return per.select("l_orderkey", "chunk", F.array_join(F.transform("l", lambda x: F.concat(F.lit("T"), x["n"])), ",").alias("targets"), seal.alias("seal"))


@query("ext52_gap_tasks", """
WITH g AS (SELECT o_orderkey AS k, o_totalprice < 60000 AS dose, o_orderstatus = 'O' AS outcome FROM orders), p AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS page FROM lineitem WHERE l_returnflag = 'R'), f AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS page FROM lineitem WHERE l_linestatus = 'F'),
b AS (SELECT coalesce(p.k, f.k) AS k, count(*) FILTER (WHERE f.k IS NULL) AS new_pages, count(*) FILTER (WHERE p.k IS NULL) AS missed_pages FROM p FULL JOIN f ON p.k = f.k AND p.page = f.page GROUP BY 1)
SELECT g.k, concat_ws(',', CASE WHEN dose THEN 'dose' END, CASE WHEN outcome THEN 'outcome' END) AS fields, coalesce(new_pages, 0) AS new_pages, coalesce(missed_pages, 0) AS missed_pages FROM g LEFT JOIN b USING (k) WHERE dose OR outcome""")
def ext52(t):
    """A task per arm with gaps, and how its candidate pages differ from the frozen ones."""
    gaps = t.orders.select(F.col("o_orderkey").alias("k"), D.reasons({"dose": F.col("o_totalprice") >= 60000, "outcome": F.col("o_orderstatus") != "O"}).alias("gaps")).where(F.size("gaps") > 0)
    pages = lambda c: t.lineitem.where(c).select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("page")).distinct()
    both = pages("l_returnflag = 'R'").withColumn("p", F.lit(1)).join(pages("l_linestatus = 'F'").withColumn("f", F.lit(1)), ["k", "page"], "full")
    per = both.groupBy("k").agg(F.count_if(F.col("f").isNull()).alias("new_pages"), F.count_if(F.col("p").isNull()).alias("missed_pages"))
    return gaps.join(per, "k", "left").na.fill(0, ["new_pages", "missed_pages"]).select("k", F.array_join("gaps", ",").alias("fields"), "new_pages", "missed_pages")
