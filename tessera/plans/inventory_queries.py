"""Queries of annotation, geometry, inventories, decisions and nested views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import evidence as V
from tessera.operators import inventory as I
from tessera.operators import readiness as D
from tessera.operators.facts import merged_payload
from tessera.plans.registry import query
from tessera.plans.text_queries import SENTENCES, sentences

CLASSES = {"number": r"[0-9]+(?:\.[0-9]+)?", "address": r"[a-zA-Z0-9_.]+@[a-zA-Z0-9.]+", "link": r"https?://[^ \n]+", "name": r"[A-Z][a-z]+ [A-Z][a-z]+", "code": r"[A-Z][A-Z]+[0-9]*"}
SPANS = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS class, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS s FROM documents" for n, p in CLASSES.items())


@query("str15_entity_spans", f"""
WITH e AS ({SPANS}), x AS (SELECT doc_id, class, m, s, unnest(range(1, len(m) + 1)) AS i FROM e),
y AS (SELECT doc_id, class, m[i] AS text, (list_sum(list_transform(s[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0))::INTEGER AS start FROM x)
SELECT doc_id, class, start, (start + length(text))::INTEGER AS stop, text FROM y""")
def str15(t):
    return I.entities(t.documents, "doc_id", "text", CLASSES)


TAGS = {"numeric": "[0-9]", "question": r"\?", "legal": "(?i)licen[cs]e", "contact": "@", "web": "https?://", "shouting": "[A-Z]{4,}", "list": r"(?m)^[-*] ", "money": r"[$€£]", "quote": "\"", "aside": r"\("}


@query("str17_retrieval_tags", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in TAGS.items()) + "], lambda x: x IS NOT NULL), ',') AS tags FROM documents")
def str17(t):
    return t.documents.select("doc_id", F.array_join(I.tags(F.col("text"), TAGS), ",").alias("tags"))


@query("str10_endpoint_windows", rf"""
WITH {SENTENCES}, w AS (SELECT doc_id, place, regexp_extract_all(lower(sentence), '[a-z0-9]+') AS w FROM sentences),
d AS (SELECT *, list_min(list_filter([list_position(w, 'in'), list_position(w, 'of'), list_position(w, 'von'), list_position(w, 'dans')], lambda p: p > 0)) AS p FROM w),
o AS (SELECT *, CASE WHEN p IS NULL THEN [] ELSE w[p + 1 : p + 7] END AS o FROM d), e AS (SELECT *, list_min(list_filter([list_position(o, 'than'), list_position(o, 'and'), list_position(o, 'und')], lambda q: q > 0)) AS q FROM o)
SELECT doc_id, place, array_to_string(CASE WHEN q IS NULL THEN o ELSE o[1 : q - 1] END, ' ') AS endpoint FROM e""")
def str10(t):
    words = F.regexp_extract_all(F.lower("sentence"), F.lit("([a-z0-9]+)"), 1)
    return sentences(t).select("doc_id", "place", F.array_join(I.endpoint_window(words, ["in", "of", "von", "dans"], ["than", "and", "und"]), " ").alias("endpoint"))


MARKER, NEGATIVE = "(?:, (?:but|and|aber|et|y) |; )", r"(?:^|[^a-z])(?:not|no|nicht|ne|pas|sin)(?:[^a-z]|$)"


@query("str12_clauses", rf"""
WITH {SENTENCES}, c AS (SELECT doc_id, place, string_split(regexp_replace(sentence, '{MARKER}', chr(1), 'g'), chr(1)) AS c FROM sentences),
e AS (SELECT doc_id, place, unnest(c) AS text, (generate_subscripts(c, 1) - 1)::INTEGER AS clause, c[1] AS head FROM c),
p AS (SELECT *, CASE WHEN regexp_matches(text, '{NEGATIVE}') THEN 'negative' ELSE 'positive' END AS polarity, CASE WHEN regexp_matches(head, '{NEGATIVE}') THEN 'negative' ELSE 'positive' END AS first FROM e)
SELECT doc_id, place, clause, CASE WHEN clause > 0 AND polarity <> first AND regexp_matches(text, '^[a-z]') THEN regexp_extract(head, '^([^ \t\n\r\f\v]+)', 1) || ' ' || text ELSE text END AS text, polarity FROM p""")
def str12(t):
    return I.polar_clauses(sentences(t), ["doc_id", "place"], "sentence", MARKER, NEGATIVE)


@query("str20_str21_payload_signatures", r"""
SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type), 'steel|tin') THEN 'iron' WHEN regexp_matches(lower(p_type), 'brass|copper') THEN 'copper' WHEN regexp_matches(lower(p_type), 'nickel') THEN 'nickel' ELSE 'other' END AS signature,
  CASE WHEN (contains(lower(p_type), 'small'))::INT + (contains(lower(p_type), 'large'))::INT + (contains(lower(p_type), 'medium'))::INT = 1 THEN CASE WHEN contains(lower(p_type), 'small') THEN 'small' WHEN contains(lower(p_type), 'large') THEN 'large' ELSE 'medium' END ELSE 'other' END AS context,
  regexp_extract(p_type, '^([A-Za-z]+)', 1) AS product, regexp_extract(p_type, '([A-Za-z]+)$', 1) AS target FROM part""")
def str20(t):
    own = F.lower("p_type")
    signature, context = X.first_match(own, {"iron": "steel|tin", "copper": "brass|copper", "nickel": "nickel"}), X.only_match(own, {"small": "small", "large": "large", "medium": "medium"})
    return t.part.select("p_partkey", signature.alias("signature"), context.alias("context"), F.regexp_extract("p_type", "^([A-Za-z]+)", 1).alias("product"), F.regexp_extract("p_type", "([A-Za-z]+)$", 1).alias("target"))


@query("str26_visual_labels", """
WITH l AS (SELECT l_orderkey, list(l_shipmode ORDER BY l_linenumber, l_partkey, l_shipmode) AS l FROM (SELECT l_orderkey, l_linenumber, l_partkey, 'Fig' || l_partkey % 9 || CASE WHEN l_returnflag = 'R' THEN 'a' ELSE lower(l_linestatus) END AS l_shipmode FROM lineitem) GROUP BY 1)
SELECT l_orderkey, CASE WHEN len(list_filter(l, lambda x: x LIKE '%a')) > 0 THEN list_filter(l, lambda x: x LIKE '%a')[1] WHEN len(list_filter(l, lambda x: x LIKE '%f')) > 0 THEN list_filter(l, lambda x: x LIKE '%f')[1] ELSE l[1] END AS label FROM l""")
def str26(t):
    label = F.concat(F.lit("Fig"), F.col("l_partkey") % 9, F.when(F.col("l_returnflag") == "R", "a").otherwise(F.lower("l_linestatus")))
    lists = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", label.alias("label")))).alias("l"))
    return lists.select("l_orderkey", I.preferred_label(F.transform("l", lambda x: x["label"]), ["a", "f"]).alias("label"))


@query("prj21_matching_evidence", rf"""
WITH {SENTENCES} SELECT doc_id, place, 'dose' AS predicate FROM sentences WHERE regexp_matches(sentence, '[0-9]') UNION ALL SELECT doc_id, place, 'comparison' FROM sentences WHERE regexp_matches(lower(sentence), '(^|[^a-z])(than|als|que)([^a-z]|$)')""")
def prj21(t):
    """Evidence that each predicate of an arm lets through."""
    predicates = {"dose": F.col("sentence").rlike("[0-9]"), "comparison": F.lower("sentence").rlike("(^|[^a-z])(than|als|que)([^a-z]|$)")}
    each = F.array_compact(F.array(*(F.when(c, n) for n, c in predicates.items())))
    return sentences(t).select("doc_id", "place", F.explode(each).alias("predicate"))


@query("src21_asset_inventory", """
WITH d AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS p, CASE WHEN l_partkey % 4 > 0 THEN sha256(l_returnflag) END AS sha FROM lineitem), h AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS p, sha256(l_returnflag) AS have FROM lineitem WHERE l_suppkey % 3 > 0),
s AS (SELECT d.*, CASE WHEN have IS NULL THEN 'missing' WHEN sha IS NULL OR sha = have THEN 'local' ELSE 'hash_mismatched' END AS s FROM d LEFT JOIN h USING (o, p))
SELECT o AS paper, count(*) AS declared, coalesce(string_agg(DISTINCT p::VARCHAR, ',' ORDER BY p::VARCHAR) FILTER (WHERE s = 'local'), '') AS local, coalesce(string_agg(DISTINCT p::VARCHAR, ',' ORDER BY p::VARCHAR) FILTER (WHERE s = 'missing'), '') AS missing,
  coalesce(string_agg(DISTINCT p::VARCHAR, ',' ORDER BY p::VARCHAR) FILTER (WHERE s = 'hash_mismatched'), '') AS hash_mismatched FROM s GROUP BY 1""")
def src21(t):
    rows = t.lineitem.withColumns({"paper": F.col("l_orderkey"), "path": F.col("l_linenumber")})
    declared = rows.select("paper", "path", F.when(F.col("l_partkey") % 4 > 0, F.sha2("l_returnflag", 256)).alias("sha256"))
    return I.asset_inventory(declared, rows.where("l_suppkey % 3 > 0").select("paper", "path", F.sha2("l_returnflag", 256).alias("sha256")), "paper", "path")


@query("src22_caption_regions", """
WITH c AS (SELECT l_orderkey AS page, l_partkey AS caption_id, CASE WHEN max(l_suppkey) % 2 = 0 THEN 'table' ELSE 'figure' END AS kind, (l_partkey % 900)::DOUBLE AS y FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2),
p AS (SELECT *, coalesce(lag(y) OVER (PARTITION BY page ORDER BY y, caption_id), 0) AS previous FROM c),
b AS (SELECT l_orderkey AS page, (l_suppkey % 300)::DOUBLE AS x0, (l_partkey % 850)::DOUBLE AS y0, (l_suppkey % 300 + l_quantity) AS x1, (l_partkey % 850 + l_quantity * 2) AS y1 FROM lineitem WHERE l_linenumber > 2),
i AS (SELECT p.page, caption_id, x0, y0, x1, y1, CASE WHEN kind = 'table' THEN y0 - y ELSE y - y1 END AS gap FROM p JOIN b USING (page)), k AS (SELECT * FROM i WHERE gap BETWEEN 0 AND 400), l AS (SELECT page, caption_id, min(gap) AS least_ FROM k GROUP BY 1, 2),
u AS (SELECT page, caption_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS boxes FROM k JOIN l USING (page, caption_id) WHERE gap <= least_ + 60 GROUP BY 1, 2)
SELECT page, caption_id, coalesce(boxes, 0) AS boxes, coalesce(x0, 0) AS x0, coalesce(y0, previous) AS y0, coalesce(x1, 1000) AS x1, coalesce(y1, y) AS y1 FROM p LEFT JOIN u USING (page, caption_id)""")
def src22(t):
    """Lines one and two are captions, the others boxes of the page."""
    rows = t.lineitem.withColumn("page", F.col("l_orderkey"))
    captions = rows.where("l_linenumber <= 2").groupBy("page", F.col("l_partkey").alias("caption_id")).agg(F.when(F.max("l_suppkey") % 2 == 0, "table").otherwise("figure").alias("kind")).withColumn("y", (F.col("caption_id") % 900).cast("double"))
    x, y = (F.col("l_suppkey") % 300).cast("double"), (F.col("l_partkey") % 850).cast("double")
    boxes = rows.where("l_linenumber > 2").select("page", x.alias("x0"), y.alias("y0"), (x + F.col("l_quantity")).alias("x1"), (y + F.col("l_quantity") * 2).alias("y1"))
    return I.caption_regions(captions, boxes, ["page"], 400, 60)


@query("num12_focus_box", """
WITH b AS (SELECT l_orderkey AS k, (l_suppkey % 500)::DOUBLE AS x0, (l_suppkey % 500 + l_quantity) AS x1, 1000 - (l_partkey % 950 + l_quantity) AS t, 1000 - (l_partkey % 950)::DOUBLE AS b FROM lineitem)
SELECT k, greatest(min(x0) - 10, 0) AS x0, greatest(min(t) - 10, 0) AS y0, least(max(x1) + 10, 520) AS x1, least(max(b) + 10, 1000) AS y1 FROM b WHERE t >= 300 - 150 AND t <= 300 + 550 GROUP BY k""")
def num12(t):
    x, y = (F.col("l_suppkey") % 500).cast("double"), (F.col("l_partkey") % 950).cast("double")
    boxes = t.lineitem.select(F.col("l_orderkey").alias("k"), x.alias("x0"), y.alias("y0"), (x + F.col("l_quantity")).alias("x1"), (y + F.col("l_quantity")).alias("y1"))
    return I.focus_box(boxes, "k", F.lit(300.0), 1000.0, 520.0)


@query("src23_candidate_pages", r"""
WITH s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
n AS (SELECT *, len(regexp_extract_all(lower(line), 'the')) + len(regexp_extract_all(lower(line), 'ion')) + len(regexp_extract_all(lower(line), 'en')) AS n FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, page DESC) AS k FROM n WHERE n > 0),
w AS (SELECT doc_id, page + d AS page FROM r, (VALUES (-1), (0), (1)) v(d) WHERE k <= 8 UNION SELECT doc_id, 1 FROM documents)
SELECT DISTINCT doc_id, page FROM w WHERE (doc_id, page) IN (SELECT (doc_id, page) FROM s)""")
def src23(t):
    """Lines as pages; the first page of each document is frozen."""
    pages = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line")).select("doc_id", (F.col("k") + 1).cast("long").alias("page"), "line")
    return I.candidate_pages(pages, "doc_id", "page", "line", ["the", "ion", "en"], frozen=t.documents.select("doc_id", F.lit(1).cast("long").alias("page")))


FAMILY = "CASE WHEN regexp_matches(sentence, '[0-9]') THEN 'numeric' WHEN regexp_matches(sentence, '\\?$') THEN 'question' WHEN length(sentence) > 120 THEN 'long' END"


@query("pip07_outcome_inventory", rf"""
WITH {SENTENCES}, f AS (SELECT doc_id, place, {FAMILY} AS family, md5(lower(sentence)) AS signature FROM sentences), k AS (SELECT * FROM f WHERE family IS NOT NULL),
c AS (SELECT doc_id, family, signature, min(place) AS first_place, count(*) AS n FROM k GROUP BY 1, 2, 3)
SELECT doc_id, family, count(*) AS retained, sum(n)::BIGINT - count(*) AS consolidated, min(first_place) AS first_place FROM c GROUP BY 1, 2""")
def pip07(t):
    """Outcome sentences of the whole corpus by family; those of one document and signature are consolidated, the first place kept."""
    family = F.when(F.col("sentence").rlike("[0-9]"), "numeric").when(F.col("sentence").rlike(r"\?$"), "question").when(F.length("sentence") > 120, "long")
    own = sentences(t).select("doc_id", "place", family.alias("family"), F.md5(F.lower("sentence")).alias("signature")).where("family is not null")
    kept = own.groupBy("doc_id", "family", "signature").agg(F.min("place").alias("first_place"), F.count("*").alias("n"))
    return kept.groupBy("doc_id", "family").agg(F.count("*").alias("retained"), (F.sum("n") - F.count("*")).alias("consolidated"), F.min("first_place").alias("first_place"))


@query("pip08_atomic_inventory", """
WITH x AS (SELECT DISTINCT l_orderkey AS paper, l_linenumber % 3 AS experiment FROM lineitem WHERE l_returnflag <> 'N'), c AS (SELECT l_orderkey AS paper, l_linenumber % 3 AS e, l_returnflag || l_linestatus AS sig, l_discount AS score, l_partkey AS id FROM lineitem),
a AS (SELECT c.*, CASE WHEN x.paper IS NULL THEN 'UNASSIGNED' ELSE e::VARCHAR END AS experiment FROM c LEFT JOIN x ON x.paper = c.paper AND x.experiment = c.e),
g AS (SELECT paper, experiment, sig, max(score) AS score, count(*) AS claims, min(id) AS first_claim FROM a GROUP BY 1, 2, 3)
SELECT paper, experiment, sig AS signature, claims, first_claim, row_number() OVER (PARTITION BY paper ORDER BY experiment = 'UNASSIGNED', score DESC, experiment, sig)::INTEGER AS place FROM g QUALIFY place <= 4""")
def pip08(t):
    """Claims are assigned to the paper's experiments, grouped by signature into candidates, and the best four of a paper selected, assigned ones first."""
    from pyspark.sql import Window

    rows = t.lineitem.select(F.col("l_orderkey").alias("paper"), (F.col("l_linenumber") % 3).alias("e"), F.concat("l_returnflag", "l_linestatus").alias("signature"), F.col("l_discount").alias("score"), F.col("l_partkey").alias("id"), "l_returnflag")
    experiments = rows.where("l_returnflag <> 'N'").select("paper", "e", F.lit(True).alias("known")).distinct()
    assigned = rows.join(experiments, ["paper", "e"], "left").withColumn("experiment", F.when(F.col("known"), F.col("e").cast("string")).otherwise("UNASSIGNED"))
    candidates = assigned.groupBy("paper", "experiment", "signature").agg(F.max("score").alias("score"), F.count("*").alias("claims"), F.min("id").alias("first_claim"))
    w = Window.partitionBy("paper").orderBy(F.col("experiment") == "UNASSIGNED", F.desc("score"), "experiment", "signature")
    return candidates.withColumn("place", F.row_number().over(w)).where("place <= 4").drop("score")


@query("pip30_jsn10_paper_view", """
WITH f AS (SELECT l_orderkey AS o, list({'field': l_linenumber::VARCHAR, 'value': l_returnflag, 'evidence': l_partkey} ORDER BY l_linenumber::VARCHAR, l_returnflag, l_partkey) AS fields FROM lineitem GROUP BY 1),
a AS (SELECT o_custkey, list({'arm': o_orderkey, 'status': o_orderstatus, 'fields': coalesce(fields, [])} ORDER BY o_orderkey) AS arms FROM orders LEFT JOIN f ON o = o_orderkey GROUP BY 1)
SELECT c_custkey, coalesce(to_json(arms)::VARCHAR, '[]') AS arms FROM customer LEFT JOIN a ON o_custkey = c_custkey""")
def pip30(t):
    own = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"))
    fields = t.lineitem.join(own.select("c_custkey", "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("c_custkey", "o_orderkey", F.col("l_linenumber").cast("string").alias("field"), F.col("l_returnflag").alias("value"), F.col("l_partkey").alias("evidence"))
    return I.nested_view(t.customer, own, fields, "c_custkey", "o_orderkey")


@query("pip33_text_vision_merge", """
WITH a AS (SELECT l_orderkey AS k, l_linenumber AS f, min(l_returnflag) AS lo, max(l_returnflag) AS hi FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1, 2), b AS (SELECT l_orderkey AS k, l_linenumber AS f, min(l_returnflag) AS lo, max(l_returnflag) AS hi FROM lineitem WHERE l_suppkey % 2 = 1 GROUP BY 1, 2),
m AS (SELECT CASE WHEN least(a.lo, b.lo) <> greatest(a.hi, b.hi) THEN 'conflict' WHEN b.k IS NULL THEN 'text_only' WHEN a.k IS NULL THEN 'vision_only' ELSE 'agreed' END AS disposition FROM a FULL JOIN b ON a.k = b.k AND a.f = b.f)
SELECT d AS disposition, count(m.disposition) AS n FROM (VALUES ('agreed'), ('conflict'), ('text_only'), ('vision_only')) v(d) LEFT JOIN m ON m.disposition = d GROUP BY 1""")
def pip33(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("f"), F.col("l_returnflag").alias("value"), "l_suppkey")
    merged = I.merged_evidence(rows.where("l_suppkey % 2 = 0"), rows.where("l_suppkey % 2 = 1"), ["k", "f"])
    return I.zero_filled(merged, "disposition", ["agreed", "conflict", "text_only", "vision_only"])


@query("pip34_pilot_decisions", """
WITH r AS (SELECT c_nationkey, o_orderkey, o_orderstatus = 'F' AS before, o_orderstatus = 'F' AND o_totalprice > 20000 OR o_totalprice > 250000 AS after FROM orders JOIN customer ON c_custkey = o_custkey),
s AS (SELECT c_nationkey, count(*) FILTER (WHERE after AND NOT before) AS recovered, count(*) FILTER (WHERE before AND NOT after) AS regressed, round(count(*) FILTER (WHERE after) / count(*), 6) AS recall, count(*) AS n FROM r GROUP BY 1)
SELECT *, CASE WHEN recovered = 0 THEN 'fails' WHEN recall >= 0.6 AND regressed <= 20 THEN 'works' ELSE 'inconclusive' END AS decision FROM s""")
def pip34(t):
    price, done = F.col("o_totalprice"), F.col("o_orderstatus") == "F"
    results = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("c_nationkey", done.alias("before"), ((done & (price > 20000)) | (price > 250000)).alias("after"))
    return I.decisions(results, "c_nationkey", 0.6, 20)


@query("pip35_proposal_ledger", """
WITH q AS (SELECT c.conv_id, c.turn, c.text AS quote, d.text AS source, d.doc_id, regexp_extract(c.text, '([0-9]+)', 1) AS num FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id * 7 + c.turn),
p AS (SELECT list_filter([CASE WHEN doc_id IS NULL THEN 'unknown_evidence' END, CASE WHEN turn % 5 = 4 THEN 'wrong_arm' END, CASE WHEN NOT coalesce(contains(lower(source), lower(left(quote, 6))), FALSE) THEN 'quote_not_in_source' END, CASE WHEN num <> '' AND NOT coalesce(contains(source, num), FALSE) THEN 'number_not_in_source' END], lambda x: x IS NOT NULL) AS r FROM q)
SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN len(r) = 0 THEN ['accepted'] ELSE r END) AS reason FROM p) GROUP BY 1""")
def pip35(t):
    """Turns as proposals that cite a document: does it exist, does its text hold the quote and the number?"""
    cited = t.conversations.withColumn("doc_id", F.col("conv_id") * 7 + F.col("turn")).join(t.documents.select("doc_id", F.col("text").alias("source")), "doc_id", "left")
    number = F.regexp_extract("text", "([0-9]+)", 1)
    rules = {
        "unknown_evidence": F.col("source").isNotNull(), "wrong_arm": F.col("turn") % 5 != 4,
        "quote_not_in_source": F.lower("source").contains(F.lower(F.substring("text", 1, 6))), "number_not_in_source": (number == "") | F.col("source").contains(number),
    }
    return I.proposal_ledger(cited, rules)


@query("pip39_visual_promotion", """
WITH g AS (SELECT s_suppkey AS f, s_acctbal > 0 AS open FROM supplier), r AS (SELECT l_suppkey AS f, l_linenumber AS n, bool_and(l_discount < 0.0999) AS passed FROM lineitem GROUP BY 1, 2), p AS (SELECT f, count(*) AS repeats, bool_and(passed) AS ok FROM r GROUP BY 1),
c AS (SELECT DISTINCT l_suppkey AS f, l_partkey * 1000000000 + l_orderkey AS id, l_partkey % 50 AS k, l_returnflag = 'R' AS num, l_linestatus = 'O' AS gen FROM lineitem),
h AS (SELECT c.*, CASE WHEN NOT coalesce(open, FALSE) THEN 'gate_closed' WHEN coalesce(repeats, 0) < 3 THEN 'too_few_repeats' WHEN NOT ok THEN 'a_run_failed' WHEN num AND gen THEN 'numeric_from_generative' END AS why FROM c LEFT JOIN p USING (f) LEFT JOIN g USING (f))
SELECT f AS fixture, id AS claim_id, coalesce(why, CASE WHEN id = min(id) FILTER (WHERE why IS NULL) OVER (PARTITION BY f, k) THEN 'promoted' ELSE 'duplicate_key' END) AS outcome FROM h""")
def pip39(t):
    runs = t.lineitem.groupBy(F.col("l_suppkey").alias("fixture"), "l_linenumber").agg(F.bool_and(F.col("l_discount") < 0.0999).alias("passed"))
    gates = t.supplier.select(F.col("s_suppkey").alias("fixture"), (F.col("s_acctbal") > 0).alias("open"))
    claims = t.lineitem.select(F.col("l_suppkey").alias("fixture"), (F.col("l_partkey") * 1000000000 + F.col("l_orderkey")).alias("claim_id"), (F.col("l_partkey") % 50).alias("claim_key"), (F.col("l_returnflag") == "R").alias("numeric"), (F.col("l_linestatus") == "O").alias("generative")).distinct()
    return I.promoted(claims, runs, gates)


@query("agg22_complete_arms", "SELECT l_suppkey, bool_and(l_returnflag <> 'R') AS complete, count(*) AS n FROM lineitem GROUP BY 1")
def agg22(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.bool_and(F.col("l_returnflag") != "R").alias("complete"), F.count("*").alias("n"))


@query("ext05_term_audit", """
WITH d AS (SELECT DISTINCT o_orderkey AS k, o_orderpriority AS text, o_orderstatus AS value FROM orders), r AS (SELECT o_orderkey AS k, 'high' AS term, TRUE AS required FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'low', FALSE FROM orders),
s AS (SELECT l_orderkey AS k, l_returnflag || l_linestatus AS support FROM lineitem), p AS (SELECT k, count(*) FILTER (WHERE contains(support, value)) AS n FROM d LEFT JOIN s USING (k) GROUP BY 1)
SELECT DISTINCT k, CASE WHEN required THEN 'missing:' ELSE 'forbidden:' END || term AS issue FROM d JOIN r USING (k) WHERE required <> contains(lower(text), term) UNION SELECT k, 'value_not_in_two_supports' FROM p WHERE n < 2""")
def ext05(t):
    decisions = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("text"), F.col("o_orderstatus").alias("value"))
    rules = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit("high").alias("term"), F.lit(True).alias("required")).unionByName(t.orders.select(F.col("o_orderkey").alias("k"), F.lit("low").alias("term"), F.lit(False).alias("required")))
    return I.term_audit(decisions, t.lineitem.select(F.col("l_orderkey").alias("k"), F.concat("l_returnflag", "l_linestatus").alias("support")), rules, "k")


@query("ext20_structural_signatures", """
SELECT l_orderkey, l_linenumber, l_partkey, to_json(list_concat([l_orderkey::VARCHAR, l_returnflag, CASE WHEN l_discount > 0.05 THEN 'negative' ELSE 'positive' END, CASE WHEN l_partkey % 3 > 0 THEN l_linestatus ELSE '' END], CASE WHEN l_partkey % 3 = 0 THEN [l_suppkey::VARCHAR, l_partkey::VARCHAR] ELSE [] END))::VARCHAR AS signature FROM lineitem""")
def ext20(t):
    plain = F.col("l_partkey") % 3 == 0
    parts = [F.col("l_orderkey").cast("string"), F.col("l_returnflag"), F.when(F.col("l_discount") > 0.05, "negative").otherwise("positive"), F.when(~plain, F.col("l_linestatus"))]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", V.structural_signature(parts, F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), plain).alias("signature"))


@query("ext30_ext40_issued_slots", """
WITH d AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders), r AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
SELECT o_custkey, o_orderstatus AS dose, o_orderpriority AS recipient, 'slot-' || left(sha256('=' || o_custkey || '|=' || o_orderstatus || '|=' || o_orderpriority), 16) AS slot_id FROM d JOIN r USING (o_custkey)""")
def ext30(t):
    """Every dose of a paper with every recipient of it: a product within the paper, with ids that stand for what they name."""
    doses, recipients = t.orders.select("o_custkey", F.col("o_orderstatus").alias("dose")).distinct(), t.orders.select("o_custkey", F.col("o_orderpriority").alias("recipient")).distinct()
    return doses.join(recipients, "o_custkey").withColumn("slot_id", V.stable_id("slot-", F.col("o_custkey"), F.col("dose"), F.col("recipient")))


@query("ext34_experiment_summaries", """
WITH f AS (SELECT l_orderkey, l_returnflag || l_linestatus AS endpoint, min(l_linenumber * 1000000 + l_partkey) AS first_ FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey, coalesce(string_agg(endpoint, ',' ORDER BY first_, endpoint), '') AS endpoints, count(endpoint) AS n FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY 1""")
def ext34(t):
    """Experiments with their distinct endpoints in order of first appearance; those without outcomes stay."""
    f = t.lineitem.groupBy("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("endpoint")).agg(F.min(F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("first"))
    lists = f.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("first", "endpoint"))).alias("l"))
    full = t.orders.select("o_orderkey").join(lists, "o_orderkey", "left")
    return full.select("o_orderkey", F.coalesce(F.array_join(F.transform("l", lambda x: x["endpoint"]), ","), F.lit("")).alias("endpoints"), F.greatest(F.size("l"), F.lit(0)).cast("long").alias("n"))


@query("ext53_recalculated_siblings", """
WITH a AS (SELECT o_orderkey, o_custkey * 10 + o_orderpriority[1]::BIGINT AS f, o_totalprice > 300000 AS changed FROM orders) SELECT o_orderkey, changed FROM a WHERE f IN (SELECT f FROM a WHERE changed)""")
def ext53(t):
    """A correction of one arm recalculates all arms of its formulation."""
    a = t.orders.select("o_orderkey", (F.col("o_custkey") * 10 + F.substring("o_orderpriority", 1, 1).cast("long")).alias("f"), (F.col("o_totalprice") > 300000).alias("changed"))
    return a.join(a.where("changed").select("f").distinct(), "f", "left_semi").select("o_orderkey", "changed")


@query("ext07_snk07_appended_reviews", """
WITH i AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem), k AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_suppkey % 4 = 0)
SELECT 'rev-' || left(sha256('=' || l_orderkey || '|=' || l_linenumber || '|=' || l_returnflag), 16) AS review_key, l_orderkey, l_linenumber, l_returnflag FROM i WHERE (l_orderkey, l_linenumber, l_returnflag) NOT IN (SELECT (l_orderkey, l_linenumber, l_returnflag) FROM k)""")
def ext07(t):
    """Review rows are keyed by their content: those stored before, or given twice, are not written again."""
    rows = t.lineitem.select(V.stable_id("rev-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")).alias("review_key"), "l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")
    return V.appended_once(rows.where("l_suppkey % 4 = 0"), rows.drop("l_suppkey"), "review_key")


@query("ext13_contributors", """
WITH r AS (SELECT l_partkey AS path, l_shipdate AS moment, 'line' AS role, l_orderkey AS id FROM lineitem UNION ALL SELECT o_orderkey % 2000, o_orderdate, 'order', o_orderkey FROM orders)
SELECT path, arg_max(role, struct_pack(a := moment, r := role, i := id)) AS role, max(struct_pack(a := moment, r := role, i := id)).i AS id FROM r GROUP BY 1""")
def ext13(t):
    """Artifacts of several sources by path; the last registration wins."""
    order = lambda at, role, i: F.struct(F.col(at).alias("a"), F.lit(role).alias("r"), F.col(i).alias("i"))
    lines = t.lineitem.select(F.col("l_partkey").alias("path"), F.lit("line").alias("role"), F.col("l_orderkey").alias("id"), order("l_shipdate", "line", "l_orderkey").alias("at"))
    orders = t.orders.select((F.col("o_orderkey") % 2000).alias("path"), F.lit("order").alias("role"), F.col("o_orderkey").alias("id"), order("o_orderdate", "order", "o_orderkey").alias("at"))
    return V.last_registered(lines.unionByName(orders), "path", "at").select("path", "role", "id")


@query("ext14_recovered_artifacts", """
WITH c AS (SELECT l_partkey AS k, l_suppkey AS root, bool_and(l_discount < 0.095) AS h, bool_and(l_tax < 0.075) AS p, count(*) >= 2 AS b FROM lineitem GROUP BY 1, 2), r AS (SELECT *, CASE WHEN NOT h THEN 'other_hash' WHEN NOT p THEN 'other_paper' WHEN NOT b THEN 'blocks_missing' END AS why FROM c)
SELECT k, min(root) FILTER (WHERE why IS NULL) AS root, CASE WHEN count(*) FILTER (WHERE why IS NULL) = 0 THEN arg_min(why, root) END AS blocked_by FROM r GROUP BY 1""")
def ext14(t):
    copies = t.lineitem.groupBy(F.col("l_partkey").alias("k"), "l_suppkey").agg(F.bool_and(F.col("l_discount") < 0.095).alias("h"), F.bool_and(F.col("l_tax") < 0.075).alias("p"), (F.count("*") >= 2).alias("b"))
    return V.recovered(copies, "k", "l_suppkey", [("other_hash", F.col("h")), ("other_paper", F.col("p")), ("blocks_missing", F.col("b"))])


@query("pip43_verified_baseline", """
WITH f AS (SELECT doc_id, sha256(text) AS d FROM documents WHERE doc_id % 10 > 0), p AS (SELECT doc_id, sha256(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS d FROM documents WHERE doc_id % 13 > 0)
SELECT coalesce(f.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'missing' WHEN f.doc_id IS NULL THEN 'added' WHEN f.d = p.d THEN 'unchanged' ELSE 'changed' END AS state FROM f FULL JOIN p ON f.doc_id = p.doc_id""")
def pip43(t):
    """A frozen manifest against what is there: a tenth of the documents came later, a thirteenth is gone, a seventh was changed."""
    present = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return V.verified_manifest(t.documents.where("doc_id % 10 > 0").select("doc_id", F.sha2("text", 256).alias("d")), t.documents.where("doc_id % 13 > 0").select("doc_id", F.sha2(present, 256).alias("d")), "doc_id", "d")


@query("pip09_route_envelope", """
WITH c AS (SELECT l_orderkey AS paper, l_partkey AS e, 0 AS r, 'candidate' AS origin FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey, l_partkey, 1, 'table' FROM lineitem WHERE l_linenumber <= 3 UNION ALL SELECT l_orderkey, l_partkey, 2, 'visual' FROM lineitem)
SELECT paper, e AS evidence_id, arg_min(origin, r) AS origin, (paper, e) IN (SELECT (l_orderkey, l_partkey) FROM lineitem WHERE l_linestatus = 'F') AS in_packet FROM c GROUP BY 1, 2""")
def pip09(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("paper"), F.col("l_partkey").alias("evidence_id"), "l_returnflag", "l_linenumber", "l_linestatus")
    return V.route_envelope({"candidate": rows.where("l_returnflag = 'R'"), "table": rows.where("l_linenumber <= 3"), "visual": rows}, rows.where("l_linestatus = 'F'"))


@query("ext32_visual_referrals", """
WITH f AS (SELECT DISTINCT l_orderkey AS paper, l_partkey AS id, l_linenumber AS object, l_tax < 0.06 AS field_level, l_discount > 0.08 AS resolved FROM lineitem WHERE l_returnflag = 'R'), v AS (SELECT l_orderkey AS paper, l_linenumber AS object, count(DISTINCT l_suppkey) AS pages, min(l_suppkey) AS page FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2),
p AS (SELECT paper, object, string_agg(passage::VARCHAR, ',' ORDER BY k) AS passages FROM (SELECT l_orderkey AS paper, l_linenumber AS object, l_partkey AS passage, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity, l_partkey) AS k FROM lineitem) WHERE k <= 3 GROUP BY 1, 2),
o AS (SELECT f.*, page, passages, CASE WHEN NOT field_level THEN 'not_a_field' WHEN resolved THEN 'resolved' WHEN pages IS NULL THEN 'no_visual' WHEN pages > 1 THEN 'several_visuals' ELSE 'referred' END AS outcome FROM f LEFT JOIN v USING (paper, object) LEFT JOIN p USING (paper, object))
SELECT paper, id AS finding_id, outcome, CASE WHEN outcome = 'referred' THEN page END AS page, CASE WHEN outcome = 'referred' THEN coalesce(passages, '') END AS passages FROM o""")
def ext32(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("paper"), F.col("l_linenumber").alias("object"), "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_tax", "l_discount")
    records = rows.where("l_returnflag = 'R'").select("paper", F.col("l_partkey").alias("finding_id"), "object", (F.col("l_tax") < 0.06).alias("field_level"), (F.col("l_discount") > 0.08).alias("resolved")).distinct()
    visuals = rows.where("l_returnflag <> 'R'").select("paper", "object", F.col("l_suppkey").alias("page"))
    return V.visual_referrals(records, visuals, rows.select("paper", "object", F.col("l_quantity").alias("place"), F.col("l_partkey").alias("passage")))


@query("pip40_recall_by_type", """
WITH g AS (SELECT DISTINCT l_orderkey AS o, l_returnflag AS type FROM lineitem WHERE l_linestatus = 'F'), f AS (SELECT DISTINCT l_orderkey AS o, l_returnflag AS type FROM lineitem WHERE l_linestatus = 'O')
SELECT type, count(*) AS total, count(f.o) AS recalled, round(count(f.o) / count(*), 6) AS recall FROM g LEFT JOIN f USING (o, type) GROUP BY 1""")
def pip40(t):
    pairs = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_returnflag").alias("type"), "l_linestatus").distinct()
    found = pairs.where("l_linestatus = 'O'").select("o", "type", F.lit(True).alias("hit"))
    return pairs.where("l_linestatus = 'F'").join(found, ["o", "type"], "left").groupBy("type").agg(F.count("*").alias("total"), F.count("hit").alias("recalled"), F.round(F.count("hit") / F.count("*"), 6).alias("recall"))


@query("ext33_task_scope_audit", """
WITH e AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_discount > 0.04), a AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_discount <= 0.04 GROUP BY 1)
SELECT coalesce(e.k, a.k) AS k, CASE WHEN e.k IS NULL THEN 'unknown' WHEN n IS NULL THEN 'omitted' WHEN n > 1 THEN 'repeated' ELSE 'exact' END AS accounting FROM e FULL JOIN a ON e.k = a.k""")
def ext33(t):
    key = F.col("l_orderkey").alias("k")
    return D.accounted(t.lineitem.where("l_discount > 0.04").select(key), t.lineitem.where("l_discount <= 0.04").select(key), "k")


@query("ext51_rerun_preflight", """
WITH q AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) SELECT k, n, CASE WHEN n > 12 THEN 'over_bound' WHEN c_acctbal >= 0 THEN 'approved' ELSE 'not_approved' END AS state FROM q JOIN customer ON c_custkey = k""")
def ext51(t):
    """The queue of papers with gaps, held to a bound and to approvals."""
    queue = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    approvals = t.customer.select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") >= 0).alias("approved"))
    return queue.join(approvals, "k").select("k", "n", F.when(F.col("n") > 12, "over_bound").when(F.col("approved"), "approved").otherwise("not_approved").alias("state"))


@query("ext45_contract_migration", """
SELECT event_id, to_json({'version': '1.2', 'k': (json_extract_string(props, '$.k'))::BIGINT, 'unit': NULL::VARCHAR, 'kind': event_type})::VARCHAR AS payload FROM events""")
def ext45(t):
    """Payloads of the old form with a version, and with an empty unit and their kind where they lack them; all other fields stay."""
    payload = merged_payload(F.col("props"), {"version": F.lit("1.2")}, {"unit": F.lit(None).cast("string"), "kind": F.col("event_type")})
    return t.events.select("event_id", payload.alias("payload"))
