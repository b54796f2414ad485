"""Facts by path rules: every leaf once, nested and odd JSON, evidence and arms found by pointer, payloads merged without loss."""

import json

from pyspark.sql import functions as F

from tessera.operators import facts as A

RULES = [
    A.Rule("graph", "/arms/*/dose/value", "arm", "arm", "dose", "/arms/$1/id", "/arms/$1/dose/evidence_ids"),
    A.Rule("graph", "/arms/*/*", "arm", "arm", "other", "/arms/$1/id"),
    A.Rule("slices", "/by/*/s", "arm", "arm:$1", "status", "$1"),
    A.Rule("results", "/*/v", "result", "row $1", "value"),
]
DOCS = [
    (1, "graph", '{"arms":[{"id":"a1","dose":{"value":2.5,"evidence_ids":["e2","e1","e2"]}},{"id":"a2","dose":null,"n":[]}],"w~/x":true,"e":{}}'),
    (2, "slices", '{"by":{"q":{"s":"one/two","t":1},"r.s":{"s":false}}}'),
    (3, "results", '[{"v":1},{"v":"1"},[[["deep"]]]]'),
    (4, "graph", "no json"),
    (5, "graph", None),
    (6, "none", "7"),
    (7, "graph", "[]"),
    (8, "graph", '""'),
]


def leaf_count(x):
    inner = x.values() if isinstance(x, dict) else x if isinstance(x, list) else ()
    return sum(map(leaf_count, inner)) if inner else 1


def documents(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc long, kind string, body string")


def test_facts_are_the_leaves(spark):
    out = A.projected(documents(spark), "doc", "kind", "body", RULES).collect()
    for doc, _, body in DOCS:
        try:
            want = 0 if body is None else leaf_count(json.loads(body))
        except ValueError:
            want = 1
        assert sum(r.id == doc for r in out) == want, doc
    got = {(r.id, r.pointer): (r.namespace, r.entity, r.field, r.value, r.arm, r.evidence, r.disposition) for r in out}
    assert got[1, "/arms/0/dose/value"] == ("arm", "arm", "dose", "2.5", "a1", ["e1", "e2"], "projected")
    assert got[1, "/arms/0/id"] == ("arm", "arm", "other", "a1", "a1", [], "projected")
    assert got[1, "/arms/1/dose"] == ("arm", "arm", "other", None, "a2", [], "projected")
    assert got[1, "/arms/1/n"][3] == "[]" and got[1, "/w~0~1x"][3:] == ("true", None, [], "quarantined")
    assert got[2, "/by/q/s"] == ("arm", "arm:q", "status", "one/two", "q", [], "projected") and got[2, "/by/q/t"][-1] == "quarantined"
    assert got[3, "/1/v"] == ("result", "row 1", "value", "1", None, [], "projected") and got[3, "/2/0/0/0"][3] == "deep"
    assert got[4, ""] == (None, None, None, "no json", None, [], "unreadable")
    assert got[8, ""][3] == "" and got[7, ""][3] == "[]"


def test_another_run_gives_the_same_ids(spark):
    one, two = ({r.fact_id for r in A.projected(documents(spark, rows), "doc", "kind", "body", RULES).collect()} for rows in (DOCS, DOCS[::-1]))
    assert one == two and len(one) == 20


def test_no_documents(spark):
    assert A.projected(documents(spark, []), "doc", "kind", "body", RULES).collect() == []


def test_merged_payload_loses_nothing(spark):
    df = documents(spark, [(1, "x", '{"k":69,"z":[1,{"a":null}],"unit":"mg","version":0}'), (2, "y", "{}"), (3, None, "no"), (4, "z", None)])
    out = df.select("doc", A.merged_payload(F.col("body"), {"version": F.lit("1.2"), "n": F.lit(3)}, {"unit": F.lit(None).cast("string"), "kind": F.col("kind")}).alias("p"))
    got = {r.doc: r.p and json.loads(r.p) for r in out.collect()}
    assert got == {1: {"version": "1.2", "n": 3, "k": 69, "z": [1, {"a": None}], "unit": "mg", "kind": "x"}, 2: {"version": "1.2", "n": 3, "unit": None, "kind": "y"}, 3: None, 4: None}


def test_only_leaves_that_a_rule_can_mean_are_looked_up(spark):
    rules = [A.Rule("f", "/a.b/*/v", "n", "e", "v", "/a.b/$1/id", "/a.b/$1/ids/$1"), A.Rule("f", "/a.b/*/w", "n", "e", "w", "/top")]
    body = '{"top":"T","aXb":{"q":{"id":"no"}},"a.b":{"q":{"v":1,"w":{},"id":"yes","ids":{"q":["2","1","2"]}}}}'
    out = A.projected(documents(spark, [(1, "f", body), (2, "g", body)]), "doc", "kind", "body", rules)
    got = {(r.id, r.pointer): (r.arm, r.evidence) for r in out.collect()}
    assert got[1, "/a.b/q/v"] == ("yes", ["1", "2"]) and got[1, "/a.b/q/w"] == ("T", []) and got[2, "/a.b/q/v"] == (None, [])
    assert len(got) == 16 == out.count()
    assert r"^/a\.b/[^/]+/id$" in out._jdf.queryExecution().optimizedPlan().toString()
