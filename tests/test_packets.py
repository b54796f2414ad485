"""Scoped packets and the isolation proof on hand-made records, and against a search in plain Python."""

import random
from collections import deque

from tessera.operators import packets as P


def packets(spark, scopes, evidence, *limits):
    s = spark.createDataFrame(scopes, "paper string, scope string, position int, evidence_id string")
    e = spark.createDataFrame(evidence, "evidence_id string, text string")
    return {(r.paper, r.scope, r.part): r for r in P.scoped_packets(s, e, *limits).collect()}


def test_packets_are_bounded_by_items_and_characters(spark):
    scopes = [("a", "s", k, f"e{k:02}") for k in range(20)] + [("a", "s", 30, "e00"), ("a", "t", None, "e07"), ("a", "t", 1, "e05")]
    evidence = [(f"e{k:02}", "x" * (1 if k != 3 else 40)) for k in range(20)]
    got = packets(spark, scopes, evidence, 15, 45)
    # 15 items have 54 characters: seven (46) and eight, and the seven again as three and four
    assert {k[1:]: len(r.evidence_ids) for k, r in got.items()} == {("s", 0): 3, ("s", 3): 4, ("s", 7): 8, ("s", 15): 5, ("t", 0): 2}
    assert got["a", "t", 0].evidence_ids == ["e07", "e05"] and all(r.chars <= 45 and r.problem is None for r in got.values())
    assert packets(spark, scopes, evidence, 15, 45) == got
    changed = packets(spark, scopes, [(i, t + "y" if i == "e07" else t) for i, t in evidence], 15, 45)
    assert {k[1:] for k in got if got[k].seal != changed[k].seal} == {("s", 7), ("t", 0)}
    assert sorted(x for (_, s, _), r in got.items() if s == "s" for x in r.evidence_ids) == [f"e{k:02}" for k in range(20)]


def test_problems_of_packets(spark):
    scopes = [("a", "s", 1, "e1"), ("a", "u", 1, "none"), ("a", "v", 1, "e2"), ("a", "w", 1, "e3"), ("a", "x", 1, None), ("a", "y", 1, "e4")]
    evidence = [("e1", "one"), ("e1", "one"), ("e2", "one"), ("e2", "two"), ("e3", "far too long a text"), ("e4", None), (None, "no id")]
    got = packets(spark, scopes, evidence, 15, 10)
    assert {k[1]: r.problem for k, r in got.items()} == {"s": None, "u": "absent", "v": "conflict", "w": "too_long", "x": "absent", "y": None}
    assert packets(spark, [], evidence) == {}


def test_issued_ids_follow_from_what_a_fact_says(spark):
    schema = "paper string, experiment string, candidate string, field string, value string, record_id string, fact_id string, entity_id string"
    rows = [("p", None, None, "f", "v", None, None, None), ("p", "e", None, "f", "v", None, None, None), ("p", "e", "c", "f", "v", None, None, None), ("p", "e", "c", "f", None, None, None, None),
            ("p", "e", "c", "f", "v", "R", "F", "E"), ("p", "e|=c", None, "f", "v", None, None, None)]
    got = P.issued_facts(spark.createDataFrame(rows, schema)).collect()
    assert len({r.record_id for r in got}) == 5 and len({r.fact_id for r in got}) == 6
    assert [(r.record_id, r.fact_id, r.entity_id) for r in got if r.fact_id == "F"] == [("R", "F", "E")]
    assert got == P.issued_facts(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(str, P.issued_facts(spark.createDataFrame(got, schema)).collect())) == sorted(map(str, got))


def frames(spark, items, links, gold, public):
    return (spark.createDataFrame(items, "packet string, item string"), spark.createDataFrame(links, "src string, dst string"),
            spark.createDataFrame([(x,) for x in gold], "node string"), spark.createDataFrame([(x,) for x in public], "node string"))


def test_a_leak_through_two_hops_is_found(spark):
    items = [("clean", "f1"), ("clean", None), ("planted", "f1"), ("planted", "f2"), ("direct", "h1"), ("shared", "e1"), (None, "f2")]
    links = [("f1", "e1"), ("f2", "r2"), ("r2", "g1"), ("g1", "e1"), ("g1", "h1"), ("g2", "e1"), ("e1", "paper"), ("f1", None), ("loop", "loop")]
    own, *rest = frames(spark, items, links, ["g1", "g2", None], ["e1", "f1"])
    found = P.leaks(own, *rest)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("planted", "f2", 2, "g1", "r2"), ("direct", "h1", 0, "h1", None), (None, "f2", 2, "g1", "r2")], key=str)
    proof = {r.packet: (r["items"], r.leaked, r.passed) for r in P.isolation_proof(own, found).collect()}
    assert proof == {"clean": (2, 0, True), "planted": (2, 1, False), "direct": (1, 1, False), "shared": (1, 0, True), None: (1, 1, False)}
    # a public record that refers to gold does not make gold public
    own, *rest = frames(spark, [("p", "f1")], [("f1", "g1"), ("g1", "h1")], ["g1"], ["f1"])
    assert [tuple(r) for r in P.leaks(own, *rest).collect()] == [("p", "f1", 1, "g1", "g1")]
    own, *rest = frames(spark, [], [], [], [])
    assert P.leaks(own, *rest).count() == 0 and P.isolation_proof(own, P.leaks(own, *rest)).count() == 0


def reached(starts, links, barred=()):
    seen, queue = dict.fromkeys(starts, 0), deque(starts)
    while queue:
        x = queue.popleft()
        for y in links.get(x, ()):
            if y not in seen and y not in barred:
                seen[y] = seen[x] + 1
                queue.append(y)
    return seen


def test_leaks_equal_a_search_from_every_item(spark):
    rng = random.Random(1)
    names = [f"n{k}" for k in range(120)]
    pairs = {(rng.choice(names), rng.choice(names)) for _ in range(130)} | {(f"c{k}", f"c{k + 1}") for k in range(17)} | {("c17", "n0")}
    gold, public = set(rng.sample(names, 6)) | {"n0"}, set(rng.sample(names, 20))
    links = {}
    for a, b in pairs:
        links.setdefault(a, set()).add(b)
    hidden = set(reached(gold, links)) - set(reached(public - gold, links, gold))
    items = [(f"p{k % 9}", x) for k, x in enumerate([*names, "c0", "c16"])]
    wanted = {}
    for p, x in items:
        near = sorted((n, y) for y, n in reached([x], links).items() if y in hidden)
        if near:
            wanted[p, x] = near[0]
    got = P.leaks(*frames(spark, items, sorted(pairs), gold, public)).collect()
    assert {(r.packet, r.item): (r.hops, r.leak) for r in got} == wanted and len(got) == len(wanted)
    assert wanted["p" + str(120 % 9), "c0"][0] == 18


def test_links_are_stored_once_and_ways_end_at_gold(spark, monkeypatch):
    names = []
    monkeypatch.setattr(P, "written", lambda df, name, real=P.written: names.append(name) or real(df, name))
    links = spark.createDataFrame([("i", "p"), ("i", "p"), ("p", "g"), ("g", "x"), ("p", "y"), ("j", "x"), ("k", "y"), (None, "g"), ("k", None)], "src string, dst string")
    node = lambda *rows: spark.createDataFrame([(x,) for x in rows], "node string")
    items = spark.createDataFrame([(1, "i"), (1, "j"), (2, "k")], "packet long, item string")
    found = {tuple(r) for r in P.leaks(items, links, node("g"), node("p", "g")).collect()}
    assert found == {(1, "i", 2, "g", "p"), (1, "j", 1, "x", "x")}
    assert names.count("links") == 1
