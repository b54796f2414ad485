"""Groups that depend on order, in rounds, against a replay one by one."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import clusters as C


def replayed(data):
    owner, out = {}, {}
    for i, keys in sorted(data):
        out[i] = min((owner[k] for k in keys if k in owner), default=i)
        owner.update(dict.fromkeys(keys, out[i]))
    return out


def graphs():
    rng = random.Random(11)
    yield [(k, rng.sample(range(60), rng.randrange(0, 4))) for k in range(200)]
    yield [(k * 1000 + rng.randrange(900), [rng.randrange(25), 100 + rng.randrange(25)]) for k in range(300)]  # one giant component
    yield [(k, [k, k + 1]) for k in range(60)]  # a chain
    yield [(k, [-1, k // 2]) for k in range(300)] + [(10**12, [-1])]  # a key of all records, and a far-off id
    yield [(k, [200 - k, 199 - k]) for k in range(0, 100, 2)] + [(k, [k, k + 150]) for k in range(1, 100, 2)]


@pytest.mark.parametrize("number", range(5))
def test_groups_as_replayed(spark, number):
    data = list(graphs())[number]
    records = spark.createDataFrame([(i,) for i, _ in data], "i long")
    keys = spark.createDataFrame([(i, k) for i, own in data for k in own + own[:1]] + [(0, None)], "i long, k long")
    assert {r.i: r.cluster for r in C.incremental_groups(records, "i", keys, "k").collect()} == replayed(data)


def test_no_records(spark):
    none = spark.createDataFrame([], "i long, k string")
    assert C.incremental_groups(none.select("i"), "i", none, "k").collect() == []


def alike(x, y):
    _, tokens, evidence, sources, figure = x
    _, others, theirs, places, shown = y
    if figure and shown and figure.lower() != shown.lower():
        return False
    if set(evidence or ()) & set(theirs or ()):
        return True
    a, b = set(tokens or ()), set(others or ())
    part = len(a & b) / max(1, min(len(a), len(b)))
    return part >= 0.92 or bool(set(sources or ()) & set(places or ())) and part >= 0.72


def one_by_one(data):
    kept, out = {}, {}
    for group, *item in sorted(data, key=lambda x: x[1]):
        first = next((k for k in kept.setdefault(group, []) if alike(item, k)), None)
        out[item[0]] = item[0] if first is None else first[0]
        if first is None:
            kept[group].append(item)
    return out


FORM = "g string, i long, tokens array<string>, evidence array<string>, sources array<string>, figure string"


def items(rng, n, letters, evidence):
    draw = lambda of, most: rng.sample(of, rng.randrange(0, most))
    return [(rng.choice("gh"), k, draw(letters, 7), draw(evidence, 2), draw("stu", 3), rng.choice([None, "Fig 1", "fig 1", "Fig 2"])) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_absorbed_as_one_by_one(spark, seed):
    rng = random.Random(seed)
    data = items(rng, 150, "abcdefghijkl", [f"e{k}" for k in range(12)])
    data += [(g, k + 200, t, e, s, f) for g, k, t, e, s, f in data[:40]]  # copies
    data += [("g", 500, None, None, None, None), ("g", 501, [], [], [], None)]
    out = C.absorbed_in_rounds(spark.createDataFrame(data, FORM), ["g"], "i", "tokens", "evidence", "sources", F.col("figure"))
    assert {r.i: r.kept_as for r in out.collect()} == one_by_one(data)


def test_pairs_are_those_of_brute_force(spark):
    rng = random.Random(5)
    data = items(rng, 120, "abcdefghij", ["e"])
    got = {(r.a, r.b) for r in C.overlapping(spark.createDataFrame(data, FORM), ["g"], "i", "tokens", 0.72).collect()}
    sets = {(g, i): set(t) for g, i, t, *_ in data if t}
    assert got == {(i, j) for (g, i), a in sets.items() for (h, j), b in sets.items() if g == h and i < j and len(a & b) / min(len(a), len(b)) >= 0.72}


def test_sets_are_paired_not_items(spark, monkeypatch):
    """Items of few texts that differ in evidence and group: only different texts are paired, once for all groups (before: every item)."""
    given, pair = [], C.overlapping
    monkeypatch.setattr(C, "overlapping", lambda items, *rest: given.append(items.count()) or pair(items, *rest))
    texts = ["abcd", "abce", "abfg", "xyzw"]
    data = [("ghijk"[k % 5], k, list(texts[k // 5 % 4]), [f"e{k}"], ["s"], [None, "Fig 1", "Fig 2"][k % 3]) for k in range(120)]
    out = C.absorbed_in_rounds(spark.createDataFrame(data, FORM), ["g"], "i", "tokens", "evidence", "sources", F.col("figure"))
    assert {r.i: r.kept_as for r in out.collect()} == one_by_one(data)
    assert given == [4]


def test_long_sets_meet_short_ones(spark):
    long_ = [f"t{k:03d}" for k in range(C.PAIRED_TOKENS + 30)]
    data = [("g", 1, long_, [], [], None), ("g", 2, long_[5:9], [], [], None), ("g", 3, [*long_[:70], *"abcdefgh"], [], [], None), ("g", 4, ["t001"], [], [], None), ("g", 5, ["t001", "z"], [], [], None)]
    got = {(r.a, r.b) for r in C.overlapping(spark.createDataFrame(data, FORM), ["g"], "i", "tokens", 0.72).collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (2, 3), (3, 4), (4, 5)}


def test_rounds_bring_no_table_to_the_driver(spark, tmp_path, monkeypatch):
    rows = [(k, f"{kind}{(k * 7 + n) % 40}") for k in range(300) for n, kind in enumerate("ab")]
    path = str(tmp_path / "keys")
    spark.createDataFrame(rows, "i long, key string").write.parquet(path)
    keys, plans, plain = spark.read.parquet(path), [], C.written

    def seen(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *more)

    monkeypatch.setattr(C, "written", seen)
    out = C.incremental_groups(keys.select("i").distinct(), "i", keys, "key")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
    assert out.count() == 300
