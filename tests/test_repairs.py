"""Gated repairs against one at a time, propagation against its rules, respective lists, tasks and anchors."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import evidence as V
from tessera.operators import repairs as R

SHAPE = "paper string, {} string, experiment string, cells array<string>, endpoints array<string>, polarity string, value double, unit string, evidence array<string>"


def candidates(spark, rows):
    return spark.createDataFrame([(*r, True, "high") for r in rows], SHAPE.format("candidate_id") + ", eligible boolean, confidence string")


def outputs(spark, rows):
    return spark.createDataFrame(rows, SHAPE.format("output_id"))


def repairs(spark, rows):
    return spark.createDataFrame(rows, "repair_id int, " + SHAPE.format("output_id"))


def row(paper, i, experiment="x", polarity="positive", value=1.0, evidence=("e1",)):
    return (paper, i, experiment, ["hsc"], ["uptake"], polarity, value, "%", list(evidence))


def told(df):
    return {(r.paper, r.repair_id): r.disposition for r in df.collect()}


def test_a_repair_that_contradicts_another_candidate_is_refused(spark):
    c = candidates(spark, [row("P", "c1"), row("P", "c2", value=9.0, evidence=("e2",)), row("Q", "c1")])
    o = outputs(spark, [row("P", "o2", value=9.0, evidence=("e2",)), row("Q", "o1", experiment=None)])
    r = repairs(spark, [(1, *row("P", "o1", evidence=("e1", "e9"))), (2, *row("P", "o2", value=30.0, evidence=("e2",))), (3, *row("P", "o3", experiment=None)), (1, *row("Q", "o1")), (2, *row("Z", "o1"))])
    assert told(R.gated_repairs(c, o, r)) == {("P", 1): "accepted", ("P", 2): "refused", ("P", 3): "refused", ("Q", 1): "accepted"}


def test_refused_repairs_are_tried_again(spark):
    # the second repair frees the output that the first one would have had to share
    c = candidates(spark, [row("P", "c1"), row("P", "c2", value=2.0)])
    o = outputs(spark, [row("P", "o1", value=5.0)])
    r = repairs(spark, [(1, *row("P", "o2", value=2.0)), (2, *row("P", "o1"))])
    got = told(R.gated_repairs(c, o, r))
    assert got == one_at_a_time(spark, [row("P", "c1"), row("P", "c2", value=2.0)], [row("P", "o1", value=5.0)], [(1, *row("P", "o2", value=2.0)), (2, *row("P", "o1"))])


def one_at_a_time(spark, c, o, r):
    """Each repair by a whole evaluation of its paper."""
    rate = lambda held: {(x.paper, x.candidate_id): R.GOOD[x.verdict] for x in V.structural_coverage(candidates(spark, c), outputs(spark, held)).collect()}
    out, held, open_ = {}, {(x[0], x[1]): x for x in o}, sorted(r, key=lambda x: (x[1], x[0]))
    papers = {x[0] for x in c}
    open_ = [x for x in open_ if x[1] in papers]
    won = True
    while won and open_:
        won = False
        for x in list(open_):
            before, after = rate(list(held.values())), rate(list((held | {(x[1], x[2]): x[1:]}).values()))
            if all(after[k] >= before[k] for k in before) and any(after[k] > before[k] for k in before):
                held[x[1], x[2]] = x[1:]
                open_.remove(x)
                out[x[1], x[0]] = "accepted"
                won = True
    return out | {(x[1], x[0]): "refused" for x in open_}


def test_as_one_at_a_time(spark):
    rng = random.Random(6)
    c = [row("P", f"c{k}", rng.choice("xy"), value=rng.choice([1.0, 5.0]), evidence=[f"e{rng.randrange(3)}"]) for k in range(4)]
    o = [row("P", f"o{k}", rng.choice(["x", "y", None]), value=rng.choice([1.0, 5.0]), evidence=[f"e{rng.randrange(3)}"]) for k in range(3)]
    r = [(k, *row("P", f"o{rng.randrange(5)}", rng.choice("xy"), value=rng.choice([1.0, 5.0]), evidence=[f"e{rng.randrange(3)}"])) for k in range(4)]
    assert told(R.gated_repairs(candidates(spark, c), outputs(spark, o), repairs(spark, r))) == one_at_a_time(spark, c, o, r)


def test_no_repairs(spark):
    assert told(R.gated_repairs(candidates(spark, [row("P", "c")]), outputs(spark, []), repairs(spark, []))) == {}


def propagated(pairs):
    left = {}
    for a, b in pairs:
        left.setdefault(a, set()).update({b} - {None})
    out = {}
    while single := {a: next(iter(b)) for a, b in left.items() if a not in out and len(b) == 1}:
        taken = list(single.values())
        out |= {a: (b, "contested" if taken.count(b) > 1 else "paired") for a, b in single.items()}
        for a in left:
            if a not in out:
                left[a] -= set(taken)
    return out | {a: (None, "ambiguous" if b else "impossible") for a, b in left.items() if a not in out}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_propagation(spark, seed):
    rng = random.Random(seed)
    data = [(g, f"l{k}", f"r{rng.randrange(9)}") for g in "pq" for k in range(8) for _ in range(rng.randrange(1, 4))] + [("p", "l99", None), ("q", "l98", "r100")]
    df = spark.createDataFrame(data + data[:3], "g string, l string, r string")
    got = {(x.g, x.l): (x.r, x.status) for x in R.propagated_pairs(df, ["g"], "l", "r").collect()}
    assert got == {(g, a): v for g in "pq" for a, v in propagated([(a, b) for h, a, b in data if h == g]).items()}
    assert R.propagated_pairs(df.limit(0), ["g"], "l", "r").collect() == []


def test_respective_lists(spark):
    df = spark.createDataFrame(
        [(1, "A and B with X, respectively", ["A", "B"], ["X"], ["1", "2"]), (2, "A, B and C, Respectively", ["A", "B", "C"], ["X", "Y"], ["1"]), (3, "A respectively", ["A"], ["X"], ["1"]), (4, "A and B", ["A", "B"], ["X", "Y"], ["1"]), (5, "none respectively", ["A", "B"], None, ["1"]), (6, None, ["A"], [], [])],
        "i int, s string, f array<string>, p array<string>, d array<string>",
    )
    got = sorted((r.i, r.place, r["items"], r.state) for r in R.paired_treatments(df, "i", "s", [F.col("f"), F.col("p"), F.col("d")]).collect())
    bad = "relationship_not_explicit"
    assert got == [(1, 1, ["A", "X", "1"], "explicit"), (1, 2, ["B", "X", "2"], "explicit"), (2, None, None, bad), (3, None, None, bad), (5, None, None, bad)]


def test_tasks_and_responses(spark):
    anchors = spark.createDataFrame([("P", k, "a" if k < 5 else "b", 40 if k != 3 else 500) for k in range(8)], "paper string, anchor_id long, kind string, tokens int")
    tasks = R.context_tasks(anchors, ["kind"], "anchor_id", "tokens", 100)
    got = {r.task_id: r.anchors for r in tasks.collect()}
    assert got == {"P/a/0/3": ["3"], "P/a/1/": ["0", "1"], "P/a/2/": ["2", "4"], "P/b/1/": ["5", "6"], "P/b/2/": ["7"]}
    sums = {r.task_id: r.checksum for r in tasks.collect()}
    responses = spark.createDataFrame([("P/a/1/", sums["P/a/1/"]), ("P/a/2/", "other"), ("P/b/1/", sums["P/b/1/"]), ("P/b/1/", sums["P/b/1/"]), ("X", "y"), ("P/a/0/3", None)], "task_id string, checksum string")
    assert {r.task_id: r.state for r in R.response_states(tasks, responses).collect()} == {"P/a/0/3": "changed_task", "P/a/1/": "valid", "P/a/2/": "changed_task", "P/b/1/": "repeated", "P/b/2/": "no_response", "X": "unknown_task"}


def test_anchors_invented_omitted_doubled(spark):
    anchors = spark.createDataFrame([("P", "a"), ("P", "b"), ("P", "c"), ("Q", "z")], "paper string, anchor_id string")
    cited = spark.createDataFrame([("P", "e1", "a"), ("P", "e1", "a"), ("P", "e1", "b"), ("P", "e2", "b"), ("P", "e2", "new"), ("P", "e3", "z"), ("P", "e4", None), ("Q", "e1", "z")], "paper string, entry_id string, anchor_id string")
    assert {(r.paper, r.anchor_id): (r.entries, r.state) for r in R.anchor_accounting(anchors, cited).collect()} == {("P", "a"): (1, "exact"), ("P", "b"): (2, "doubled"), ("P", "c"): (0, "omitted"), ("P", "new"): (1, "invented"), ("P", "z"): (1, "foreign"), ("Q", "z"): (1, "exact")}
