"""Imports, scoring and manifests on hand-made records, and candidate clusters against union-find."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import imports as M
from tessera.operators import sinks
from tessera.operators.evidence import stable_id
from tessera.sources import manifests as S
from tests.test_evidence import plain, table


def test_candidate_clusters_are_numbered_in_order(spark):
    rng = random.Random(3)
    data = [(k * 10, rng.choice("ab"), [f"k{rng.randrange(80)}" for _ in range(rng.randrange(0, 3))]) for k in range(1, 90)]
    root = {i: i for i, _, _ in data}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    by_key = {}
    for i, _, keys in data:
        for k in keys:
            a, b = sorted((top(i), top(by_key.setdefault(k, i))))
            root[b] = a
    groups = {}
    for i, s, _ in data:
        groups.setdefault(top(i), []).append(s)
    expected = [(n, c, len(own), ",".join(sorted(set(own)))) for n, (c, own) in enumerate(sorted(groups.items()), 1)]
    records = spark.createDataFrame([(i, s) for i, s, _ in data], "i long, source string")
    keys = spark.createDataFrame([(i, k) for i, _, own in data for k in own], "i long, key string")
    assert plain(M.numbered_candidates(records, keys, "i"), "number", "cluster", "records", "sources") == sorted(expected, key=repr)
    assert M.dense_numbers(records.limit(0), "i", "n").count() == 0


def test_dense_numbers_place_nulls_and_far_off_values(spark):
    rows = table(spark, "i long, s string", (2, "b"), (None, "n"), (1, "a"), (10**15, "z"), (None, "m"), *((k, "x") for k in range(3, 300)))
    got = {(r.i, r.s): r.n for r in M.dense_numbers(rows, "i", "n").collect()}
    assert sorted(got.values()) == list(range(1, 303))
    assert (got[1, "a"], got[2, "b"], got[299, "x"], got[10**15, "z"]) == (1, 2, 299, 300) and {got[None, "n"], got[None, "m"]} == {301, 302}


def test_ids_tell_fields_apart(spark):
    rows = table(spark, "a string, b string", ("a|=b", "c"), ("a", "b|=c"), ("a\\", "b"), (None, "b"), ("", "b"), ("-", "b"))
    ids = [r[0] for r in rows.select(stable_id("x-", F.col("a"), F.col("b"))).collect()]
    assert len(set(ids)) == 6


def test_corrections_bundles_and_links(spark):
    records = table(spark, "k int, dose string, cell string", (1, "5", None), (2, None, "hsc"))
    corrections = table(spark, "k int, field string, value string, no int", (1, "dose", "6", 1), (1, "dose", "7", 2), (2, "other", "x", 3), (9, "cell", "y", 4))
    assert plain(M.corrected(records, corrections, "k", ["dose", "cell"]), "k", "dose", "cell", "corrected") == [(1, "7", None, "dose"), (2, None, "hsc", "")]
    manifest = table(spark, "k string, position int, excluded boolean", ("a", 1, False), ("b", 2, True), ("c", 3, False), ("d", 4, False))
    bundles = table(spark, "k string, blocked boolean", ("a", False), ("d", True), ("z", False))
    assert plain(M.ordered_bundles(manifest, bundles, "k"), "k", "kind") == [("a", "import"), ("b", "screening_only"), ("c", "missing"), ("d", "blocked"), ("z", "unlisted")]
    links = table(spark, "o int, e int", (1, 1), (1, 1), (1, 2), (2, 1), (3, 1))
    assert plain(M.linked(links, table(spark, "e int", (1,)), table(spark, "o int", (1,), (3,)), "e", "o"), "o", "e", "state") == [(1, 1, "repeated"), (1, 2, "unknown_evidence"), (2, 1, "unknown_owner"), (3, 1, "linked")]


def test_requirements_are_scored(spark):
    requirements = table(spark, "id int, category string, experiment string, field string, values array<string>", (1, "dose", "x", "d", ["5 MG", "5mg"]), (2, "dose", "x", "d", ["9"]), (3, "cell", "y", "c", ["HSC"]))
    facts = table(spark, "experiment string, field string, value string", ("x", "d", "5mg"), ("x", "c", "hsc"))
    assert plain(M.scored_requirements(requirements, facts), "category", "n", "met", "wrong_arm", "recall") == [("cell", 1, 0, 1, 0.0), ("dose", 2, 1, 0, 0.5)]
    rows = table(spark, "k string, p boolean, w boolean", ("a", True, True), ("a", True, False), ("b", False, False))
    assert plain(M.confusion(rows, "k", "p", "w"), "k", "tp", "precision", "recall") == [("a", 1, 0.5, 1.0), ("b", 0, None, None)]


def test_manifests_and_gates(spark, tmp_path):
    good = {"strata": {"hsc": {"synonyms": ["HSC", "stem cell"], "queries": {"q1": ["LNP", "nanoparticle"]}}}}
    assert plain(S.query_manifest(spark, json.dumps(good), ["hsc"]), "query") == [('("HSC" OR "stem cell") AND ("LNP" OR "nanoparticle")',)]
    for bad in ({"strata": {}}, {"strata": {"hsc": {"synonyms": [], "queries": {"q": ["x"]}}}}, {"strata": {"hsc": {"synonyms": ["a"], "queries": {"q": []}}}}):
        with pytest.raises(S.ManifestError):
            S.query_manifest(spark, json.dumps(bad), ["hsc"])
    texts = table(spark, "k int, rank int, xml string", (1, 1, "<article/>"), (1, 2, "<x><article><body/></article></x>"), (2, 1, None), (2, 2, "<a>"))
    states = S.full_text_states(texts, ["k", "rank"], "xml")
    assert plain(states, "k", "rank", "state") == [(1, 1, "no_body"), (1, 2, "valid"), (2, 1, "not_xml"), (2, 2, "not_xml")]
    assert plain(S.first_valid_source(states, "k", "rank"), "k", "rank", "state") == [(1, 2, "valid"), (2, 1, "not_xml")]
    (tmp_path / "lane.jsonl").write_text('{"path": "a", "n": 1}\n{"n": 2}\n')
    with pytest.raises(Exception, match="path is missing"):
        S.typed_lane(spark, str(tmp_path / "lane.jsonl"), "path string, n long", ["path"]).collect()
    assert S.typed_lane(spark, str(tmp_path / "lane.jsonl"), "path string, n long", ["n"]).count() == 2
    strict = {"type": "object", "additionalProperties": False, "required": ["a"], "properties": {"a": {"type": "array", "items": {"type": "string"}}}}
    loose = {"type": "object", "properties": {"a": {"type": ["array", "null"]}, "b": {"anyOf": [{"type": "object", "additionalProperties": False}]}}}
    assert S.strictness_issues(strict) == [] and len(S.strictness_issues(loose)) == 4
    S.new_database(spark, str(tmp_path / "db"), {"paper": "paper_id long, title string"})
    assert spark.read.parquet(str(tmp_path / "db/paper")).columns == ["paper_id", "title"]
    with pytest.raises(Exception, match="already exists"):
        S.new_database(spark, str(tmp_path / "db"), {"paper": "paper_id long"})
    files = table(spark, "path string, sha256 string", ("r/P1/a.json", "1"), ("r/P1/b.json", "1"), ("r/P2/c.txt", "2"), ("r/tmp/P1/d.json", "3"), ("x.json", "4"))
    assert plain(S.scanned_artifacts(files, ["json"], ["/tmp/"], r"/(P\d)/"), "path", "state") == [("r/P1/a.json", "kept"), ("r/P1/b.json", "duplicate"), ("r/P2/c.txt", "other_kind"), ("r/tmp/P1/d.json", "denied"), ("x.json", "no_paper")]


def test_databases_are_rebuilt_copied_and_promoted(spark, tmp_path):
    path, backup, current = (str(tmp_path / x) for x in ("db", "copy", "current"))
    paper = table(spark, "paper_id long, title string", (1, "a"), (2, None))
    broken = table(spark, "check string, key string", ("orphan", "7"))
    with pytest.raises(sinks.Refused, match="orphan: 7"):
        sinks.rebuilt(path, {"paper": paper}, broken)
    made = sinks.rebuilt(path, {"paper": paper, "arm": table(spark, "arm_id long", (5,))})
    with pytest.raises(Exception, match="already exists"):
        sinks.rebuilt(path, {"paper": paper})
    assert sinks.snapshot(spark, path, backup, ["paper", "arm"]) == made
    sinks.promoted(spark, backup, made, current)
    assert spark.read.json(current).first()["path"] == backup
    with pytest.raises(sinks.Refused):
        sinks.promoted(spark, backup, made | {"arm": (1, "other")}, current)
    table(spark, "arm_id long", (6,)).write.mode("overwrite").parquet(f"{path}/arm/data")
    with pytest.raises(sinks.Refused, match="manifest"):
        sinks.snapshot(spark, path, str(tmp_path / "third"), ["arm"])


def test_grouped_arms_read_each_row_once(spark):
    rows = spark.createDataFrame([("a", 1, "x", 0.0), ("a", 2, "x", -0.0), ("b", 3, None, float("nan")), ("b", 4, None, 1.0), ("c", 5, "x", None), ("c", 6, "y", float("nan"))], "k string, i int, f string, v double")
    out = M.grouped_arms(rows, ["k"], "i", ["f", "v"])
    assert {r.k: (r.rows, r.first_id, r.problems) for r in out.collect()} == {"a": (2, 1, ""), "b": (2, 3, "missing:f,conflict:v"), "c": (2, 5, "conflict:f")}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
