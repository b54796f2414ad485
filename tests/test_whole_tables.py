"""Queries over all rows of their tables; components, which have no oracle, against union-find."""

import random
import re

import pytest

from tessera.plans import evidence_queries, import_queries, inventory_queries, matching_queries, more_queries, relational_queries  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES

WHOLE = ["set10_rooted_components", "jon12_jsn09_set_overlap", "jon14_mat06_unique_partner", "agg15_family_groups", "agg25_coverage", "pip39_visual_promotion", "agg22_complete_arms", "jon11_known_candidates", "snk04_ledger_changes"]


@pytest.mark.parametrize("name", WHOLE)
def test_no_query_reads_a_slice(name):
    assert name in QUERIES and "l_quantity" not in ORACLES.get(name, "") and f"{name}_all" not in QUERIES


@pytest.mark.parametrize("name", ["ext16_pip41_ordered_bundles", "ext18_ext44_corrected_records", "ext28_ext17_unified_shapes", "ext51_rerun_preflight", "pip18_accounting", "set01_statuses"])
def test_scans_leave_no_row_out(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    pushed = [x.strip() for found in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) for x in found.split("), ")]
    assert "FileScan parquet" in plan and all(not x or x.startswith("IsNotNull(") for x in pushed)


def test_all_groups_hold_every_row(spark):
    rows = QUERIES["agg15_family_groups"](spark, "/root/testdata/sf0.001").agg({"n": "sum"}).first()[0]
    assert rows == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_components_of_all_rows(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(1, 200), rng.randrange(1, 150), rng.randrange(1, 51)) for _ in range(160)]
    status = {k: rng.choice("FOP") for k in range(1, 200)}
    label: dict[int, int] = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b, _ in edges:
        low, high = sorted((root(a), root(-b)))
        label[high] = low
    anchored = {root(k) for k in list(label) if k > 0 and status[k] == "F"}
    expected = {(x, root(x)) for x in list(label) if root(x) in anchored}
    lineitem = spark.createDataFrame(edges, "l_orderkey long, l_partkey long, l_quantity int")
    orders = spark.createDataFrame(list(status.items()), "o_orderkey long, o_orderstatus string")
    got = matching_queries.set10(type("T", (), {"lineitem": lineitem, "orders": orders}))
    assert {(r.node, r.root) for r in got.collect()} == expected and got.count() == len(expected)


def test_components_keep_nodes_without_a_partner_and_hash_their_minima(spark):
    from tessera.operators import components as C

    lineitem = spark.createDataFrame([(1, 5), (2, 5), (0, 0), (3, None), (4, None), (4, 6), (None, 7), (None, None), (1, 5)], "l_orderkey long, l_partkey long")
    orders = spark.createDataFrame([(1, "F"), (2, "O"), (0, "F"), (3, "F"), (4, "O"), (9, "F")], "o_orderkey long, o_orderstatus string")
    got = matching_queries.rooted_components(lineitem, orders).collect()
    assert sorted((r.node, r.root) for r in got) == [(-5, -5), (0, 0), (1, -5), (2, -5), (3, 3)]
    edges = spark.createDataFrame([(2, 1), (3, 1)], "a long, b long")
    for star in (C._large_star, C._small_star):
        plan = star(edges)._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_rounds_of_components_bound_what_a_task_hashes(spark, monkeypatch):
    """Before: as many partitions as the session has, however many vertices, whose minima can't spill."""
    from tessera.operators import components as C

    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    plain, used = [spark.conf.get(k) for k in keys], []
    write = C.written
    monkeypatch.setattr(C, "HASHED_ROWS", 8, raising=False)
    monkeypatch.setattr(C, "written", lambda df, name: (used.append([spark.conf.get(k) for k in keys]), write(df, name))[1])
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 100)], "a long, b long")
    assert {(r.a, r.b) for r in C.components(edges).collect()} == {(k, 1) for k in range(2, 101)}
    assert used[0] == plain and all(int(parts) * 8 >= 2 * 99 and merged == "false" for parts, merged in used[1:]) and len(used) > 2
    assert [spark.conf.get(k) for k in keys] == plain
