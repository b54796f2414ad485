"""Bundles all or nothing, conflicts that stay and spread, the rebuild chain, and versions of a database."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import bundles as B
from tessera.operators import migrations as M
from tessera.operators.sinks import Refused

FORMS = {
    "paper": "paper_id string, record_id string, title string",
    "formulation": "paper_id string, record_id string, name string",
    "component": "paper_id string, record_id string, formulation_id string, role string",
    "arm": "paper_id string, record_id string, formulation_id string, dose double",
    "outcome": "paper_id string, record_id string, arm_id string, value double",
    "evidence": "paper_id string, record_id string, arm_id string, outcome_id string, cell string",
}


def paper(p, value=1.0, name="lnp", cell="hepatocyte"):
    return {
        "paper": [(p, "p", f"title {p}")],
        "formulation": [(p, "f1", name), (p, "f2", "other")],
        "component": [(p, "c1", "f1", "lipid")],
        "arm": [(p, "a1", "f1", 0.5), (p, "a2", "f2", 1.0)],
        "outcome": [(p, "o1", "a1", value), (p, "o2", "a2", 2.0)],
        "evidence": [(p, "e1", "a1", "o1", cell), (p, "e2", None, "o2", None), (p, "e3", None, None, None)],
    }


def bundle(spark, *papers):
    return {name: spark.createDataFrame([row for x in papers for row in x[name]], form) for name, form in FORMS.items()}


def told(report, *columns):
    return sorted(tuple(r[c] for c in columns) for r in report.collect())


def seen(spark, store):
    return {name: sorted(tuple(r) for r in df.drop("run").collect()) for name, df in B.corpus_tables(spark, store).items()}


LATE = [("negative", "outcome", "value < 0")]


def test_a_late_failure_takes_back_one_paper_only(spark, tmp_path):
    store = str(tmp_path / "store")
    report = B.import_bundles(spark, store, bundle(spark, paper("P1"), paper("P2", value=-1.0), paper("P3")), LATE)
    assert told(report, "paper_id", "state", "inserted", "problems") == [("P1", "committed", 11, 0), ("P2", "refused", 0, 1), ("P3", "committed", 11, 0)]
    first = seen(spark, store)
    assert {row[0] for rows in first.values() for row in rows} == {"P1", "P3"} and len(first["evidence"]) == 6
    again = B.import_bundles(spark, store, bundle(spark, paper("P1"), paper("P2", value=-1.0), paper("P3")), LATE)
    assert told(again, "paper_id", "state", "inserted", "unchanged") == [("P1", "unchanged", 0, 11), ("P2", "refused", 0, 0), ("P3", "unchanged", 0, 11)]
    assert seen(spark, store) == first and B.commits(spark, store).count() == 2
    mended = B.import_bundles(spark, store, bundle(spark, paper("P2")), LATE)
    assert told(mended, "paper_id", "state") == [("P2", "committed")]
    assert len(seen(spark, store)["evidence"]) == 9


def test_a_run_that_dies_before_its_manifest_is_not_seen(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    B.import_bundles(spark, store, bundle(spark, paper("P1")))
    first = seen(spark, store)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(B, "moved", dies)
        with pytest.raises(OSError, match="lost"):
            B.import_bundles(spark, store, bundle(spark, paper("P1", name="new"), paper("P2")))
    assert seen(spark, store) == first
    assert told(B.import_bundles(spark, store, bundle(spark, paper("P2"))), "paper_id", "state") == [("P2", "committed")]


def test_broken_bundles_are_refused(spark, tmp_path):
    store = str(tmp_path / "store")
    orphan, twice, nameless = paper("P1"), paper("P2"), paper("P3")
    orphan["arm"].append(("P1", "a9", "f9", 1.0))
    twice["outcome"].append(("P2", "o1", "a1", 7.0))
    nameless["arm"].append(("P3", None, "f1", 1.0))
    lost = {**{k: [] for k in FORMS}, "formulation": [("P4", "f1", "x")]}
    repeated = paper("P5")
    repeated["outcome"].append(repeated["outcome"][0])
    report = B.import_bundles(spark, store, bundle(spark, orphan, twice, nameless, lost, repeated))
    assert told(report, "paper_id", "state", "inserted") == [("P1", "refused", 0), ("P2", "refused", 0), ("P3", "refused", 0), ("P4", "refused", 0), ("P5", "committed", 11)]


def test_empty_bundles(spark, tmp_path):
    store = str(tmp_path / "store")
    assert B.import_bundles(spark, store, bundle(spark)).collect() == [] and B.commits(spark, store) is None


def test_changed_content_stays_beside_the_old_and_spreads(spark, tmp_path):
    store = str(tmp_path / "store")
    B.import_bundles(spark, store, bundle(spark, paper("P1"), paper("P2")))
    report = B.import_bundles(spark, store, bundle(spark, paper("P1", name="changed")))
    # the formulation and all that hangs on it: component, arm, outcome and evidence
    assert told(report, "state", "inserted", "conflicts", "unchanged") == [("committed", 5, 5, 6)]
    tables = B.corpus_tables(spark, store)
    found = B.conflicts(tables)
    assert told(found, "entity", "record_id", "reason_code", "contents") == [
        ("arm", "a1", "experiment_link_unclear", 2),
        ("component", "c1", "conflicting_formulation", 2),
        ("evidence", "e1", "content_conflict_evidence", 2),
        ("formulation", "f1", "conflicting_formulation", 2),
        ("outcome", "o1", "conflicting_outcome", 2),
    ]
    touched = {(r.paper_id, r.arm_id): r.reasons for r in B.conflicted_arms(tables, found).collect()}
    assert touched == {("P1", "a1"): ["conflicting_formulation", "conflicting_outcome", "content_conflict_evidence", "experiment_link_unclear"]}
    assert told(B.import_bundles(spark, store, bundle(spark, paper("P1", name="changed"))), "state") == [("unchanged",)]


def test_a_paper_conflict_touches_all_its_arms(spark, tmp_path):
    store = str(tmp_path / "store")
    B.import_bundles(spark, store, bundle(spark, paper("P1")))
    other = paper("P1")
    other["paper"] = [("P1", "p", "another title")]
    B.import_bundles(spark, store, bundle(spark, other))
    tables = B.corpus_tables(spark, store)
    assert {(r.arm_id, *r.reasons) for r in B.conflicted_arms(tables, B.conflicts(tables)).collect()} == {("a1", "content_conflict_paper"), ("a2", "content_conflict_paper")}


def test_rebuild_chain(spark, tmp_path):
    store = str(tmp_path / "store")
    first, second = paper("P1"), paper("P2", cell="kupffer")
    first["arm"].append(("P1", "a3", "f1", 0.5))
    first["evidence"] += [("P1", "e9", "a2", None, "lsec"), ("P1", "e8", "a2", None, "hsc")]
    changed = paper("P2", value=9.0, cell="kupffer")
    repairs = spark.createDataFrame([("P1", "a1", 0.5, 0.75), ("P1", "a2", 7.0, 8.0), ("P2", "a1", 0.5, 1.0), ("P2", "a1", 0.5, 2.0)], "paper_id string, record_id string, expected double, value double")
    out = B.rebuilt_corpus(spark, store, [bundle(spark, first, second), bundle(spark, changed)], ["formulation_id", "dose"], "cell", repairs, "dose", LATE)
    assert told(out.fillna("-"), "paper_id", "arm_id", "kept_as", "scope", "value", "repair", "outcomes", "status") == [
        ("P1", "a1", "a1", "hepatocyte", 0.75, "applied", 1, "complete"),
        ("P1", "a2", "a2", "unresolved", 1.0, "stale", 1, "incomplete"),
        ("P1", "a3", "a1", "-", 0.5, "none", 0, "incomplete"),
        ("P2", "a1", "a1", "kupffer", 0.5, "ambiguous", 1, "conflict"),
        ("P2", "a2", "a2", "-", 1.0, "none", 1, "incomplete"),
    ]
    with pytest.raises(FileExistsError):
        B.rebuilt_corpus(spark, store, [], [], "cell", repairs, "dose")


LINKS = [("arm", "paper", "paper", "id")]


def steps(spoil=False):
    def notes(t):
        return {"arm": t["arm"].withColumn("note", F.lit(None).cast("string"))}

    def split(t):
        made = t["arm"].where("id < 2") if spoil else t["arm"]
        return {"arm": made.drop("dose"), "dose": t["arm"].select("id", "dose"), "old": None}

    return [M.Migration(1, "arm notes", notes, ("arm",)), M.Migration(2, "doses apart", split, ("arm",), {"dose": ("id",)})]


@pytest.fixture
def database(spark, tmp_path):
    db = str(tmp_path / "db")
    tables = {"paper": spark.createDataFrame([(1, "x"), (2, None)], "id long, title string"), "arm": spark.createDataFrame([(1, 1, 0.5), (2, 2, 1.5)], "id long, paper long, dose double"), "old": spark.createDataFrame([(1,)], "id long")}
    M.create(spark, db, tables)
    return db


@pytest.mark.parametrize("start", [0, 1])
def test_migrated_from_each_old_version(spark, database, tmp_path, start):
    M.migrate(spark, database, steps()[:start], None, LINKS)
    assert M.current(spark, database).version == start
    before = M.current(spark, database)
    report = M.migrate(spark, database, steps(), str(tmp_path / "copy"), LINKS)
    assert [r for r in report if r[0] == 2] == [(2, "doses apart", "arm", 2, 2), (2, "doses apart", "dose", 0, 2), (2, "doses apart", "old", 1, 0)]
    now, tables = M.current(spark, database), M.read(spark, database)
    assert now.version == 2 and sorted(tables) == ["arm", "dose", "paper"] and tables["arm"].columns == ["id", "paper", "note"]
    assert now.tables["paper"] == before.tables["paper"]  # untouched tables are not copied
    assert M.migrate(spark, database, steps(), str(tmp_path / "unused"), LINKS) == []
    assert M.restore(spark, database, str(tmp_path / "copy")).version == start
    assert sorted(M.read(spark, database)) == ["arm", "old", "paper"]


def test_a_failure_halfway_changes_nothing(spark, database, tmp_path):
    before = M.current(spark, database)
    with pytest.raises(Refused, match="had 2 rows and has 1"):
        M.migrate(spark, database, steps(spoil=True), str(tmp_path / "copy"))
    assert M.current(spark, database) == before and sorted(M.read(spark, database)) == ["arm", "old", "paper"]
    assert M.current(spark, str(tmp_path / "copy")).version == 0


def test_preflight_refuses(spark, database, tmp_path):
    M.migrate(spark, database, steps())
    with pytest.raises(Refused, match="newer"):
        M.preflight(spark, database, steps()[:1])
    with pytest.raises(Refused, match="unknown"):
        M.preflight(spark, database, [steps()[0], M.Migration(3, "later", dict)])
    with pytest.raises(Refused, match="order"):
        M.preflight(spark, database, steps()[::-1])
    with pytest.raises(Refused, match=r"arm.paper 2 is not in old"):
        M.migrate(spark, database, [*steps(), M.Migration(3, "papers", lambda t: {"old": t["paper"].where("id = 1")})], None, [("arm", "paper", "old", "id")])
    path = M.current(spark, database).tables["dose"][0]
    spark.createDataFrame([(7, 1.0)], "id long, dose double").write.mode("overwrite").parquet(f"{path}/data")
    with pytest.raises(Refused, match="dose is not what its manifest says"):
        M.preflight(spark, database, steps())
    with pytest.raises(FileExistsError):
        M.create(spark, database, {})


def test_two_writers_do_not_both_win(spark, database):
    now = M.current(spark, database)
    M.point(spark, database, now.number + 1, 0, now.tables)
    with pytest.raises(FileExistsError):
        M.point(spark, database, now.number + 1, 0, now.tables)
    assert json.dumps(M.current(spark, database).tables) == json.dumps(now.tables)


def test_stored_records_are_small(spark, tmp_path):
    """The store holds no ids and 32 bytes of content a record (before: two digests of 64 letters); readers see both as they were."""
    store = str(tmp_path / "store")
    B.import_bundles(spark, store, bundle(spark, paper("P1")))
    kept = {name: dict(spark.read.parquet(f"{store}/{name}").dtypes) for name in FORMS}
    assert all("id" not in types and types["content"] == "binary" for types in kept.values())
    arm = B.corpus_tables(spark, store)["arm"].where("record_id = 'a1'").first()
    assert len(arm.content) == 64 and len(arm.id) == 64


def test_imports_and_rebuilds_take_some_papers_at_a_time(spark, tmp_path, monkeypatch):
    """Before: all papers' tables and shuffles lay on the disk at once."""
    plain = {k: spark.conf.get(k, None) for k in (*B.DEALT, "spark.sql.shuffle.partitions")}
    monkeypatch.setattr(B, "SLICE_ROWS", 13)
    sizes, write = [], B.written  # rows of evidence that a step holds

    def noted(df, name, *a):
        out = write(df, name, *a)
        if name == "bundle-evidence":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(B, "written", noted)
    store, given = str(tmp_path / "store"), bundle(spark, paper("P1"), paper("P3", value=-1.0))
    repairs = spark.createDataFrame([("P1", "a1", 0.5, 0.75)], "paper_id string, record_id string, expected double, value double")
    out = B.rebuilt_corpus(spark, store, [given], ["formulation_id", "dose"], "cell", repairs, "dose")
    assert told(out.fillna("-"), "paper_id", "arm_id", "scope", "value", "status") == [
        ("P1", "a1", "hepatocyte", 0.75, "complete"), ("P1", "a2", "-", 1.0, "incomplete"), ("P3", "a1", "hepatocyte", 0.5, "complete"), ("P3", "a2", "-", 1.0, "incomplete"),
    ]
    assert told(B.import_bundles(spark, store, given, LATE), *"paper_id state inserted unchanged problems".split()) == [("P1", "unchanged", 0, 11, 0), ("P3", "refused", 0, 0, 1)]
    assert sorted(sizes) == [3, 3, 3, 3] and B.commits(spark, store).select("run").distinct().count() == 1
    assert {k: spark.conf.get(k, None) for k in plain} == plain


def test_rows_of_a_bundle_are_dealt_out_once_each(spark, tmp_path):
    """Links, doubles and known records are told among a paper's rows where these are; before, each of them dealt rows with their digests out again."""
    store = str(tmp_path / "store")
    B.import_bundles(spark, store, bundle(spark, paper("P1")))
    made = {}
    with B.settings(spark, B.DEALT | {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for entity in B.ENTITIES:
            made[entity.name] = B.decided(B.identified(bundle(spark, paper("P1"))[entity.name], entity, made), B.committed(spark, store, entity.name, F.lit(True)))
            made[entity.name] = B.written(made[entity.name], "made") if entity.name != "evidence" else made[entity.name]
        plan = made["evidence"]._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange " in line]
    assert len(dealt) == 5 and all("hashpartitioning(paper_id" in line and "record_id" not in line for line in dealt)  # evidence, two parents, the store and its manifest


def test_repeated_rows_of_known_records(spark, tmp_path):
    store = str(tmp_path / "store")
    B.import_bundles(spark, store, bundle(spark, paper("P1")))
    again = paper("P1")
    again["outcome"] += [again["outcome"][0]] * 2
    again["component"] = [("P1", "c1", "f1", "other")] * 3
    report = B.import_bundles(spark, store, bundle(spark, again))
    assert told(report, "state", "inserted", "conflicts", "unchanged", "problems") == [("committed", 1, 1, 10, 0)]
    again["component"].append(("P1", "c1", "f1", "lipid"))
    assert told(B.import_bundles(spark, store, bundle(spark, again)), "state", "problems") == [("refused", 1)]
