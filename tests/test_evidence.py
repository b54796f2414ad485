"""Evidence and inventory operators on hand-made records."""

from pyspark.sql import functions as F

from tessera.operators import evidence as V
from tessera.operators import inventory as I


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def plain(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_conflicts_reach_arms_through_every_path(spark):
    identities = table(spark, "paper_id long, entity_type string, natural_key string, entity_id long", (1, "formulation", "f1", 10), (1, "outcome", "o1", 5), (2, "formulation", "f1", 20))
    links = {"formulation": table(spark, "entity_id long, experiment_id long", (10, 100), (10, 101), (20, 200)), "outcome": table(spark, "entity_id long, experiment_id long", (5, 101), (5, None))}
    papers = table(spark, "paper_id long, experiment_id long", (1, 100), (1, 101), (2, 200), (3, 300))
    changes = table(spark, "paper_id long, entity_type string, natural_key string", (1, "formulation", "f1"), (1, "outcome", "o1"), (1, "outcome", "unknown"), (3, "paper", "p3"))
    hit = V.affected_arms(changes, identities, papers, links)
    assert plain(hit, "experiment_id", "entity_type") == [(100, "formulation"), (101, "formulation"), (101, "outcome"), (300, "paper")]
    arms = table(spark, "experiment_id long, status string, eligible boolean", (100, "complete", True), (101, "quarantined", False), (200, "complete", True), (300, "incomplete", False))
    assert plain(V.with_conflicts(arms, hit), "experiment_id", "status", "eligible") == [(100, "conflict", False), (101, "quarantined", False), (200, "complete", True), (300, "conflict", False)]


REVISION = "revision_id long, decision string, supersedes long, entity_type string, experiment_id long, entity_id long, field_name string"


def test_open_gaps_in_three_scopes(spark):
    arms = table(spark, "experiment_id long, formulation_id long", (1, 9), (2, 9), (3, 8))
    missing = table(spark, "experiment_id long, field_name string, resolved_by long", (1, "dose", 5), (1, "unit", None), (2, "dose", 5), (2, "ratio", 5), (3, "outcome:7:value", 5), (3, "outcome:8:value", 5), (3, "dose", 5))
    revisions = table(spark, REVISION, (5, "accepted", None, "arm", 1, None, "dose"), (6, "accepted", None, "formulation", 1, 9, "ratio"), (7, "accepted", None, "outcome", 3, 7, "value"), (8, "rejected", None, "arm", 3, 3, "dose"), (9, "accepted", None, "experiment", 2, 2, "dose"), (10, "rejected", 9, "arm", 2, 2, "x"))
    assert plain(V.unresolved_missing(missing, revisions, arms), "experiment_id", "field_name") == [(1, "unit"), (2, "dose"), (3, "dose"), (3, "outcome:8:value")]


def test_outcome_evidence_by_latest_link_and_review(spark):
    link = "link_id long, outcome_id long, field_name string, evidence_id long, verification_status string, content_json string"
    auto, manual = "automatically_validated", "manually_verified"
    links = table(spark, link, (1, 1, "v", 1, auto, None), (2, 2, "v", 2, auto, None), (3, 3, "v", 1, manual, '{"review_revision_id": 5}'), (4, 4, "v", 1, auto, None), (5, 4, "v", 1, "conflict", None), (6, 5, "v", 1, manual, '{"review_revision_id": 6}'), (7, 6, "v", 3, manual, None))
    evidence = table(spark, "evidence_id long, review_status string", (1, "pending"), (2, "rejected"), (3, manual))
    revisions = table(spark, REVISION, (5, "accepted", None, "arm", 1, 1, "v"), (6, "accepted", None, "arm", 1, 1, "v"), (7, "accepted", 6, "arm", 1, 1, "v"))
    outcomes = table(spark, "outcome_id long, status string", (1, auto), (2, auto), (3, manual), (4, auto), (5, manual), (6, manual), (7, auto))
    assert plain(V.evidenced_outcomes(outcomes, links, evidence, revisions), "outcome_id", "evidenced") == [(1, True), (2, False), (3, True), (4, False), (5, False), (6, True), (7, False)]


def test_structural_coverage(spark):
    shared = "paper string, experiment string, cells array<string>, endpoints array<string>, polarity string, value double, unit string, evidence array<string>"
    base = ("p", "x", ["hsc"], ["uptake"], "positive", 12.4, "percent", ["e1"])
    candidates = table(spark, f"candidate_id string, eligible boolean, confidence string, {shared}", ("match", True, "high", *base[:-1], ["e1"]), ("opposite", True, "high", *base[:4], "negative", None, None, ["e2"]), ("broad", True, "high", "p", "x", ["hsc"], [], "positive", None, None, ["e3"]), ("twin", True, "low", "p", "x", ["hsc"], [], "positive", None, None, ["e3"]), ("cell", True, "low", *base[:-1], ["e4"]), ("alone", False, "high", "q", *base[1:]))
    outputs = table(spark, f"output_id string, {shared}", ("o1", *base[:5], 12.0, "percent", ["e1"]), ("o2", *base[:5], None, None, ["e2"]), ("o3", "p", "x", ["hsc"], ["uptake"], "positive", None, None, ["e3"]), ("o4", "p", "x", [], ["uptake"], "positive", 12.0, "percent", ["e4"]))
    got = {r.candidate_id: (r.verdict, r.reason, r.route) for r in V.structural_coverage(candidates, outputs).collect()}
    assert got["match"] == ("confirmed", "one_match", "none")
    assert got["opposite"] == ("contradicted", "contradiction", "human_review")
    assert got["broad"] == got["twin"] == ("unconfirmed", "one_output_for_several", "bounded_repair")
    assert got["cell"] == ("unconfirmed", "no_confirmed_match", "human_review")
    assert got["alone"] == ("unconfirmed", "no_output", "human_review")


def test_fragments_responses_and_slots(spark):
    findings = table(spark, "finding_id string, record_id string, field string, repairable boolean", ("f", "r", "dose", True), ("g", "r", "cell", False))
    records = table(spark, "record_id string, source_hash string", ("r", "h"))
    fragments = table(spark, "fragment_id int, finding_id string, source_hash string, field string", (1, "f", "old", "dose"), (2, "f", "h", "unit"), (3, "f", "h", "dose"), (4, "f", "h", "dose"), (5, "g", "h", "cell"), (6, "z", "h", "dose"))
    assert [d for _, d in plain(V.merged_fragments(fragments, findings, records), "fragment_id", "disposition")] == ["other_source", "other_field", "applied", "second_result", "not_repairable", "unknown_finding"]
    tasks = table(spark, "t int, candidates array<string>, evidence array<string>, existing array<string>, most_new int", (1, ["a", "b"], ["e"], ["x"], 1), (2, ["a"], ["e"], [], 1), (3, ["a"], [], [], 0))
    responses = table(spark, "t int, recovered array<string>, unresolved array<string>, new_ids array<string>, cited array<string>", (1, ["a"], ["b"], ["y"], ["e"]), (2, ["a"], ["a", "z"], ["n", "n"], ["q"]))
    assert dict(plain(V.response_problems(tasks, responses, "t"), "t", "problems")) == {1: [], 2: ["in_both", "not_all_accounted", "too_many_new", "new_ids_repeat", "unknown_evidence"], 3: ["no_response"]}
    slots = table(spark, "slot_id int, dose string", (1, "a"), (2, "b"), (3, "c"), (4, "d"))
    outcomes = table(spark, "slot_id int, dose string, group int, value double", (1, "a", 0, 5.0), (2, "other", 0, 6.0), (9, "z", 0, None))
    accounting = table(spark, "slot_id int, disposition string", (1, "extracted"), (2, "extracted"), (3, "extracted"), (9, "extracted"))
    allowed = table(spark, "group int, value double", (0, 5.0))
    assert plain(V.slot_accounting(slots, outcomes, accounting, ["dose"], allowed), "slot_id", "problem") == [(2, "identity_changed"), (2, "number_not_printed"), (3, "no_outcome"), (4, "not_accounted"), (9, "invented")]


def test_grids(spark):
    cells = table(spark, "t int, r int, k int, row_span int, column_span int, place int, text string", (1, 0, 0, 1, 1, 0, "Cell"), (1, 0, 1, 1, 2, 1, "Uptake"), (1, 1, 0, 2, 1, 2, "HSC"), (1, 1, 1, 1, 1, 3, "12%"), (1, 2, 1, 1, 2, 4, "9%"), (1, 2, 2, 1, 1, 5, "8%"))
    grid = V.dense_grid(cells, "t")
    assert plain(grid, "r", "k", "text") == [(0, 0, "Cell"), (0, 1, "Uptake"), (0, 2, "Uptake"), (1, 0, "HSC"), (1, 1, "12%"), (1, 2, ""), (2, 0, "HSC"), (2, 1, "9%"), (2, 2, "8%")]
    headers = cells.withColumns({"is_row_header": F.col("k") == 0, "is_column_header": F.col("r") == 0})
    claims = table(spark, "t int, claim string, subject string, endpoint string, value string", (1, "yes", "in hsc cells", "uptake", "12%"), (1, "wrong row", "t cells", "uptake", "12%"), (1, "wrong value", "hsc", "uptake", "13%"), (2, "no table", "hsc", "uptake", "12%"))
    assert plain(V.supported_by_grid(claims, headers, grid, "t", "claim"), "claim") == [("yes",)]


def test_recall_audit_and_registry(spark):
    gold = table(spark, "paper int, gold_id int, location int, tokens array<string>, value_tokens array<string>", (1, 1, 3, ["a", "b"], []), (1, 2, 4, ["a", "b", "c", "d", "9"], ["9"]), (1, 3, 4, ["x", "y"], ["x"]))
    found = table(spark, "paper int, location int, tokens array<string>", (1, 3, ["a", "b", "z"]), (1, 7, ["a", "b", "c", "9"]))
    assert plain(V.recalled_outcomes(gold, found), "gold_id", "recalled") == [(1, True), (2, True), (3, False)]
    experiments = table(spark, "paper int, experiment_id string", (1, "e1"), (1, "e2"), (2, "e1"), (3, "e9"))
    audit = V.projection_audit(experiments, table(spark, "paper int, record_id string", (1, "arm:e1"), (1, "arm:e1:b")), table(spark, "paper int, natural_key string, review_status string, review_no int", (1, "rev:e2", "open", 1), (1, "rev:e2", "closed", 2)), table(spark, "paper int", (2,)))
    assert plain(audit, "paper", "experiment_id", "disposition", "n_arms", "extra_arms") == [(1, "e1", "projected", 2, 1), (1, "e2", "closed", 0, 0), (2, "e1", "screening_only", 0, 0), (3, "e9", "unexplained", 0, 0)]
    rows = table(spark, "i string, o int, candidate string, e int", ("x", 2, "b", 1), ("x", 1, None, 2), ("x", 3, "c", 1), ("y", 1, "b", 5))
    assert plain(V.issued_registry(rows, "i", "o", ["candidate"], "e"), "i", "candidate", "conflicts", "evidence") == [("x", "b", "candidate", "1,2"), ("y", "b", "", "5")]


def test_annotation_and_geometry(spark):
    docs = table(spark, "d int, text string", (1, "Ab Cd é 12"), (2, None))
    assert plain(I.entities(docs, "d", "text", {"name": "[A-Z][a-z] [A-Z][a-z]", "number": "[0-9]+"}), "class", "start", "stop", "text") == [("name", 0, 5, "Ab Cd"), ("number", 8, 10, "12")]
    own = table(spark, "k int, s string", (1, "Uptake rose in HSC, but did not change"), (2, "No effect"))
    assert plain(I.polar_clauses(own, ["k"], "s", ", but ", r"\bnot?\b|No"), "k", "clause", "text", "polarity") == [(1, 0, "Uptake rose in HSC", "positive"), (1, 1, "Uptake did not change", "negative"), (2, 0, "No effect", "negative")]
    words = table(spark, "w array<string>", ("cells increased uptake of lnp compared with pbs".split(),), (["none"],))
    assert plain(words.select(F.array_join(I.endpoint_window(F.col("w"), ["increased"], ["compared"]), " ").alias("x")), "x") == [("",), ("uptake of lnp",)]
    captions = table(spark, "page int, caption_id int, kind string, y double", (1, 1, "figure", 100.0), (1, 2, "table", 300.0), (1, 3, "figure", 900.0))
    boxes = table(spark, "page int, x0 double, y0 double, x1 double, y1 double", (1, 0.0, 20.0, 50.0, 90.0), (1, 60.0, 30.0, 99.0, 85.0), (1, 5.0, 320.0, 80.0, 400.0))
    got = {r.caption_id: (r.boxes, r.x0, r.y0, r.x1, r.y1) for r in I.caption_regions(captions, boxes, ["page"], 200, 20).collect()}
    assert got == {1: (2, 0.0, 20.0, 99.0, 90.0), 2: (1, 5.0, 320.0, 80.0, 400.0), 3: (0, 0.0, 300.0, 1000.0, 900.0)}
    claims = table(spark, "fixture string, claim_key string, claim_id int, numeric boolean, generative boolean", ("f", "k", 1, False, True), ("f", "k", 2, False, True), ("f", "n", 3, True, True), ("g", "k", 4, False, False))
    runs = table(spark, "fixture string, passed boolean", *[("f", True)] * 3, *[("g", True)] * 2)
    gates = table(spark, "fixture string, open boolean", ("f", True), ("g", True))
    assert plain(I.promoted(claims, runs, gates), "claim_id", "outcome") == [(1, "promoted"), (2, "duplicate_key"), (3, "numeric_from_generative"), (4, "too_few_repeats")]
    view = I.nested_view(table(spark, "o int", (1,), (2,)), table(spark, "o int, a int, status string", (1, 7, "s")), table(spark, "o int, a int, field string, value string, evidence string", (1, 7, "dose", "3", "e")), "o", "a")
    assert plain(view, "o", "arms") == [(1, '[{"arm":7,"status":"s","fields":[{"field":"dose","value":"3","evidence":"e"}]}]'), (2, "[]")]


def test_numbers_agree_within_the_last_decimal(spark):
    rows = table(spark, "e double, o double, same boolean", (3.24, 3.2, True), (3.26, 3.2, False), (3.24, 3.0, True), (3.6, 3.0, False), (0.3333, 0.34, True), (0.3, 0.34, False), (12345.67, 12345.7, True), (-3.24, -3.2, True), (1.0, None, None))
    got = rows.select("same", V.number_check(F.col("e"), F.lit("%"), F.col("o"), F.lit("%")).alias("v")).collect()
    assert [r.v for r in got] == [{True: V.MATCH, False: V.CLASH, None: V.OPEN}[r.same] for r in got]


def test_recall_sends_no_tokens_to_the_driver(spark, tmp_path):
    """Joins that carry lists of tokens are not broadcast, however small Spark takes them for (before: both were), and equal rows count each by itself."""
    form = "paper int, gold_id int, location int, tokens array<string>, value_tokens array<string>"
    gold = table(spark, form, (1, 1, 1, ["a", "b", "c", "d"], ["a"]), (1, 1, 1, ["x"], []), (1, 2, 1, ["a", "b", "c", "e"], ["a", "e"]), (2, 1, 9, ["a", "b", "c", "d"], ["a"]))
    found = table(spark, "paper int, location int, tokens array<string>", (1, 2, ["a", "b", "c", "d"]), (1, 2, ["a", "b", "c", "d"]), (2, 9, ["d"]))
    for name, df in {"gold": gold, "found": found}.items():
        df.write.parquet(str(tmp_path / name))  # files have a size that Spark goes by
    out = V.recalled_outcomes(spark.read.parquet(str(tmp_path / "gold")), spark.read.parquet(str(tmp_path / "found")))
    assert plain(out.distinct(), "paper", "gold_id", "recalled") == [(1, 1, True), (1, 2, False), (2, 1, False)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "__" in x] == []


def test_identities_and_links_pass_by_the_changes_unsorted(spark):
    identities = table(spark, "paper_id long, entity_type string, natural_key string, entity_id long", (1, "outcome", "o1", 5), (1, "outcome", "o1", 5))
    changes = table(spark, "paper_id long, entity_type string, natural_key string", (1, "outcome", "o1"), (1, "outcome", "o1"))
    out = V.affected_arms(changes, identities, table(spark, "paper_id long, experiment_id long", (1, 9)), {"outcome": table(spark, "entity_id long, experiment_id long", (5, 8), (5, 8))})
    assert plain(out, "experiment_id", "entity_type") == [(8, "outcome")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 3 and "SortMergeJoin" not in plan


def test_links_without_a_revision_do_not_join_revisions(spark):
    outcomes = table(spark, "outcome_id long, status string", (1, "manually_verified"), (2, "manually_verified"), (3, "automatically_validated"))
    link = "link_id long, outcome_id long, field_name string, evidence_id long, verification_status string, content_json string"
    links = table(spark, link, (1, 1, "f", 7, "manually_verified", '{"review_revision_id": 70}'), (2, 2, "f", 7, "manually_verified", "{}"), (3, 3, "f", 7, "automatically_validated", None))
    evidence = table(spark, "evidence_id long, review_status string", (7, "pending"))
    out = V.evidenced_outcomes(outcomes, links, evidence, table(spark, REVISION, (70, "accepted", None, "arm", 1, 1, "f")))
    assert plain(out, "outcome_id", "evidenced") == [(1, True), (2, False), (3, True)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") == 1 and "Join LeftSemi" in plan


def test_slots_without_an_id_are_invented_and_problems_told_once(spark):
    slots = table(spark, "slot_id long, dose int", (None, 1), (1, 1), (2, 1))
    outcomes = table(spark, "slot_id long, dose int, group long, value double", (None, 1, 1, None), (1, 2, 1, 5.0), (1, 2, 1, 5.0))
    accounting = table(spark, "slot_id long, disposition string", (None, "extracted"), (1, "extracted"), (2, None))
    allowed = table(spark, "group long, value double", (1, 6.0))
    got = plain(V.slot_accounting(slots, outcomes, accounting, ["dose"], allowed), "slot_id", "problem")
    assert got == sorted([(1, "identity_changed"), (1, "number_not_printed"), (1, "repeated"), (None, "invented")], key=repr)


def test_empty_places_are_told_for_blank_claims_only(spark):
    cell = "t int, r int, k int, row_span int, column_span int, place int, text string"
    cells = table(spark, cell, *((t, *x) for t in (1, 2) for x in ((0, 0, 1, 1, 0, "a"), (0, 1, 1, 1, 1, "b"), (1, 0, 1, 1, 2, "c"))))
    claims = table(spark, "t int, claim string, subject string, endpoint string, value string", (1, "full", "a", "b", "b"), (2, "blank", "c", "b", " "), (2, "null", "c", "b", None), (2, "blank", "c", "b", ""))
    asked = V.asked_grid(cells, claims, "t")
    assert plain(asked, "t", "r", "k", "text") == [(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 0, "c"), (2, 0, 0, "a"), (2, 0, 1, "b"), (2, 1, 0, "c"), (2, 1, 1, "")]
    headers = cells.withColumns({"is_row_header": F.col("k") == 0, "is_column_header": F.col("r") == 0})
    found = [plain(V.supported_by_grid(claims, headers, grid, "t", "claim"), "t", "claim") for grid in (asked, V.dense_grid(cells, "t"))]
    assert found == [[(1, "full"), (2, "blank")]] * 2
    assert V.asked_grid(cells, claims.where("t = 1"), "t").count() == 6
