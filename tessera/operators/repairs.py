"""Repairs that are accepted only if what they touch still holds, correspondences by propagation, and anchors that entries have to cover exactly."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import digest
from tessera.operators.assignment import next_fit
from tessera.operators.evidence import structural_coverage
from tessera.shared import drop, written

#: How good a verdict is; a repair may lower none.
GOOD = {"contradicted": 0, "unconfirmed": 1, "confirmed": 2}


def gated_repairs(candidates: DataFrame, outputs: DataFrame, repairs: DataFrame, coverage: Callable[[DataFrame, DataFrame], DataFrame] = structural_coverage) -> DataFrame:
    """(paper, repair_id, disposition, gained): repairs of outputs, each accepted only if re-evaluation holds.

    ``repairs`` has ``repair_id`` and the columns of ``outputs``: an output of that id is replaced, a new one is added. In a paper,
    repairs come in order of id, one at a time, on top of what was accepted; a repair is accepted if some candidate's verdict gets better and none
    worse. Refused ones are tried again after a pass that accepted any, until a pass accepts none. Papers do not wait for each other: a
    round tries the next repair of each, and only papers with one are evaluated. Repair and output ids are unique in a paper.
    """
    rank = F.create_map(*(F.lit(x) for pair in GOOD.items() for x in pair))
    rated = lambda c, o: coverage(c, o).select("paper", "candidate_id", rank[F.col("verdict")].alias("good"))
    columns = outputs.columns
    own = written(repairs.join(candidates.select("paper").distinct(), "paper", "left_semi"), "repairs")
    papers = own.select("paper").distinct()
    asked = written(candidates.join(papers, "paper", "left_semi"), "repair-candidates")
    held = written(outputs.join(papers, "paper", "left_semi"), "repair-outputs")
    state = written(rated(asked, held), "repair-verdicts")
    # the pass of each paper, and the last id that it has tried in it
    waiting = written(own.select("paper", "repair_id").withColumn("gained", F.lit(0).cast("long")), "repairs-open")
    tried = written(papers.withColumn("last", F.lit(None).cast(own.schema["repair_id"].dataType)).withColumn("won", F.lit(False)), "repairs-tried")
    accepted = None
    while True:
        ahead = waiting.join(tried, "paper").where("last is null or repair_id > last").groupBy("paper").agg(F.min("repair_id").alias("repair_id"))
        step = written(ahead, "repair-step")
        if step.isEmpty():
            again = tried.where("won").join(waiting.select("paper").distinct(), "paper", "left_semi")
            if again.isEmpty():
                break
            fresh = again.select("paper", F.lit(None).cast(own.schema["repair_id"].dataType).alias("last"), F.lit(False).alias("won"))
            tried = written(tried.join(again.select("paper"), "paper", "left_anti").withColumn("won", F.lit(False)).unionByName(fresh), "repairs-tried")
            continue
        now = own.join(step, ["paper", "repair_id"], "left_semi")
        there = held.join(step.select("paper"), "paper", "left_semi")
        laid = there.join(now.select("paper", "output_id"), ["paper", "output_id"], "left_anti").unionByName(now.select(*columns))
        after = rated(asked.join(step.select("paper"), "paper", "left_semi"), laid).withColumnRenamed("good", "after")
        verdicts = written(state.join(after, ["paper", "candidate_id"]), "repair-after")
        moved = verdicts.groupBy("paper").agg(F.count_if(F.col("after") > F.col("good")).alias("gained"), F.count_if(F.col("after") < F.col("good")).alias("lost"))
        good = written(step.join(moved.where("gained > 0 and lost = 0"), "paper").select("paper", "repair_id", "gained"), "repairs-good")
        took = own.join(good, ["paper", "repair_id"], "left_semi")
        if not good.isEmpty():
            accepted = good if accepted is None else accepted.unionByName(good)
            rest = held.join(took.select("paper", "output_id"), ["paper", "output_id"], "left_anti")
            held, last_held = written(rest.unionByName(took.select(*columns)), "repair-outputs"), held
            drop(last_held)
            better = verdicts.join(good.select("paper"), "paper", "left_semi").select("paper", "candidate_id", F.col("after").alias("good"))
            state, last_state = written(state.join(good.select("paper"), "paper", "left_anti").unionByName(better), "repair-verdicts"), state
            drop(last_state)
            waiting = written(waiting.join(good, ["paper", "repair_id"], "left_anti"), "repairs-open")
        passed = step.withColumnRenamed("repair_id", "now").join(good.select("paper", F.lit(True).alias("won_now")), "paper", "left")
        tried = written(tried.join(passed, "paper", "left").select("paper", F.coalesce("now", "last").alias("last"), (F.col("won") | F.coalesce("won_now", F.lit(False))).alias("won")), "repairs-tried")
    told = waiting.select("paper", "repair_id", F.lit("refused").alias("disposition"), "gained")
    return told if accepted is None else told.unionByName(accepted.select("paper", "repair_id", F.lit("accepted").alias("disposition"), "gained"))


def propagated_pairs(possible: DataFrame, group: Sequence[str], left: str, right: str) -> DataFrame:
    """(group, left, right, status, choices) for each left of ``possible`` (group, left, right) pairs, a null right for a left with none.

    A left with one choice takes it, which takes that right from the others, which may leave them with one choice, and so on: ``paired``. Where several
    lefts are left with the same only choice, all of them are ``contested``. What is then left with several choices is ``ambiguous``, with none
    ``impossible``. Repeated rows count once.
    """
    key = [*group, left]
    everyone = written(possible.select(*key).distinct(), "lefts")
    open_ = written(possible.where(F.col(right).isNotNull()).select(*key, right).distinct(), "choices")
    settled = None
    while True:
        single = open_.groupBy(*key).agg(F.count("*").alias("n"), F.min(right).alias(right)).where("n = 1").drop("n")
        claims = F.count("*").over(Window.partitionBy(*group, right))
        step = written(single.withColumn("status", F.when(claims > 1, "contested").otherwise("paired")), "pairs")
        if step.isEmpty():
            break
        settled = step if settled is None else settled.unionByName(step)
        rest = open_.join(step.select(*key), key, "left_anti").join(step.select(*group, right).distinct(), [*group, right], "left_anti")
        open_, last = written(rest, "choices"), open_
        drop(last)
    per = open_.groupBy(*key).agg(F.count("*").alias("choices"))
    if settled is None:
        settled = everyone.limit(0).withColumn(right, F.lit(None).cast(possible.schema[right].dataType)).withColumn("status", F.lit(None).cast("string"))
    whole = everyone.join(settled, key, "left").join(per, key, "left")
    status = F.coalesce("status", F.when(F.col("choices").isNotNull(), "ambiguous").otherwise("impossible"))
    return whole.select(*key, right, status.alias("status"), F.coalesce("choices", F.lit(0)).alias("choices"))


def paired_treatments(sentences: DataFrame, id_col: str, text_col: str, lists: Sequence[Column]) -> DataFrame:
    """(id, place, items, state): treatments of sentences that say ``respectively``, the n-th of each list belonging together.

    ``lists`` are array columns, such as formulations, payloads and doses found in the sentence; those with one item hold for all places. ``explicit``
    where all others are of one length; ``relationship_not_explicit`` (no place) where not, or where nothing has two items. Other sentences give no rows.
    """
    said = sentences.where(F.lower(text_col).contains("respectively")).select(F.col(id_col), F.array(*(F.coalesce(c, F.array().cast("array<string>")) for c in lists)).alias("l"))
    long = F.filter("l", lambda x: F.size(x) != 1)
    n = F.when(F.size(long) > 0, F.size(long[0])).otherwise(0)
    explicit = (n > 1) & F.forall(long, lambda x: F.size(x) == n)
    at = F.when(explicit, F.sequence(F.lit(1), n)).otherwise(F.array(F.lit(None).cast("int")))
    each = said.select(id_col, "l", F.explode(at).alias("place"))
    items = F.when(F.col("place").isNotNull(), F.transform("l", lambda x: F.when(F.size(x) == 1, x[0]).otherwise(F.try_element_at(x, F.col("place")))))
    return each.select(id_col, "place", items.alias("items"), F.when(F.col("place").isNotNull(), "explicit").otherwise("relationship_not_explicit").alias("state"))


def context_tasks(anchors: DataFrame, compatible: Sequence[str], id_col: str, size_col: str, budget: int) -> DataFrame:
    """(paper, compatible, task, task_id, anchors, checksum): a paper's anchors that agree in ``compatible``, in order, in tasks of ``budget``.

    An anchor over the budget is a task of its own (number 0 and below, one each). The checksum covers paper, key and anchors, so a response can be held against what was issued.
    """
    key = ["paper", *compatible]
    dealt = next_fit(anchors, key, id_col, [size_col], [budget])
    alone = F.when(F.col("task") == 0, F.col(id_col).cast("string")).otherwise(F.lit(""))
    per = dealt.groupBy(*key, "task", alone.alias("__alone")).agg(F.array_sort(F.collect_list(F.col(id_col).cast("string"))).alias("anchors"))
    task_id = F.concat_ws("/", *(F.col(c).cast("string") for c in key), F.col("task").cast("string"), F.col("__alone"))
    return per.select(*key, "task", task_id.alias("task_id"), "anchors", digest(*(F.col(c) for c in key), F.array_join("anchors", ",")).alias("checksum"))


def response_states(tasks: DataFrame, responses: DataFrame) -> DataFrame:
    """(task_id, state): valid, or no_response, unknown_task, repeated (several responses) or changed_task (made from other content) for responses (task_id, checksum)."""
    per = responses.groupBy("task_id").agg(F.count("*").alias("n"), F.min("checksum").alias("made"))
    both = tasks.select("task_id", "checksum").join(per, "task_id", "full")
    state = F.when(F.col("checksum").isNull(), "unknown_task").when(F.col("n").isNull(), "no_response").when(F.col("n") > 1, "repeated").when(~F.col("made").eqNullSafe(F.col("checksum")), "changed_task").otherwise("valid")
    return both.select("task_id", state.alias("state"))


def anchor_accounting(anchors: DataFrame, cited: DataFrame) -> DataFrame:
    """(paper, anchor_id, entries, state): whether the entries of a paper cover its anchors exactly.

    ``cited`` has (paper, entry_id, anchor_id). Anchors cited by one entry are ``exact``, by several ``doubled``, by none ``omitted``; what a paper cites without having it is
    ``foreign`` if another paper has it, else ``invented``. An entry that cites an anchor twice counts once; one that cites nothing gives no row.
    """
    per = cited.where(F.col("anchor_id").isNotNull()).groupBy("paper", "anchor_id").agg(F.countDistinct("entry_id").alias("entries"))
    issued = anchors.select("paper", "anchor_id").distinct().withColumn("own", F.lit(True))
    known = anchors.select("anchor_id").distinct().withColumn("known", F.lit(True))
    both = issued.join(per, ["paper", "anchor_id"], "full").join(known, "anchor_id", "left")
    state = F.when(F.col("own").isNull(), F.when(F.col("known"), "foreign").otherwise("invented")).when(F.col("entries").isNull(), "omitted").when(F.col("entries") > 1, "doubled").otherwise("exact")
    return both.select("paper", "anchor_id", F.coalesce("entries", F.lit(0)).alias("entries"), state.alias("state"))
