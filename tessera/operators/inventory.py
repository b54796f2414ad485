"""Text annotation, page and figure geometry, inventories of outcomes, proposals, decisions and nested views."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.readiness import reasons


def entities(df: DataFrame, id_col: str, text_col: str, classes: Mapping[str, str]) -> DataFrame:
    """(id, class, start, stop, text): every match of each class's pattern, in code points. Null texts have none; classes may overlap."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(n, re.compile(p)) for n, p in classes.items()]
        for batch in batches:
            of, names, starts, stops, texts = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                for name, pattern in compiled:
                    for m in pattern.finditer(text or ""):
                        of.append(k), names.append(name), starts.append(m.start()), stops.append(m.end()), texts.append(m[0])
            ids = batch.column("id").take(pa.array(of, pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(texts, pa.string())], names=["id", "class", "start", "stop", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    found = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(read, f"id {kind}, class string, start int, stop int, text string")
    return found.withColumnRenamed("id", id_col)


def tags(text: Column, categories: Mapping[str, str]) -> Column:
    """The names of all categories whose pattern occurs, in the order given."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(n)) for n, p in categories.items())))


def endpoint_window(words: Column, direction: Sequence[str], stop: Sequence[str], most: int = 7) -> Column:
    """The words after the first direction word, ``most`` at the most and none from a comparison word on; empty without a direction word."""
    places = F.transform(F.array(*map(F.lit, direction)), lambda d: F.array_position(words, d))
    first = F.array_min(F.filter(places, lambda p: p > 0))
    own = F.slice(words, first + 1, F.lit(most))
    ends = F.array_min(F.filter(F.transform(F.array(*map(F.lit, stop)), lambda d: F.array_position(own, d)), lambda p: p > 0))
    kept = F.when(ends.isNotNull(), F.slice(own, F.lit(1), ends - 1)).otherwise(own)
    return F.when(first.isNull(), F.array().cast("array<string>")).otherwise(kept)


def polar_clauses(df: DataFrame, keys: Sequence[str], text_col: str, marker: str, negative: str) -> DataFrame:
    """(keys, clause, text, polarity): clauses between markers; one that goes on with the subject of a clause of the other polarity gets that subject.

    Of a sentence with claims of both polarities, a clause that starts with its verb ("and did not ...") is rewritten with
    the first word group of the clause before, so that each stands alone.
    """
    cut = F.split(F.regexp_replace(F.col(text_col), marker, "\u0001"), "\u0001")
    each = df.select(*keys, cut.alias("c")).select(*keys, F.posexplode("c").alias("clause", "text"), F.element_at("c", 1).alias("head"))
    polarity = F.when(F.col("text").rlike(negative), "negative").otherwise("positive")
    first = F.when(F.col("head").rlike(negative), "negative").otherwise("positive")
    alone = F.regexp_extract("head", r"^(\S+)", 1)
    rewritten = F.when((F.col("clause") > 0) & (polarity != first) & F.col("text").rlike(r"^[a-z]"), F.concat_ws(" ", alone, "text")).otherwise(F.col("text"))
    return each.select(*keys, "clause", rewritten.alias("text"), polarity.alias("polarity"))


def _ends_with(ending: str):
    return lambda x: F.endswith(x, F.lit(ending))


def preferred_label(labels: Column, endings: Sequence[str]) -> Column:
    """The first label with the first ending that any has, else the first label."""
    out = F.get(labels, 0)
    for e in reversed(endings):
        own = F.filter(labels, _ends_with(e))
        out = F.when(F.size(own) > 0, F.get(own, 0)).otherwise(out)
    return out


def asset_inventory(declared: DataFrame, local: DataFrame, owner: str, path: str) -> DataFrame:
    """Per owner, its declared assets (path, sha256) as lists: local, missing and hash_mismatched, each in order and once."""
    both = declared.select(owner, path, "sha256").distinct().join(local.select(owner, path, F.col("sha256").alias("__have")).distinct(), [owner, path], "left")
    state = F.when(F.col("__have").isNull(), "missing").when(F.col("sha256").isNull() | (F.col("sha256") == F.col("__have")), "local").otherwise("hash_mismatched")
    lists = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("s") == n, F.col(path).cast("string")))), ",").alias(n) for n in ("local", "missing", "hash_mismatched")]
    return both.withColumn("s", state).groupBy(owner).agg(F.count("*").alias("declared"), *lists)


def caption_regions(captions: DataFrame, boxes: DataFrame, page: Sequence[str], band: float, near: float) -> DataFrame:
    """Per caption (page, caption_id, kind, y): the box united from those near its nearest box, or the region since the caption before.

    y grows downwards. Figures stand above their caption, tables below. Boxes (page, x0, y0, x1, y1) within ``band`` of
    the caption count, and of these the ones within ``near`` of the nearest one's edge. Captions and boxes of a page are few.
    """
    w = Window.partitionBy(*page).orderBy("y", "caption_id")
    own = captions.withColumn("previous", F.coalesce(F.lag("y").over(w), F.lit(0.0)))
    gap = F.when(F.col("kind") == "table", F.col("y0") - F.col("y")).otherwise(F.col("y") - F.col("y1"))
    inside = own.join(boxes, list(page)).withColumn("gap", gap).where(F.col("gap").between(0, band))
    least = inside.groupBy(*page, "caption_id").agg(F.min("gap").alias("least"))
    united = inside.join(least, [*page, "caption_id"]).where(F.col("gap") <= F.col("least") + near).groupBy(*page, "caption_id").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("boxes"))
    full = own.join(united, [*page, "caption_id"], "left")
    return full.select(*page, "caption_id", F.coalesce("boxes", F.lit(0)).alias("boxes"), F.coalesce("x0", F.lit(0.0)).alias("x0"), F.coalesce("y0", "previous").alias("y0"), F.coalesce("x1", F.lit(1000.0)).alias("x1"), F.coalesce("y1", "y").alias("y1"))


def focus_box(boxes: DataFrame, key: str, panel: Column, height: float, width: float, before: float = 150, after: float = 550, padding: float = 10) -> DataFrame:
    """Per key, the box around those near the panel (from ``before`` above to ``after`` below it), origin flipped to the top, padded and clamped to the page."""
    top, bottom = F.lit(height) - F.col("y1"), F.lit(height) - F.col("y0")
    near = boxes.withColumns({"__t": top, "__b": bottom}).where((F.col("__t") >= panel - before) & (F.col("__t") <= panel + after))
    return near.groupBy(key).agg(
        F.greatest(F.min("x0") - padding, F.lit(0.0)).alias("x0"), F.greatest(F.min("__t") - padding, F.lit(0.0)).alias("y0"),
        F.least(F.max("x1") + padding, F.lit(width)).alias("x1"), F.least(F.max("__b") + padding, F.lit(height)).alias("y1"),
    )


def candidate_pages(pages: DataFrame, owner: str, page: str, text_col: str, terms: Sequence[str], most: int = 8, frozen: DataFrame | None = None) -> DataFrame:
    """(owner, page): the pages with the highest summed term counts, of equal ones the later, with their neighbours, and the frozen pages."""
    counts = sum((F.regexp_count(F.lower(text_col), F.lit(re.escape(x))) for x in terms), F.lit(0))
    w = Window.partitionBy(owner).orderBy(F.desc("__n"), F.desc(page))
    best = pages.withColumn("__n", counts).where("__n > 0").withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= most)
    near = best.select(owner, F.explode(F.array(F.col(page) - 1, F.col(page), F.col(page) + 1)).alias(page))
    wanted = near if frozen is None else near.unionByName(frozen.select(owner, page))
    return wanted.distinct().join(pages.select(owner, page).distinct(), [owner, page], "left_semi")


def proposal_ledger(proposals: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(reason, n): how many proposals have each fault, those without any as ``accepted``. Rules are the conditions that hold for a good one."""
    each = proposals.select(F.explode(F.when(F.size(reasons(rules)) == 0, F.array(F.lit("accepted"))).otherwise(reasons(rules))).alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n"))


def decisions(results: DataFrame, key: str, least: float, most_regressions: int = 0) -> DataFrame:
    """Per system: recovered, regressed, n, recall and whether it works, is inconclusive or fails.

    ``results`` (key, requirement, before, after) say which requirements were met. Nothing recovered fails; enough recall
    without regressions works.
    """
    s = results.groupBy(key).agg(F.count_if(F.col("after") & ~F.col("before")).alias("recovered"), F.count_if(F.col("before") & ~F.col("after")).alias("regressed"), F.count_if("after").alias("met"), F.count("*").alias("n"))
    recall = F.round(F.col("met") / F.col("n"), 6)
    decision = F.when(F.col("recovered") == 0, "fails").when((recall >= least) & (F.col("regressed") <= most_regressions), "works").otherwise("inconclusive")
    return s.withColumns({"recall": recall, "decision": decision}).drop("met")


def promoted(claims: DataFrame, runs: DataFrame, gates: DataFrame, least_repeats: int = 3) -> DataFrame:
    """Claims (fixture, claim_key, claim_id, numeric, generative) with why they are held back, or ``promoted``; of those with one key only the first.

    A fixture needs its gate and ``least_repeats`` runs, all passed; numeric claims of the generative route never pass.
    """
    per = runs.groupBy("fixture").agg(F.count("*").alias("repeats"), F.bool_and("passed").alias("all_passed"))
    rated = claims.join(per, "fixture", "left").join(gates, "fixture", "left")
    why = F.when(~F.coalesce("open", F.lit(False)), "gate_closed").when(F.coalesce("repeats", F.lit(0)) < least_repeats, "too_few_repeats").when(~F.col("all_passed"), "a_run_failed").when(F.col("numeric") & F.col("generative"), "numeric_from_generative")
    held = rated.withColumn("why", why)
    firsts = held.where("why is null").groupBy("fixture", "claim_key").agg(F.min("claim_id").alias("__first"))
    same = F.when(F.col("claim_id") == F.col("__first"), "promoted").otherwise("duplicate_key")
    return held.join(firsts, ["fixture", "claim_key"], "left").select("fixture", "claim_id", F.coalesce("why", same).alias("outcome"))


def merged_evidence(text: DataFrame, vision: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, value, disposition): what text and vision say of each key: agreed, conflict (no value), text_only or vision_only."""
    side = lambda df, n: df.groupBy(*keys).agg(F.min("value").alias(f"{n}_low"), F.max("value").alias(f"{n}_high"))
    both = side(text, "t").join(side(vision, "v"), list(keys), "full")
    low, high = F.least("t_low", "v_low"), F.greatest("t_high", "v_high")
    kind = F.when(low != high, "conflict").when(F.col("v_low").isNull(), "text_only").when(F.col("t_low").isNull(), "vision_only").otherwise("agreed")
    return both.select(*keys, F.when(low == high, low).alias("value"), kind.alias("disposition"))


def zero_filled(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of fixed values, those that do not occur with zero."""
    fixed = df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` string")
    return fixed.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").na.fill(0, ["n"])


def nested_view(owners: DataFrame, arms: DataFrame, fields: DataFrame, owner: str, arm: str) -> DataFrame:
    """A row per owner with its arms, each with its fields (field, value, evidence), as JSON; all in order of their keys.

    One owner's records fit a row, as they fill one page of a viewer.
    """
    per_arm = fields.groupBy(owner, arm).agg(F.array_sort(F.collect_list(F.struct("field", "value", "evidence"))).alias("fields"))
    full = arms.join(per_arm, [owner, arm], "left").withColumn("fields", F.coalesce("fields", F.array().cast(per_arm.schema["fields"].dataType)))
    per = full.groupBy(owner).agg(F.array_sort(F.collect_list(F.struct(F.col(arm).alias("arm"), F.col("status"), "fields"))).alias("arms"))
    empty = F.array().cast(per.schema["arms"].dataType)
    return owners.select(owner).join(per, owner, "left").select(owner, F.to_json(F.coalesce("arms", empty)).alias("arms"))


def term_audit(decisions_: DataFrame, texts: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, issue): required terms that a decision's text lacks, forbidden ones that it has, and values that fewer than two supports print.

    ``rules`` (key, term, required), ``texts`` (key, support): all supports of a decision; ``decisions_`` (key, text, value).
    """
    has = F.lower("text").contains(F.lower("term"))
    terms = decisions_.join(rules, key).where(F.col("required") != has).select(key, F.concat(F.when(F.col("required"), "missing:").otherwise("forbidden:"), "term").alias("issue"))
    printed = decisions_.where("value is not null").join(texts, key, "left").groupBy(key).agg(F.count_if(F.coalesce(F.col("support").contains(F.col("value")), F.lit(False))).alias("n"))
    return terms.unionByName(printed.where("n < 2").select(key, F.lit("value_not_in_two_supports").alias("issue"))).distinct()
