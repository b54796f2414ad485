"""Canonical facts from JSON of any family, by rules on paths.

A document is a VARIANT that is opened level by level into its leaves, each with its JSON pointer; no level is
shuffled. A rule names a family, a pointer pattern in which ``*`` stands for one step, and what a leaf there is: namespace, entity and field, and
where its arm's id and its evidence lie. The first rule that fits projects a leaf; a leaf that no rule covers stays as ``quarantined``,
so the facts of a document are as many as its leaves.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import digest
from tessera.shared import written


@dataclass(frozen=True)
class Rule:
    """What the leaves at a pattern are. In ``entity``, ``arm`` and ``evidence``, ``$1`` is the first step that a ``*`` stands for.

    ``arm`` is an id, or with a leading ``/`` the pointer of the leaf that holds it; ``evidence`` is the pointer of an array of ids.
    """

    family: str
    pattern: str
    namespace: str
    entity: str
    field: str
    arm: str = ""
    evidence: str = ""

    def regex(self) -> str:
        steps = self.pattern.strip("/").split("/")
        return "^/" + "/".join("([^/]+)" if s == "*" else re.escape(s) for s in steps) + "$"

    def named(self, pointer: str) -> str:
        """A pattern of all pointers that ``arm`` or ``evidence`` can stand for."""
        return "^" + "".join("[^/]+" if re.fullmatch(r"\$\d", s) else re.escape(s) for s in re.split(r"(\$\d)", pointer)) + "$"


def leaves(documents: DataFrame, id_col: str, family_col: str, json_col: str) -> DataFrame:
    """(id, family, pointer, holder, value, readable): every scalar, and every empty object or array, of each document.

    ``holder`` is the pointer of what the leaf lies in. A JSON null is a leaf without value. Text that is no JSON is one leaf at the root that is not
    readable and holds the text; a null document has no leaves. Numbers and texts are given as text.
    """
    own = documents.where(F.col(json_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(family_col).alias("family"), F.col(json_col).cast("string").alias("text"), F.try_parse_json(F.col(json_col).cast("string")).alias("v"))
    bad = own.where("v is null").select("id", "family", F.lit("").alias("pointer"), F.lit(None).cast("string").alias("holder"), F.col("text").alias("value"), F.lit(False).alias("readable"))
    found = bad
    level = own.where("v is not null").select("id", "family", F.lit("").alias("pointer"), F.lit(None).cast("string").alias("holder"), "v")
    while True:
        text = F.to_json("v")  # a text begins with a quote
        held = written(level.withColumn("opens", F.left(text, F.lit(1)).isin("{", "[") & (F.length(text) > 2)), "json-level")
        shut = held.where("not opens").select("id", "family", "pointer", "holder", F.when(~F.is_variant_null("v"), F.try_variant_get("v", "$", "string")).alias("value"), F.lit(True).alias("readable"))
        found = found.unionByName(shut)
        open_ = held.where("opens")
        if open_.isEmpty():
            return found
        step = F.coalesce(F.regexp_replace(F.regexp_replace("key", "~", "~0"), "/", "~1"), F.col("pos").cast("string"))
        inside = open_.lateralJoin(open_.sparkSession.tvf.variant_explode(F.col("v").outer()))
        level = inside.select("id", "family", F.concat("pointer", F.lit("/"), step).alias("pointer"), F.col("pointer").alias("holder"), F.col("value").alias("v"))


def projected(documents: DataFrame, id_col: str, family_col: str, json_col: str, rules: Sequence[Rule]) -> DataFrame:
    """``id, family, pointer, namespace, entity, field, value, arm, evidence, disposition, fact_id`` for every leaf.

    ``disposition`` is projected, quarantined (no rule) or unreadable. ``evidence`` is sorted and empty where there is none. ``fact_id`` follows from the
    document, pointer and value, so that a second run gives the same ids.
    """
    first = F.lit(None).cast("int")  # the number of the first rule that fits: each pattern is tried once a leaf
    for k, rule in reversed(list(enumerate(rules))):
        first = F.when((F.col("family") == rule.family) & F.col("pointer").rlike(rule.regex()), k).otherwise(first)

    def by_rule(value) -> Column:
        out = F.lit(None).cast("string")
        for k, rule in reversed(list(enumerate(rules))):
            out = F.when(F.col("__rule") == k, value(rule)).otherwise(out)
        return out

    def filled(name: str):
        plain = lambda text: F.lit(text or None).cast("string")
        return lambda rule: F.regexp_replace("pointer", rule.regex(), getattr(rule, name)) if "$" in getattr(rule, name) else plain(getattr(rule, name))

    def any_named(name: str, pointer: str) -> Column:
        """Whether some rule of the leaf's family can mean this pointer, so that other leaves need not travel."""
        asked = [(F.col("family") == r.family) & F.col(pointer).rlike(r.named(getattr(r, name))) for r in rules if getattr(r, name)]
        return reduce(Column.__or__, asked, F.lit(False))

    told = leaves(documents, id_col, family_col, json_col).withColumn("__rule", first).select(
        "*",
        by_rule(lambda rule: F.lit(rule.namespace)).alias("namespace"),
        by_rule(filled("entity")).alias("entity"),
        by_rule(lambda rule: F.lit(rule.field)).alias("field"),
        by_rule(filled("arm")).alias("__arm"),
        by_rule(filled("evidence")).alias("__evidence"),
    )
    told = written(told.drop("__rule"), "json-leaves")
    arms = told.where(any_named("arm", "pointer")).select("id", F.col("pointer").alias("__arm"), F.col("value").alias("__arm_id"))
    cited = told.where(F.col("value").isNotNull() & any_named("evidence", "holder")).groupBy("id", F.col("holder").alias("__evidence")).agg(F.array_sort(F.collect_set("value")).alias("__ids"))

    def looked_up(rows: DataFrame, asks: Column, found: DataFrame, key: str, what: str) -> DataFrame:
        """Only the rows that ask for something are joined with it."""
        asks = F.coalesce(asks, F.lit(False))
        return rows.where(asks).join(found, ["id", key], "left").unionByName(rows.where(~asks).withColumn(what, F.lit(None).cast(found.schema[what].dataType)))

    with_arms = looked_up(told, F.col("__arm").startswith("/"), arms, "__arm", "__arm_id")
    whole = looked_up(with_arms, F.col("__evidence").isNotNull(), cited, "__evidence", "__ids")
    arm = F.when(F.col("__arm").startswith("/"), F.col("__arm_id")).otherwise(F.col("__arm"))
    state = F.when(~F.col("readable"), "unreadable").when(F.col("field").isNotNull(), "projected").otherwise("quarantined")
    none = F.array().cast("array<string>")
    return whole.select("id", "family", "pointer", "namespace", "entity", "field", "value", arm.alias("arm"), F.coalesce("__ids", none).alias("evidence"), state.alias("disposition"), digest(F.col("id"), F.col("pointer"), F.col("value")).alias("fact_id"))


def merged_payload(payload: Column, fixed: Mapping[str, Column], absent: Mapping[str, Column]) -> Column:
    """A JSON object with the ``fixed`` fields first, all its own other fields as they are, and the ``absent`` ones where it lacks them; null for what is no object."""
    own = F.from_json(payload, "map<string,variant>")
    pairs = lambda given: F.create_map(*(x for k, c in given.items() for x in (F.lit(k), F.parse_json(F.coalesce(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}), F.lit("null"))))))
    inner = lambda m: F.transform_values(m, lambda _, v: F.try_variant_get(v, "$.v", "variant"))
    kept = F.map_filter(own, lambda k, _: ~k.isin(*fixed))
    added = F.map_filter(inner(pairs(absent)), lambda k, _: ~F.array_contains(F.map_keys(own), k))
    return F.to_json(F.map_concat(inner(pairs(fixed)), kept, added))
