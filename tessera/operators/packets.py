"""Scoped packets of evidence with issued ids and a seal, and the proof that nothing in them comes from gold alone.

Lineage is a table of links (src, dst): the record ``src`` refers to ``dst``. What a set of records
reaches is found in rounds, each a join of the round's new records with the links; a round's
rows are written to the shared folder, and there are as many rounds as the longest of the shortest ways has links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import digest
from tessera.operators.assignment import chunked
from tessera.operators.evidence import stable_id
from tessera.shared import drop, written

MOST_ITEMS, MOST_CHARS = 15, 45_000
MERGE_ROUNDS = 16  # rounds whose rows are kept as tables of their own


def issued_facts(facts: DataFrame) -> DataFrame:
    """``facts`` (paper, experiment, candidate, field, value, record_id, fact_id, entity_id) with ids issued where they have none.

    Ids follow from what a fact says, so a rerun issues the same ones. Facts without an experiment belong to their paper's shared record.
    """
    record = F.when(F.col("experiment").isNull(), stable_id("REC-", F.col("paper"), F.lit("shared"))).otherwise(stable_id("REC-", F.col("paper"), F.col("experiment"), F.col("candidate")))
    known = facts.withColumn("record_id", F.coalesce("record_id", record))
    own = [F.col("paper"), F.col("record_id"), F.col("field"), F.col("value")]
    return known.withColumns({"fact_id": F.coalesce("fact_id", stable_id("FACT-", *own)), "entity_id": F.coalesce("entity_id", stable_id("ENT-", *own))})


def _halved(parts: Column, chars: int) -> Column:
    """Each of the arrays of items whose characters are over ``chars`` as two, the first having half of its items, rounded down."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda n, i: n + i["chars"])
    half = lambda x: F.floor(F.size(x) / 2).cast("int")
    cut = lambda x: F.array(F.slice(x, F.lit(1), half(x)), F.slice(x, half(x) + 1, F.size(x) - half(x)))
    return F.flatten(F.transform(parts, lambda x: F.when((total(x) > chars) & (F.size(x) > 1), cut(x)).otherwise(F.array(x))))


def scoped_packets(scopes: DataFrame, evidence: DataFrame, most: int = MOST_ITEMS, chars: int = MOST_CHARS) -> DataFrame:
    """``paper, scope, part, evidence_ids, chars, seal, problem``: the evidence of each scope in packets of at most ``most`` items and ``chars`` characters.

    ``scopes`` (paper, scope, position, evidence_id) names what a scope needs, an id counts at its first position, nulls first; ``evidence`` (evidence_id,
    text) is the inventory. Chunks of ``most`` items are halved until they fit. ``part`` is the number of the packet's first item in its
    scope, the seal a digest of ids and texts in order. ``problem`` is null or the first fault of a packet's items: ``absent`` from the inventory (null ids too),
    ``conflict`` (inventory rows of one id differ in their text), ``too_long`` (one item over ``chars``). A null text is empty.
    """
    text = F.coalesce("text", F.lit(""))
    known = evidence.groupBy("evidence_id").agg(F.min(text).alias("text"), (F.min(text) != F.max(text)).alias("conflict"))
    firsts = scopes.groupBy("paper", "scope", "evidence_id").agg(F.min(F.struct(F.col("position").isNotNull().alias("given"), "position")).alias("at"))
    named = firsts.join(known.select("evidence_id", F.sha2("text", 256).alias("hash"), F.length("text").cast("long").alias("chars"), "conflict"), "evidence_id", "left")
    fault = F.when(F.col("hash").isNull(), "absent").when(F.col("conflict"), "conflict").when(F.col("chars") > chars, "too_long")
    rows = chunked(named.withColumns({"fault": fault, "chars": F.coalesce("chars", F.lit(0))}), ["paper", "scope"], ["at", "evidence_id"], most)
    item = F.struct("at", "evidence_id", "hash", "chars", "fault")
    chunks = rows.groupBy("paper", "scope", "chunk").agg(F.array_sort(F.collect_list(item)).alias("items"))  # ``most`` at most
    parts = reduce(lambda x, _: _halved(x, chars), range(max(0, most - 1).bit_length()), F.array("items"))
    before = lambda k: F.aggregate(F.slice("parts", F.lit(1), k), F.lit(0), lambda n, x: n + F.size(x))
    each = chunks.withColumn("parts", parts).select("paper", "scope", "chunk", "parts", F.posexplode("parts").alias("k", "own"))
    column = lambda name: F.transform("own", lambda x: x[name])
    return each.select(
        "paper",
        "scope",
        (F.col("chunk") * most + before(F.col("k"))).alias("part"),
        column("evidence_id").alias("evidence_ids"),
        F.aggregate("own", F.lit(0).cast("long"), lambda n, x: n + x["chars"]).alias("chars"),
        digest(F.col("paper"), F.col("scope"), F.to_json(column("evidence_id"), {"ignoreNullFields": "false"}), F.to_json(column("hash"), {"ignoreNullFields": "false"})).alias("seal"),
        F.get(F.filter(column("fault"), lambda x: x.isNotNull()), F.lit(0)).alias("problem"),
    )


def stored_links(links: DataFrame) -> DataFrame:
    """``links`` (src, dst), each once and written; null ends are no links."""
    return written(links.where("src is not null and dst is not null").select("src", "dst").distinct(), "links")


def spread(start: DataFrame, links: DataFrame, id_col: str = "node", label: str = "label", closed: DataFrame | None = None) -> DataFrame:
    """``node, hops, label, via``: what ``start`` (node, label) reaches along ``links`` (src, dst), itself included with 0 hops.

    Each node is told once: with the fewest hops, the least label that comes in so many, and the least node before it on such a way.
    ``links`` are ``stored_links``, as every round reads them. Ways end before ``closed`` nodes (column node), which are not told.
    """
    first = start.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("node")).agg(F.lit(0).alias("hops"), F.min(label).alias("label"))
    rounds = [written(first.withColumn("via", F.lit(None).cast(links.schema["src"].dataType)), "spread")]
    union = lambda: reduce(DataFrame.unionByName, rounds)
    hops = 0
    while True:
        hops += 1
        last = rounds[-1].where(F.col("hops") == hops - 1)
        met = links.join(last.select(F.col("node").alias("src"), "label"), "src").groupBy(F.col("dst").alias("node")).agg(F.lit(hops).alias("hops"), F.min(F.struct("label", F.col("src").alias("via"))).alias("m"))
        met = met if closed is None else met.join(closed, "node", "left_anti")
        new = written(met.join(union().select("node"), "node", "left_anti").select("node", "hops", "m.label", "m.via"), "spread")
        if new.isEmpty():
            return union()
        rounds.append(new)
        if len(rounds) > MERGE_ROUNDS:
            merged = written(union(), "spread")
            for x in rounds:
                drop(x)
            rounds = [merged]


def gold_only(links: DataFrame, gold: DataFrame, public: DataFrame) -> DataFrame:
    """``node``: gold records (column node) and what only they reach along ``stored_links``, not ``public`` ones (column node), whose ways end at a gold record."""
    records = written(gold.select("node").where("node is not null").distinct(), "gold")
    marked = lambda df: df.select("node", F.lit(1).alias("label"))
    own = spread(marked(records), links)
    open_ = spread(marked(public.join(records, "node", "left_anti")), links, closed=records)
    return own.join(open_, "node", "left_anti").select("node")


def leaks(items: DataFrame, links: DataFrame, gold: DataFrame, public: DataFrame) -> DataFrame:
    """``packet, item, hops, leak, via``: items (packet, item) whose closure over ``links`` holds a record that only gold reaches.

    Each such item is told once, with the fewest hops to a leak, the least leak so near and the next record on a way to it (null: the item itself is one).
    Ways are followed back from the leaks, so no packet's closure is ever made.
    """
    links = stored_links(links)
    hidden = gold_only(links, gold, public).select("node", F.col("node").alias("label"))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    near = written(spread(hidden, back), "leaks")
    return items.distinct().join(near, items["item"] == near["node"]).select("packet", "item", "hops", F.col("label").alias("leak"), "via")


def isolation_proof(items: DataFrame, found: DataFrame) -> DataFrame:
    """``packet, items, leaked, passed``: a row per packet; ``found`` are its ``leaks``. Null items count, but refer to nothing."""
    told = found.select(F.col("packet").alias("__p"), F.col("item").alias("__i"))
    own = items.distinct()
    both = own.join(told, own["packet"].eqNullSafe(told["__p"]) & (own["item"] == told["__i"]), "left")
    return both.groupBy("packet").agg(F.count("*").alias("items"), F.count("__i").alias("leaked"), (F.count("__i") == 0).alias("passed"))
