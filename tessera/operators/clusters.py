"""Order-dependent groups of records in rounds, so that no task holds a component or a group.

``incremental_groups``: records come in order of id and join the earliest group that holds one of their keys; groups never merge.
A key's group can only fall as records pass, so a record's group is the least id among the records from which a chain of shared
keys, each step to a later record, leads to it. Rounds take the running least along every key and let each record
follow the record that it points to, until nothing falls. Keys are cut into ranges by (key, id), so a hot key is
spread: a range's own running least is joined with the least of the key's earlier ranges.

``absorbed_in_rounds``: items in order of id are kept, or absorbed by the first kept item that is like them. Likeness of texts comes
from an exact prefix filter; then an item is settled as soon as its first candidate that is not itself absorbed is known to be kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.shared import drop, new_table, partitions_for, written

RANGE_ROWS = 200_000
PAIRED_TOKENS = 64


def incremental_groups(records: DataFrame, id_col: str, keys: DataFrame, key_col: str) -> DataFrame:
    """(id, cluster) for each record of ``records``; ``keys`` has (id, key) rows, ids are whole numbers.

    Null keys link nothing, repeated rows count once, records without keys are their own cluster. Equal to a replay in order of id.
    The rounds' joins are merged: a broadcast brings its table to the driver, once a round and join.
    """
    spark = records.sparkSession
    own = keys.where(F.col(key_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(key_col).alias("k")).distinct()
    shared = own.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    linked = written(own.join(shared.hint("merge"), "k", "left_semi"), "key-links")
    parts = max(partitions_for(spark), -(-linked.count() // RANGE_ROWS))
    dealt = linked.repartitionByRange(parts, "k", "i").withColumn("part", F.spark_partition_id())
    edges = written(dealt, "key-ranges")
    drop(linked)
    labels = written(edges.select("i", F.col("i").alias("label")).distinct(), "labels")
    total = _total(labels)
    while total is not None:
        falling = edges.join(labels.hint("merge"), "i")
        inside = F.min("label").over(Window.partitionBy("k", "part").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
        ranges = falling.groupBy("k", "part").agg(F.min("label").alias("least"))
        before = F.min("least").over(Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        earlier = ranges.withColumn("before", before).where("before is not null").select("k", "part", "before")
        running = falling.withColumn("inside", inside).join(earlier.hint("merge"), ["k", "part"], "left")
        least = written(running.groupBy("i").agg(F.least(F.min("inside"), F.min("before")).alias("label")), "labels")
        jump = least.select(F.col("i").alias("label"), F.col("label").alias("further"))
        now = written(least.join(jump.hint("merge"), "label").select("i", F.col("further").alias("label")), "labels")
        drop(least)
        drop(labels)
        labels, last, total = now, total, _total(now)
        if total == last:
            break
    found = records.select(F.col(id_col).cast("long").alias("i")).distinct().join(labels.hint("merge"), "i", "left")
    return found.select(F.col("i").alias(id_col), F.coalesce("label", "i").alias("cluster"))


def _total(labels: DataFrame) -> object:
    """The sum of the labels: they only fall, so an equal sum says that none did."""
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]


def overlapping(items: DataFrame, group: Sequence[str], id_col: str, tokens_col: str, least: float) -> DataFrame:
    """(group, a, b, overlap) for a < b whose token sets share at least ``least`` of the smaller one; exact.

    Of two sets with that overlap, where k tokens of the smaller one have to be shared, two are among its first |s| - k + 2 by rarity (one among the
    first |s| - k + 1). So pairs of tokens of smaller sets' prefixes meet all pairs of tokens of sets at least as large, and are verified by the
    sets; sets over ``PAIRED_TOKENS`` tokens are met by single ones. Ids are unique; items without tokens have no pairs.
    """
    own = items.select(*group, F.col(id_col).alias("i"), F.array_sort(F.array_distinct(tokens_col)).alias("s")).where(F.size("s") > 0)
    each = own.select(*group, "i", F.size("s").alias("n"), F.explode("s").alias("t"))
    rarity = each.groupBy(*group, "t").agg(F.count("*").alias("f"))
    ranked = each.join(rarity, [*group, "t"])
    ordered = ranked.groupBy(*group, "i", "n").agg(F.array_sort(F.collect_list(F.struct("f", "t"))).alias("l"))
    k = F.greatest(F.ceil(F.col("n") * least - 1e-9).cast("int"), F.lit(1))
    first = lambda more: F.array_sort(F.transform(F.slice("l", 1, F.col("n") - k + more), lambda v: v["t"]))
    smaller = ordered.select(*group, F.col("i").alias("x"), F.col("n").alias("nx"), first(1).alias("one"), F.when(k > 1, first(2)).alias("two"))
    pairs_of = lambda c, skip: F.flatten(F.transform(c, lambda v, at: F.transform(F.slice(c, at + skip, F.size(c)), lambda w: F.xxhash64(v, w))))
    by_two = smaller.select(*group, "x", "nx", F.explode(F.when(F.col("two").isNull(), F.transform("one", lambda v: F.xxhash64(v, v))).otherwise(pairs_of("two", 2))).alias("t"))
    larger = own.select(*group, F.col("i").alias("y"), F.size("s").alias("ny"), "s")
    short = larger.where(F.col("ny") <= PAIRED_TOKENS).select(*group, "y", "ny", F.explode(pairs_of("s", 1)).alias("t"))
    long_ = larger.where(F.col("ny") > PAIRED_TOKENS).select(*group, "y", "ny", F.explode("s").alias("t"))
    by_one = smaller.select(*group, "x", "nx", F.explode("one").alias("t"))
    meet = lambda one, other: one.join(other, [*group, "t"]).where("nx <= ny and x <> y").select(*group, "x", "y")
    met = meet(by_two, short).unionByName(meet(by_one, long_)).distinct()
    sets = own.select(*group, F.col("i").alias("x"), F.col("s").alias("sx"))
    other = own.select(*group, F.col("i").alias("y"), F.col("s").alias("sy"))
    overlap = F.size(F.array_intersect("sx", "sy")) / F.least(F.size("sx"), F.size("sy"))
    pairs = met.join(sets, [*group, "x"]).join(other, [*group, "y"]).withColumn("overlap", overlap).where(F.col("overlap") >= least)
    return pairs.select(*group, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "overlap").distinct()


def absorbed_in_rounds(items: DataFrame, group: Sequence[str], id_col: str, tokens_col: str, evidence_col: str, sources_col: str, figure: Column | None = None, same: float = 0.92, same_source: float = 0.72) -> DataFrame:
    """(group, id, kept_as): items in order of id, each kept or absorbed by the first kept item of its group that it is like.

    Two items are like each other if their figures, where both have one, are equal but for case, and they share evidence, or their
    token sets overlap by ``same``, or by ``same_source`` and they share a source. A kept item is judged by what it came with. Ids are
    unique whole numbers; null arrays count as empty, and an item that is not like itself (no tokens, no evidence) is only absorbed by what shares
    its evidence. Items equal in all of this share their fate and are one. Evidence that many items share makes no pairs: of its holders
    that are not absorbed, the first one of each figure is all that an item has to see. Each round settles at least the first open item; how many
    rounds there are is the longest chain of items that wait for each other.
    """
    fields = ["tokens", "evidence", "sources"]
    arrays = [F.array_sort(F.array_distinct(F.coalesce(F.col(c), F.array().cast("array<string>")))).alias(n) for n, c in zip(fields, (tokens_col, evidence_col, sources_col), strict=True)]
    own = items.select(*group, F.col(id_col).cast("long").alias("i"), *arrays, F.lower(figure if figure is not None else F.lit(None).cast("string")).alias("figure"))
    alike = F.struct(*fields, "figure")
    whole = written(own.withColumn("same", F.when((F.size("tokens") > 0) | (F.size("evidence") > 0), F.sha2(F.to_json(alike), 256)).otherwise(F.concat(F.lit("#"), F.col("i")))), "items")
    firsts = whole.groupBy(*group, "same").agg(F.min("i").alias("i"))
    nodes = written(whole.join(firsts.select("i"), "i", "left_semi"), "item-kinds")
    texts, links = _texts(nodes, group, same, same_source)
    held = written(nodes.select(*group, "i", "figure", F.explode("evidence").alias("e")), "item-evidence")
    spark = items.sparkSession
    open_, fate = written(nodes.select("i").distinct(), "items-open"), new_table(spark, "item-fates")
    kept = None
    for number in range(1 << 30):
        # what may still absorb: items that are open or kept
        alive = open_ if kept is None else open_.unionByName(kept)
        holders = held.join(alive, "i", "left_semi")
        hub = [*group, "e"]
        least = holders.groupBy(*hub, "figure").agg(F.min("i").alias("m"))
        any_ = least.groupBy(*hub).agg(F.min("m").alias("any"), F.min(F.when(F.col("figure").isNull(), F.col("m"))).alias("plain"))
        mine = _hub_firsts(holders.join(open_, "i", "left_semi"), least, any_, hub)
        told = _text_firsts(texts, links, group, open_, alive)
        first = mine.unionByName(told).where("first < i").groupBy("i").agg(F.min("first").alias("first"))
        step = written(open_.join(first, "i", "left"), "item-round")
        free = step.where("first is null").select("i")
        settled = free if kept is None else free.unionByName(kept)
        gone = written(step.where("first is not null").join(settled.withColumnRenamed("i", "first"), "first", "left_semi").select("i", "first"), "item-gone")
        gone.write.parquet(f"{fate}/round={number}")
        kept = written(settled, "items-kept")
        rest = written(step.where("first is not null").select("i").join(gone.select("i"), "i", "left_anti"), "items-open")
        drop(open_)
        open_ = rest
        if open_.isEmpty():
            break
    fates = spark.read.schema("i long, first long").option("recursiveFileLookup", "true").parquet(fate)
    by_kind = firsts.join(fates, "i", "left").select(*group, "same", F.coalesce("first", "i").alias("kept_as"))
    match = F.col("w.same") == F.col("k.same")
    for c in group:
        match = match & F.col(f"w.{c}").eqNullSafe(F.col(f"k.{c}"))
    return whole.alias("w").join(by_kind.alias("k"), match).select(*(F.col(f"w.{c}").alias(c) for c in group), F.col("w.i").alias(id_col), F.col("k.kept_as").alias("kept_as"))


def _hub_firsts(open_holders: DataFrame, least: DataFrame, any_: DataFrame, hub: Sequence[str]) -> DataFrame:
    """(i, first): for each open item and evidence, the first holder with a figure that fits."""
    own = least.where("figure is not null").select(*hub, "figure", F.col("m").alias("equal"))
    seen = open_holders.join(any_, list(hub)).join(own, [*hub, "figure"], "left")
    fitting = F.when(F.col("figure").isNull(), F.col("any")).otherwise(F.least("plain", "equal"))
    return seen.select("i", fitting.alias("first"))


def _texts(nodes: DataFrame, group: Sequence[str], same: float, same_source: float) -> tuple[DataFrame, DataFrame]:
    """(group, i, set, source, shown) for each item's token set, without a source and with each of its own; (set, near, plain) for sets that are like each other.

    Items are many, different token sets fewer: only sets are paired, over all groups at once where groups have most of them in common.
    ``plain`` links ask for no common source.
    """
    own = nodes.where(F.size("tokens") > 0)
    per_group, alone = own.select(*group, "tokens").distinct().count(), own.select("tokens").distinct().count()
    by = [] if per_group > 2 * alone else list(group)
    sets = written(own.groupBy(*by, "tokens").agg(F.min("i").alias("set")), "token-sets")
    close = written(overlapping(sets, by, "set", "tokens", min(same, same_source)).select("a", "b", "overlap"), "set-pairs")
    itself = sets.select(F.col("set").alias("a"), F.col("set").alias("b"), F.lit(1.0).alias("overlap"))
    both = close.unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "overlap")).unionByName(itself)
    plain = F.col("overlap") >= same
    links = written(both.where(plain | (F.col("overlap") >= same_source)).select(F.col("a").alias("set"), F.col("b").alias("near"), plain.alias("plain")), "set-links")
    places = F.concat(F.array(F.lit("")), F.transform("sources", lambda x: F.concat(F.lit("="), x)))
    shown = F.coalesce(F.concat(F.lit("="), "figure"), F.lit(""))
    return written(own.join(sets, [*by, "tokens"]).select(*group, "i", "set", F.explode(places).alias("source"), shown.alias("shown")), "item-texts"), links


def _text_firsts(texts: DataFrame, links: DataFrame, group: Sequence[str], open_: DataFrame, alive: DataFrame) -> DataFrame:
    """(i, first): for each open item, the first living item of its group whose text is like its own, with a figure that fits; by sets, sources and figures, so that items make no pairs."""
    kind = [*group, "set", "source", "shown"]
    asking = texts.join(open_, "i", "left_semi")
    asked = asking.select(*kind, (F.col("source") == "").alias("plain")).distinct().join(links, ["set", "plain"])
    least = texts.join(alive, "i", "left_semi").groupBy(*kind).agg(F.min("i").alias("first")).withColumnsRenamed({"set": "near", "shown": "theirs"})
    fits = (F.col("shown") == "") | (F.col("theirs") == "") | (F.col("shown") == F.col("theirs"))
    found = asked.join(least, [*group, "near", "source"]).where(fits).groupBy(*kind).agg(F.min("first").alias("first"))
    return asking.join(found, kind).select("i", "first")
