"""One-to-one matching and greedy packing: order-dependent work on groups of bounded size.

Groups are one paper's candidates or one query's evidence; each caller names the group's
columns, and no group spans the corpus. Groups are dealt by hash and sorted, and a task
streams through its groups one at a time, so that many small groups cost no more than
their rows.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

Rows = list[tuple]


def per_group(df: DataFrame, group: Sequence[str], columns: Sequence[str], work: Callable[[Rows], Rows], made: str) -> DataFrame:
    """``work`` on the rows (tuples of ``columns``) of each group; its rows, after the group's columns, are the result.

    ``made`` declares them. Groups follow each other within a sorted partition, so only one is held.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in group), made])
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    dealt = df.select(*group, *columns).repartition(*group).sortWithinPartitions(*group)
    n = len(group)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Rows = []
        for key, own in itertools.groupby(rows(batches), operator.itemgetter(*range(n)) if n > 1 else lambda x: x[:1]):
            out += [(*key, *row) for row in work([x[n:] for x in own])]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), arrow, strict=True)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), arrow, strict=True)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def _kind(df: DataFrame, column: str) -> str:
    return f"`{column}` {df.schema[column].dataType.simpleString()}"


def augmented(edges: list[tuple]) -> dict:
    """A largest set of pairs by augmenting paths: right -> left. Lefts and their rights are tried in sorted order."""
    near: dict = {}
    for a, b in sorted(set(edges)):
        near.setdefault(a, []).append(b)
    owner: dict = {}
    for start in sorted(near):
        came, todo, free = {}, [start], None
        seen: set = set()
        while todo and free is None:
            a = todo.pop()
            for b in near[a]:
                if b in seen:
                    continue
                seen.add(b)
                came[b] = a
                if b not in owner:
                    free = b
                    break
                todo.append(owner[b])
        while free is not None:
            a = came[free]
            held = next((b for b, x in owner.items() if x == a), None)
            owner[free] = a
            free = held
    return owner


def most_pairs(pairs: DataFrame, group: Sequence[str], left: str, right: str) -> DataFrame:
    """A largest one-to-one matching within each group of (left, right) edges."""
    work = lambda rows: sorted((a, b) for b, a in augmented(rows).items())
    return per_group(pairs, group, [left, right], work, f"{_kind(pairs, left)}, {_kind(pairs, right)}")


def heaviest(weights: dict[tuple, float]) -> list[tuple]:
    """Pairs of the greatest total weight, by successive best paths (a small assignment by potentials)."""
    lefts, rights = sorted({a for a, _ in weights}), sorted({b for _, b in weights})
    n = len(lefts)
    m = len(rights) + n  # a dummy for each left: staying alone
    cost = [[-weights.get((a, b), 0.0) if (a, b) in weights else 0.0 for b in rights] + [0.0] * n for a in lefts]
    u, v, match = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, way, used = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    now = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if now < low[j]:
                        low[j], way[j] = now, j0
                    if low[j] < delta:
                        delta, j1 = low[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    low[j] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return [(lefts[match[j] - 1], rights[j - 1]) for j in range(1, len(rights) + 1) if match[j] and (lefts[match[j] - 1], rights[j - 1]) in weights]


def heaviest_pairs(scored: DataFrame, group: Sequence[str], left: str, right: str, score: str, least: float, count_first: bool = False) -> DataFrame:
    """One-to-one pairs of at least ``least`` with the greatest sum; with ``count_first``, of the most pairs first."""

    def work(rows: Rows) -> Rows:
        weights = {(a, b): s for a, b, s in rows if s >= least}
        bonus = sum(weights.values()) + 1 if count_first else 0.0
        found = heaviest({k: s + bonus for k, s in weights.items()}) if weights else []
        return [(a, b, weights[a, b]) for a, b in sorted(found)]

    return per_group(scored, group, [left, right, score], work, f"{_kind(scored, left)}, {_kind(scored, right)}, `{score}` double")


def greedy_pairs(scored: DataFrame, group: Sequence[str], left: str, right: str, score: str, least: float) -> DataFrame:
    """One-to-one pairs taken by falling score, then by left and right, down to ``least``."""

    def work(rows: Rows) -> Rows:
        out, lefts, rights = [], set(), set()
        for a, b, s in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
            if s < least:
                break
            if a not in lefts and b not in rights:
                lefts.add(a)
                rights.add(b)
                out.append((a, b, s))
        return out

    return per_group(scored, group, [left, right, score], work, f"{_kind(scored, left)}, {_kind(scored, right)}, `{score}` double")


def within_budget(items: DataFrame, group: Sequence[str], id_col: str, size_col: str, priority_col: str, budget: int) -> DataFrame:
    """Items by falling priority as long as they fit; one that does not fit is passed over, later ones may fit."""

    def work(rows: Rows) -> Rows:
        left, out = budget, []
        for i, size, _ in sorted(rows, key=lambda x: (-x[2], x[0])):
            fits = size <= left
            left -= size if fits else 0
            out.append((i, fits, "selected" if fits else "over_budget"))
        return out

    return per_group(items, group, [id_col, size_col, priority_col], work, f"{_kind(items, id_col)}, selected boolean, reason string")


def next_fit(items: DataFrame, group: Sequence[str], id_col: str, sizes: Sequence[str], caps: Sequence[int]) -> DataFrame:
    """Items in order of id into tasks; a task closes when the next item would break a cap. Task 0 holds items too large for any."""

    def work(rows: Rows) -> Rows:
        task, used, out = 0, None, []
        for i, *own in sorted(rows):
            if any(x > c for x, c in zip(own, caps, strict=True)):
                out.append((i, 0))
                continue
            if used is None or any(a + x > c for a, x, c in zip(used, own, caps, strict=True)):
                task, used = task + 1, [0] * len(sizes)
            used = [a + x for a, x in zip(used, own, strict=True)]
            out.append((i, task))
        return out

    return per_group(items, group, [id_col, *sizes], work, f"{_kind(items, id_col)}, task int")


def chunked(items: DataFrame, group: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Numbers from 0 for chunks of ``size`` rows in order."""
    from pyspark.sql import Window

    return items.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1) / size).cast("int"))


def diverse(items: DataFrame, group: Sequence[str], id_col: str, kind_col: str, score_col: str, least: float, most: int) -> DataFrame:
    """First the best of each kind with at least ``least``, then the rest by score, ``most`` in all."""
    from pyspark.sql import Window

    own = Window.partitionBy(*group, kind_col).orderBy(F.desc(score_col), id_col)
    first = (F.row_number().over(own) == 1) & (F.col(score_col) >= least)
    passed = items.withColumn("__pass", F.when(first, 1).otherwise(2))
    w = Window.partitionBy(*group).orderBy("__pass", F.desc(score_col), id_col)
    return passed.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).drop("__pass")


def incremental_clusters(records: DataFrame, component: str, order: str, keys_col: str) -> DataFrame:
    """Records in order join the earliest group that holds one of their keys, and re-point their keys to it; groups never merge.

    ``component`` closes the groups off from each other (connected components of shared
    keys), so the replay is exact and each component is a task's work.
    """

    def work(rows: Rows) -> Rows:
        owner: dict[str, int] = {}
        out = []
        for i, keys in sorted(rows):
            group = min((owner[k] for k in keys if k in owner), default=i)
            owner.update(dict.fromkeys(keys, group))
            out.append((i, group))
        return out

    return per_group(records, [component], [order, keys_col], work, f"{_kind(records, order)}, cluster long").drop(component)


def consumed(answers: DataFrame, gold: DataFrame, key: str, link: str) -> DataFrame:
    """(key, result, n). Answers use up gold records with their key and link, each once: what they use is correct, further
    ones are duplicates, those of a key with gold elsewhere have a wrong link, others are unsupported; unused gold is missed.

    Which of equal answers comes first makes no difference to the counts, so none are put in order.
    """
    side = lambda df, name: df.groupBy(key, link).agg(F.count("*").alias(name))
    both = side(answers, "__a").join(side(gold, "__g"), [key, link], "full").na.fill(0, ["__a", "__g"])
    known = gold.select(key).distinct().withColumn("__known", F.lit(True))
    right = F.least("__a", "__g")
    extra = F.when(F.col("__g") > 0, "duplicate").when(F.col("__known"), "wrong_link").otherwise("unsupported")
    kinds = F.array(*(F.struct(r.alias("result"), n.alias("n")) for r, n in ((F.lit("correct"), right), (F.lit("missed"), F.col("__g") - right), (extra, F.col("__a") - right))))
    each = both.join(known, key, "left").select(key, F.inline(kinds)).where("n > 0")
    return each.groupBy(key, "result").agg(F.sum("n").alias("n"))


def absorbed(items: DataFrame, group: Sequence[str], id_col: str, tokens_col: str, source_col: str, same: float = 0.92, same_source: float = 0.72) -> DataFrame:
    """Items in order of id; one like a kept item (overlap of tokens) is absorbed by the first such.

    Items with the same tokens and source share their fate, so only the first of them is compared, and only with kept
    items that share a token with it. What a task holds is a group's different token sets; items without tokens stay.
    """
    own = items.select(*group, id_col, F.array_sort(F.array_distinct(tokens_col)).alias("__tokens"), F.col(source_col).alias("__source"))
    firsts = own.where(F.size("__tokens") > 0).groupBy(*group, "__tokens", "__source").agg(F.min(id_col).alias(id_col))

    def work(rows: Rows) -> Rows:
        kept: list[tuple] = []
        having: dict[str, list[int]] = {}
        out = []
        for i, tokens, source in sorted(rows, key=lambda x: x[0]):
            shared: dict[int, int] = {}
            for x in tokens:
                for k in having.get(x, ()):
                    shared[k] = shared.get(k, 0) + 1
            like = (k for k, n in shared.items() if (part := n / min(len(tokens), kept[k][1])) >= same or kept[k][2] == source and part >= same_source)
            first = min(like, default=None)
            if first is None:
                for x in tokens:
                    having.setdefault(x, []).append(len(kept))
                kept.append((i, len(tokens), source))
            out.append((tokens, source, i if first is None else kept[first][0]))
        return out

    kinds = {f.name: f.dataType.simpleString() for f in own.schema}
    fate = per_group(firsts, group, [id_col, "__tokens", "__source"], work, f"__tokens {kinds['__tokens']}, __source {kinds['__source']}, kept_as {kinds[id_col]}")
    match = F.col("o.__tokens") == F.col("f.__tokens")
    for c in group:
        match = match & F.col(f"o.{c}").eqNullSafe(F.col(f"f.{c}"))
    joined = own.alias("o").join(fate.alias("f"), match & F.col("o.__source").eqNullSafe(F.col("f.__source")), "left")
    return joined.select(*(F.col(f"o.{c}").alias(c) for c in group), F.col(f"o.{id_col}").alias(id_col), F.coalesce("f.kept_as", f"o.{id_col}").alias("kept_as"))
