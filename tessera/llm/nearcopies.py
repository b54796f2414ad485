"""Near copies on five-word shingles: candidates from MinHash bands and SimHash tables, verified by exact Jaccard.

Texts of equal words are grouped first. Each other text goes to ``BANDS`` MinHash buckets
and the SimHash tables of radius 2. A bucket of at most ``ALL_PAIRS`` texts proposes every
pair; a larger one links each text with the two that agree best with the bucket's most
frequent MinHash values, and with its ``NEAR`` neighbours in order of their keys, so the
proposals are linear in the bucket. Pairs whose sketches can't be similar enough are left
out, the others are compared by their whole sets of shingles.

Texts of a large bucket that are still in different components are then compared further: each one outside the bucket's
largest component with all texts of other components that a longer sketch does not rule out, in the first bucket that both share. The
``BEST`` of them come first; buckets in which a text has more go on with ``MORE`` times as many, until there is none. A large bucket
is cut into cells of ``CHUNK`` texts, and each text outside meets every cell, so no size of a bucket leaves a pair out.

A pair of similarity 0.8 misses all bands with a chance of 4 in 10,000, and each sketch rules it out with one of 2 in a million.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, partitions_for, sliced, text_of, written
from tessera.llm.simhash import covering_masks, fingerprint_of, shingle_hashes, signed
from tessera.operators.components import components
from tessera.shared import drop

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 20, 5
SKETCH, AGREE = 32, 14  # at similarity 0.8, fewer than 14 of 32 values agree with a chance of 2 in a million
LONG, LONG_AGREE = 96, 58  # the same for the longer sketch, which rules out nearly all pairs below 0.5
ALL_PAIRS, NEAR, CHUNK, BEST, MORE = 32, 4, 20_000, 8, 8

_rng = np.random.default_rng(42)
FACTORS = (_rng.integers(0, 1 << 31, BANDS * ROWS, np.uint32) << np.uint32(1)) | np.uint32(1)
SHIFTS = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
MASKS = [signed(m) for m in covering_masks()]


def key_of(raw: bytes) -> int:
    """Equal for texts of equal words."""
    return signed(xxhash.xxh64_intdigest(b" ".join(raw.lower().split()), 7))


def minhashes(hashes: np.ndarray) -> np.ndarray:
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, (short[None, at : at + 2048] * FACTORS[:, None] + SHIFTS[:, None]).min(1), out=out)
    return out


def marks(raw: bytes) -> tuple[list[int], bytes]:
    """The text's bucket in each band and SimHash table, and the longer sketch, which the short one begins."""
    hashes = shingle_hashes(raw, SHINGLE)
    if not len(hashes):
        return [], b""
    low = minhashes(hashes)
    bands = [signed(xxhash.xxh64_intdigest(low[t * ROWS : (t + 1) * ROWS].tobytes(), t)) for t in range(BANDS)]
    fp = fingerprint_of(hashes)
    return bands + [fp & m for m in MASKS], low[:LONG].astype(np.uint8).tobytes()


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, version, key, marks, sketch``, a row per input row; ``version`` tells texts of one id apart."""
    bounded_batches(df.sparkSession)
    names = ["doc_id", "version", "key", "marks", "sketch"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raws = [x.as_buffer().to_pybytes() for x in batch.column("raw")]
            own = [marks(x) for x in raws]
            arrays = [pa.array(map(key_of, raws), pa.int64()), pa.array([m for m, _ in own], pa.list_(pa.int64())), pa.array([s for _, s in own], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), *arrays], names=names)

    text = text_of(text_col)
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.cast("binary").alias("raw"))
    return slim.mapInArrow(made, "doc_id long, version long, key long, marks array<long>, sketch binary")


def proposed(key: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket's texts to compare."""
    n = len(key)
    if n <= ALL_PAIRS:
        a, b = np.triu_indices(n, 1)
    else:
        best = hubs(sketch)
        rows = np.arange(n)
        a = np.concatenate([rows, rows, *(rows[k:] for k in range(1, NEAR + 1))])
        b = np.concatenate([np.full(n, best[0]), np.full(n, best[1]), *(rows[:-k] for k in range(1, NEAR + 1))])
    alike = (a != b) & ((sketch[a] == sketch[b]).sum(1) >= AGREE)
    return np.maximum(key[a[alike]], key[b[alike]]), np.minimum(key[a[alike]], key[b[alike]])


def by_bucket(rows: DataFrame, pairs: Callable[[list[np.ndarray]], tuple], columns: Sequence[str], chunk: int, least: int, mark_large: bool) -> DataFrame:
    """(a, b, large): what ``pairs`` makes of each bucket (t, mark) of ``rows`` with over ``least`` texts, from its columns in order of key.

    A bucket over ``chunk`` texts is taken a chunk at a time, each with the last chunk's best and last texts. With
    ``mark_large``, buckets over ``ALL_PAIRS`` are told too, as (t, mark) in a and b.
    """
    dealt = rows.repartition(partitions_for(rows.sparkSession), "t", "mark").sortWithinPartitions("t", "mark", "key")

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            a, b, large = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(large, pa.bool_())], names=["a", "b", "large"])

        held: list[list[np.ndarray]] = []  # of the bucket that is still open
        current, told = None, False

        def made() -> list[tuple]:
            nonlocal told
            n = sum(len(x[0]) for x in held)
            if n <= least:
                return []
            a, b = pairs([np.concatenate(x) for x in zip(*held, strict=True)])
            found = [(a, b, np.zeros(len(a), bool))]
            if mark_large and n > ALL_PAIRS and not told:
                told = True
                found.append((np.array([current[0]]), np.array([current[1]]), np.ones(1, bool)))
            return found

        for batch in batches:
            if not batch.num_rows:
                continue
            t, mark = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "mark"))
            own = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) if c == "sketch" else batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            cuts = [0, *(np.flatnonzero((t[1:] != t[:-1]) | (mark[1:] != mark[:-1])) + 1).tolist(), len(t)]
            found: list[tuple] = []
            for s, e in itertools.pairwise(cuts):
                if (t[s], mark[s]) != current:
                    found += made()
                    held, current, told = [], (t[s], mark[s]), False
                held.append([x[s:e] for x in own])
                if sum(len(x[0]) for x in held) > chunk:
                    found += made()
                    whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                    keep = np.unique(np.concatenate([hubs(whole[1]), np.arange(len(whole[0]) - NEAR, len(whole[0]))]))
                    held = [[x[keep] for x in whole]]
            if found:
                yield out(found)
        if found := made():
            yield out(found)

    return dealt.mapInArrow(streamed, "a long, b long, large boolean")


def hubs(sketch: np.ndarray) -> np.ndarray:
    """The two texts that agree best with the most frequent values."""
    usual = np.array([np.bincount(c, minlength=256).argmax() for c in sketch.T], np.uint8)
    return np.argsort(-(sketch == usual).sum(1), kind="stable")[:2]


def bucketed(first: DataFrame) -> DataFrame:
    return first.select("key", F.substring("sketch", 1, SKETCH).alias("sketch"), F.posexplode("marks").alias("t", "mark"))


def candidates(first: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Different (a, b), a > b, to compare, and the large buckets (t, mark)."""
    found = written(by_bucket(bucketed(first), lambda x: proposed(*x), ["key", "sketch"], chunk, 1, True), "proposed")
    return found.where("not large").select("a", "b").distinct(), found.where("large").select(F.col("a").cast("int").alias("t"), F.col("b").alias("mark")).distinct()


def proposed_apart(key: np.ndarray, sketch: np.ndarray, root: np.ndarray, asks: np.ndarray, earlier: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of each asking text with the ``best`` others that agree with it best, of those in other components that the sketch does not rule out; and whether any text had more.

    ``earlier`` has the texts' marks in the tables before: what shares one of them meets there.
    """
    a, b, more = [], [], False
    others = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks):
        agree = (sketch[others] == sketch[i]).sum(1)
        fit = np.flatnonzero((agree >= LONG_AGREE) & (root[others] != root[i]))
        fit = fit[~(earlier[others[fit]] == earlier[i]).any(1)]
        if len(fit) > best:
            more = True
            fit = fit[np.lexsort((key[others[fit]], -agree[fit]))[:best]]
        a.append(np.maximum(key[i], key[others[fit]]))
        b.append(np.minimum(key[i], key[others[fit]]))
    none = np.zeros(0, np.int64)
    return np.concatenate(a) if a else none, np.concatenate(b) if b else none, more


def cells(members: DataFrame, open_: DataFrame, star: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``t, mark, i, j, asks, key, root``: the open ones of the large buckets as cells of ``chunk`` asking and ``chunk`` other texts.

    The asking ones are those outside the bucket's largest component; each comes to all cells of its row, every text to all cells of its column.
    """
    own = members.join(open_, ["t", "mark"], "left_semi").join(star.withColumnsRenamed({"a": "key", "b": "root"}), "key", "left")
    rows = written(own.withColumn("root", F.coalesce("root", "key")), "apart-rows")
    per = rows.groupBy("t", "mark", "root").agg(F.count("*").alias("n"))
    sizes = per.groupBy("t", "mark").agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("largest"))
    sized = rows.join(sizes.where("most < total"), ["t", "mark"])
    columns, asking = F.ceil(F.col("total") / chunk).cast("int"), F.ceil((F.col("total") - F.col("most")) / chunk).cast("int")
    place = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    asked = F.struct(place(columns).alias("j"), F.lit(False).alias("asks"), every(asking).alias("all"))
    ask = F.struct(place(asking).alias("j"), F.lit(True).alias("asks"), every(columns).alias("all"))
    roles = sized.select("t", "mark", "key", "root", F.explode(F.when(F.col("root") != F.col("largest"), F.array(asked, ask)).otherwise(F.array(asked))).alias("r"))
    each = roles.select("t", "mark", "key", "root", "r.asks", F.col("r.j").alias("one"), F.explode("r.all").alias("other"))
    return each.select("t", "mark", "key", "root", "asks", F.when(F.col("asks"), F.col("one")).otherwise(F.col("other")).alias("i"), F.when(F.col("asks"), F.col("other")).otherwise(F.col("one")).alias("j"))


def candidates_apart(members: DataFrame, texts: DataFrame, open_: DataFrame, star: DataFrame, best: int = BEST, chunk: int = CHUNK) -> DataFrame:
    """(a, b, more): different pairs to compare in the open buckets, now that components (a, b: its root) are known; with ``more``, buckets (t, mark) in which some text has others left.

    ``members`` (t, mark, key) are the large buckets, ``texts`` (key, sketch, marks) what is in them.
    """
    place = ["t", "mark", "i", "j"]
    dealt = cells(members, open_, star, chunk).join(texts, "key").repartition(partitions_for(members.sparkSession), *place).sortWithinPartitions(*place)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = (0, 0, 0, 0)

        def made() -> pa.RecordBatch:
            key, root, asks, sketch, marked = (np.concatenate(x) for x in zip(*held, strict=True))
            a, b, more = proposed_apart(key, sketch, root, asks, marked[:, : current[0]], best)
            told = [np.append(x, np.full(int(more), y, np.int64)) for x, y in ((a, current[0]), (b, current[1]))]
            return pa.RecordBatch.from_arrays([*map(pa.array, told), pa.array(np.arange(len(told[0])) >= len(a))], names=["a", "b", "more"])

        for batch in batches:
            if not batch.num_rows:
                continue
            where = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in place])
            cuts = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "root")]
            own.append(batch.column("asks").to_numpy(zero_copy_only=False).astype(bool))
            own.append(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, LONG))
            own.append(batch.column("marks").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            for s, e in itertools.pairwise(cuts):
                if held and tuple(where[:, s].tolist()) != current:
                    yield made()
                    held = []
                current = tuple(where[:, s].tolist())
                held.append(tuple(x[s:e] for x in own))
        if held:
            yield made()

    return dealt.mapInArrow(streamed, "a long, b long, more boolean").distinct()


def similar(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have a Jaccard similarity of ``least`` or more."""
    both = pairs.join(texts.withColumnsRenamed({"key": "a", "raw": "x"}), "a").join(texts.withColumnsRenamed({"key": "b", "raw": "y"}), "b")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in sliced(batches):
            rows = []
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for k in range(batch.num_rows):
                if last[0] != b[k]:
                    last = b[k], np.unique(shingle_hashes(batch.column("y")[k].as_py(), SHINGLE))
                x = np.unique(shingle_hashes(batch.column("x")[k].as_py(), SHINGLE))
                shared = len(np.intersect1d(x, last[1], assume_unique=True))
                if shared >= least * (len(x) + len(last[1]) - shared) - 1e-9:
                    rows.append((a[k], b[k]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(made, "a long, b long")


def keys_in(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))


def texts_of(wanted: DataFrame, rows: DataFrame, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, raw``: a text for each wanted key, of any row (``rows`` has doc_id, version, key).

    It is called once, for all that may be compared in any round. The keys' rows are written first, so that
    Spark knows their size and leaves the documents where they are while those fit a broadcast.
    """
    picked = written(rows.groupBy("key").agg(F.min(F.struct("doc_id", "version")).alias("r")).join(wanted, "key", "left_semi").select("key", "r.*"), "picked")
    full = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("version"), text_of(text_col).cast("binary").alias("raw"))
    same = picked["doc_id"].eqNullSafe(full["doc_id"]) & (picked["version"] == full["version"])
    texts = written(full.join(picked, same).select("key", "raw").dropDuplicates(["key"]), "compared")
    drop(picked)
    return texts


def one_of_each_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, chunk: int = CHUNK) -> DataFrame:
    """``df`` with the document of the smallest id of each component of near copies.

    Rows without an id stay. An id with several texts loses only those that are copies.
    """
    signed_rows = written(signatures(df, id_col, text_col), "signatures")
    rows = written(signed_rows.select("doc_id", "version", "key"), "ids")
    first = written(signed_rows.dropDuplicates(["key"]).where("size(marks) > 0").select("key", "marks", "sketch"), "first")
    drop(signed_rows)
    found, large = candidates(first, chunk)
    tested = written(found, "candidates")
    members = written(bucketed(first).drop("sketch").join(large, ["t", "mark"], "left_semi"), "large-buckets")
    texts = texts_of(keys_in(tested).unionByName(members.select("key")).distinct(), rows, df, id_col, text_col)

    def compared(pairs: DataFrame) -> DataFrame:
        return written(similar(pairs, texts.join(keys_in(pairs).distinct(), "key", "left_semi"), least), "similar")

    links = compared(tested)
    star = components(links)
    open_, best = large, BEST
    while not open_.isEmpty():
        sketches = first.join(members.select("key").distinct(), "key", "left_semi")
        found = written(candidates_apart(members, sketches, open_, star, best, chunk), "apart")
        more = written(found.where("not more").select("a", "b").join(tested, ["a", "b"], "left_anti"), "candidates")
        if not more.isEmpty():
            new = compared(more)
            tested, links = tested.unionByName(more), links.unionByName(new)
            if not new.isEmpty():
                star = components(links)
        # in the other buckets every text has met all that may be like it
        open_, best = found.where("more").select(F.col("a").cast("int").alias("t"), F.col("b").alias("mark")).distinct(), best * MORE
    ids = rows.groupBy("key").agg(F.min("doc_id").alias("first_doc"))
    rooted = ids.join(star.withColumnsRenamed({"a": "key", "b": "root"}), "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    labelled = written(rooted.join(smallest, "root").select("key", "component_id"), "labels")
    for table in (first, members, texts):
        drop(table)
    # written, so that its size is known: the documents are dealt anew only if it doesn't fit a broadcast
    others = written(rows.join(labelled, "key").where("doc_id <> component_id").select(F.col("doc_id").alias("__other"), F.col("version").alias("__version")).distinct(), "others")
    return df.join(others, (F.col(id_col).cast("long") == F.col("__other")) & (F.xxhash64(text_of(text_col)) == F.col("__version")), "left_anti")
