"""SimHash near-dedup by covering locality-sensitive hashing.

Each bit of the 64-bit fingerprint gets a vector of radius + 1 bits; table v (every
non-zero vector) keeps the bits whose vector has an odd product with v. Any ``radius`` bits
that differ are orthogonal to some v, so a pair within the radius agrees on the whole key
of some table: no pair is missed. Equal fingerprints are grouped first, so buckets hold
different fingerprints only. Within a bucket, fingerprints link when their balls of half
the radius meet, which is exact for an even radius and linear in the bucket; a bucket over
``BUCKET_ROWS`` is not held in a task but has its balls joined by Spark. Buckets give a
spanning forest, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, documents, partitions_for, sliced, text_of, written
from tessera.operators.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
BUCKET_ROWS = 20_000
SMALL_BUCKET = 48


def shingle_hashes(raw: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit hash of each shingle of a text's UTF-8 bytes, in order; none of a text without words."""
    words = raw.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = sizes.cumsum()
    starts = (ends - sizes).tolist()
    ends = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=False)]), np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    n = len(hashes)
    if not n:
        return 0
    octets = hashes.view(np.uint8).reshape(n, 8)
    if n < 128:
        ones = np.unpackbits(octets, axis=1).sum(0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text's UTF-8 bytes, as a signed 64-bit number."""
    return fingerprint_of(shingle_hashes(raw, shingle))


BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def version_of(text_col: str) -> Column:
    """What tells the texts of a reused id apart."""
    return F.xxhash64(text_of(text_col))


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", versions: bool = False) -> DataFrame:
    """(doc_id, fp), a row per input row; null texts are empty, whose fingerprint is zero. ``versions`` adds a hash of the text."""
    bounded_batches(df.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            fp = [fingerprint(x.as_buffer().to_pybytes(), shingle) for x in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, carried), pa.array(fp, pa.int64())], names=[*carried, "fp"])

    carried = ["doc_id", *["version"] * versions]
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), version_of(text_col).alias("version"), text_of(text_col).cast("binary").alias("raw"))
    return slim.select(*carried, "raw").mapInArrow(made, ", ".join(f"{c} long" for c in [*carried, "fp"]))


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """A mask per table. Bit vectors go round over the non-zero values, so tables keep about equally many bits."""
    values = 1 << (radius + 1)
    vector = [1 + k % (values - 1) for k in range(bits)]
    return [sum(1 << k for k in range(bits) if bin(vector[k] & v).count("1") % 2) for v in range(1, values)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball(radius: int) -> list[int]:
    """What to flip to reach every fingerprint within half the radius."""
    return [signed(sum(1 << b for b in c)) for n in range(radius // 2 + 1) for c in itertools.combinations(range(64), n)]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest vertex each of ``n`` vertices reaches over the edges a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within one bucket of different fingerprints."""
    if len(fp) <= SMALL_BUCKET:
        a, b = np.nonzero(np.triu(np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64)) <= radius, 1))
    else:
        centres = (fp[:, None] ^ np.array(ball(radius), np.int64)[None, :]).ravel()
        order = np.argsort(centres, kind="stable")
        meet = np.flatnonzero(centres[order[1:]] == centres[order[:-1]])
        size = len(centres) // len(fp)
        a, b = order[meet] // size, order[meet + 1] // size
    if not len(a):
        return fp[:0], fp[:0]
    label = forest(len(fp), a, b)
    own = np.flatnonzero(label != np.arange(len(fp)))
    return fp[own], fp[label[own]]


def links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b) edges between fingerprints (``fp``, distinct) that connect all within ``radius`` bits."""
    if radius % 2:
        raise ValueError("the radius must be even")
    spark = distinct.sparkSession
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(covering_masks(radius))))
    dealt = distinct.select("fp", F.inline(keys)).repartition(partitions_for(spark), "t", "key").sortWithinPartitions("t", "key", "fp")

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, large):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), large))], names=["a", "b", "large"])

        held: list[np.ndarray] = []  # of the bucket that is still open
        current, overflows = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            t, key, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "fp"))
            cuts = [0, *(np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1).tolist(), len(fp)]
            made: list[tuple] = []
            for s, e in itertools.pairwise(cuts):
                if (t[s], key[s]) != current:
                    if sum(map(len, held)) > 1:
                        made.append(bucket_links(np.concatenate(held), radius))
                    held, current, overflows = [], (t[s], key[s]), False
                held.append(fp[s:e])
                if overflows or sum(map(len, held)) > bucket_rows:
                    overflows = True
                    rows = np.concatenate(held)
                    yield out(rows, rows, True)
                    held = []
            if made:
                yield out(np.concatenate([x for x, _ in made]), np.concatenate([x for _, x in made]), False)
        if sum(map(len, held)) > 1:
            yield out(*bucket_links(np.concatenate(held), radius), False)

    found = written(dealt.mapInArrow(streamed, "a long, b long, large boolean"), "links")
    wide = found.where("large").select(F.col("a").alias("fp")).distinct()
    centres = wide.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(x)) for x in ball(radius)))).alias("centre"))
    roots = centres.groupBy("centre").agg(F.min("fp").alias("b"))
    met = centres.join(roots, "centre").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return found.where("not large").select("a", "b").unionByName(met)


def simhash_components(df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text", versions: bool = False) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row per input row.

    ``component_id`` is the smallest id in the component, nulls left aside (null if it has
    none else). Repeated rows are the same document. Empty tables give empty results.
    ``versions`` adds the texts' hashes as ``version``.
    """
    docs = written(fingerprints(df, shingle, id_col, text_col, versions), "fingerprints")
    distinct = docs.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    star = components(links(distinct.select("fp"), radius, bucket_rows))
    rooted = distinct.join(star.withColumnsRenamed({"a": "fp", "b": "root"}), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    labelled = written(rooted.join(least, "root").select("fp", "component_id"), "labels")
    return docs.join(labelled, "fp").select("doc_id", *["version"] * versions, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with the document of the smallest id of each component; rows without an id stay.

    An id with several texts loses only those whose component has a smaller id.
    """
    found = simhash_components(df, id_col=id_col, text_col=text_col, versions=True, **options).where("doc_id <> component_id")
    others = found.select(F.col("doc_id").alias("__other"), F.col("version").alias("__version")).distinct()
    return df.join(others, (F.col(id_col).cast("long") == F.col("__other")) & (version_of(text_col) == F.col("__version")), "left_anti")


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
