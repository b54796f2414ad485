"""Line dedup: hashes dealt by range with a secondary sort, first occurrences streamed, keep bitmaps returned.

1. Each line with a long enough key becomes (128-bit hash, document, text version, position).
2. The rows are range-partitioned by (hash, document, position) and sorted. The splitters
   are sampled over the whole key, so a line that a third of all documents share is
   spread over many partitions instead of meeting in one.
3. Each partition is streamed: rows whose document is not the first of their hash are
   dropped. Only the first hash of a partition may have begun in an earlier one; its rows
   are settled by a summary of two rows a partition (each partition's first and last hash
   with its smallest document), which is therefore small enough to broadcast.
4. Dropped positions are grouped per document into a compressed bitmap; texts are not shuffled for that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, documents, partitions_for, sliced, text_of, written

MIN_KEY_CHARS = 10
SPACE = b" \t\n\x0b\x0c\r"  # what is stripped at both ends of a key
NO_ID = (1 << 63) - 1
DROP, HEAD, EDGE = 0, 1, 2
ID, VERSION = "__line_doc", "__line_version"


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.withColumns({ID: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), VERSION: F.xxhash64(text_of(text_col))})


def line_hashes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """A row (hi, lo, doc, version, pos) for each line whose key has at least ``min_chars`` code points."""
    bounded_batches(df.sparkSession)
    slim = _keyed(df, id_col, text_col).select(ID, VERSION, text_of(text_col).cast("binary").alias("raw"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            digests, pos, counts = [], [], []
            for raw in batch.column("raw"):
                before = len(pos)
                for k, line in enumerate(raw.as_buffer().to_pybytes().lower().split(b"\n")):
                    key = line.strip(SPACE)
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        pos.append(k)
                counts.append(len(pos) - before)
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            own = np.repeat(np.arange(len(counts)), counts)
            ids = [batch.column(c).to_numpy(zero_copy_only=False)[own] for c in (ID, VERSION)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (halves[:, 0], halves[:, 1], *ids, np.array(pos, np.int32))], names=["hi", "lo", "doc", "version", "pos"])

    return slim.mapInArrow(hashed, "hi long, lo long, doc long, version long, pos int")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: rows to drop, undecided rows of its first hash, and its edges."""
    head = last = None  # (hi, lo, smallest document)
    in_head = True
    names = ["kind", "hi", "lo", "doc", "version", "pos"]

    def edge(x: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([EDGE], pa.int32()), *(pa.array([v], pa.int64()) for v in (*x, 0)), pa.array([0], pa.int32())], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo, doc, version, pos = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        if last and (last[0], last[1]) == (hi[0], lo[0]):
            new[0] = False
        head = head or (hi[0], lo[0], doc[0])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1  # -1: the run carried over from the batch before
        first_doc = np.where(run < 0, last[2] if last else 0, doc[starts[np.maximum(run, 0)]] if len(starts) else 0)
        own_head = (hi == head[0]) & (lo == head[1]) if in_head else np.zeros(len(hi), bool)
        in_head = bool(own_head[-1])
        last = (hi[-1], lo[-1], first_doc[-1])
        kept = own_head | (doc != first_doc)
        kind = np.where(own_head, HEAD, DROP).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (kind, hi, lo, doc, version, pos)], names=names)
    if head:
        yield edge(head)
        yield edge(last)


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(doc, version, pos) of every line that is not in the first document of its hash."""
    spark = lines.sparkSession
    bounded = lines.repartitionByRange(partitions_for(spark), "hi", "lo", "doc", "version", "pos").sortWithinPartitions("hi", "lo", "doc", "version", "pos")
    found = written(bounded.mapInArrow(_stream, "kind int, hi long, lo long, doc long, version long, pos int"), "line-decisions")
    sure = found.where(F.col("kind") == DROP).select("doc", "version", "pos")
    edges = found.where(F.col("kind") == EDGE).groupBy("hi", "lo").agg(F.min("doc").alias("first_doc"))
    # Two rows a partition at most: bounded by the partition count, not by the data.
    heads = found.where(F.col("kind") == HEAD).join(F.broadcast(edges), ["hi", "lo"]).where("doc > first_doc").select("doc", "version", "pos")
    return sure.unionByName(heads)


def keep_bitmaps(drops: DataFrame) -> DataFrame:
    """(doc, version, bitmap): a zlib-compressed bitmap, a bit a line, 1 to keep; lines beyond its end stay.

    A document without dropped lines has no row.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.column("pos"):
                pos = row.values.to_numpy()
                keep = np.ones((int(pos.max()) | 7) + 1, bool)  # whole bytes
                keep[pos] = False
                made.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("version"), pa.array(made, pa.binary())], names=["doc", "version", "bitmap"])

    return drops.groupBy("doc", "version").agg(F.collect_list("pos").alias("pos")).mapInArrow(packed, "doc long, version long, bitmap binary")


def line_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """The keep bitmap of each document that loses lines; see ``keep_bitmaps``.

    Rows with one id are one document. A null id counts as the largest id. Null and empty
    texts are one empty line, which is too short to be dropped.
    """
    return keep_bitmaps(repeated_lines(written(line_hashes(df, id_col, text_col, min_chars), "lines")))


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its text reduced to the kept lines, and ``n_lines`` and ``n_dropped`` (replacing columns so named).

    Every input row stays, with its other columns; repeated rows get the same bitmap.
    """
    bounded_batches(df.sparkSession)
    df = df.drop("n_lines", "n_dropped")
    marks = bitmaps.select(F.col("doc").alias(ID), F.col("version").alias(VERSION), F.col("bitmap").alias("__bitmap"))
    joined = _keyed(df, id_col, text_col).withColumn(text_col, text_of(text_col)).join(marks.hint("shuffle_hash"), [ID, VERSION], "left").drop(ID, VERSION)
    schema = df.withColumn(text_col, text_of(text_col)).withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, total, dropped = [], [], []
            for text, bits in zip(batch.column(text_col), batch.column("__bitmap"), strict=True):
                lines = text.as_py().split("\n")
                total.append(len(lines))
                if bits.is_valid:
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bits.as_py()), np.uint8), bitorder="little")
                    lines = [x for k, x in enumerate(lines) if k >= len(keep) or keep[k]]
                dropped.append(total[-1] - len(lines))
                texts.append("\n".join(lines))
            own = {text_col: pa.array(texts, pa.string()), "n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([own.get(n, batch.column(n) if n not in own else None) for n in schema.names], names=schema.names)

    return joined.mapInArrow(reduced, schema)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bitmaps found and applied in one call."""
    return apply_bitmaps(df, line_bitmaps(df, id_col, text_col), id_col, text_col)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE k.doc_id > f.first_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.first_doc IS NULL OR k.doc_id = f.first_doc), '')) AS kept_sha256
FROM keyed k LEFT JOIN firsts f ON k.key = f.key
GROUP BY k.doc_id
"""
