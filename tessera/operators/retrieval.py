"""Retrieval: BM25, TF-IDF, vectors, rank fusion with neighbours, diversity and evidence gates.

The queries are a stated set. As long as their terms are at most ``ASKED_TERMS``, BM25 and TF-IDF
score beside the scan: each task turns its documents, block by block, into a matrix of the asked
terms, multiplies it with blocks of queries and keeps the best of each query, so what is shuffled
grows with queries times tasks. Beyond, terms are joined with their postings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.shared import drop, partitions_for, written

K1, B = 1.2, 0.75
RANK_OFFSET, NEIGHBOUR_SHARE, SEEDS = 60, 0.18, 4
LEAST_TERM = 3
QUERY_BLOCK, VECTOR_BLOCK = 512, 4096
ASKED_TERMS = 300_000  # and rows of (query, term), held by the driver and each task
TERM_ROWS = 2_000_000  # (document, term) rows that meet in a task
HELD_DOCUMENTS = 5_000_000
ROW_BLOCK, COLUMN_BLOCK = 256, 64  # documents and queries that meet as matrices
WORD, LONG_WORD = r"[a-z0-9]+", r"[a-z0-9_]{2,}"


def terms(df: DataFrame, id_col: str, text_col: str, only: DataFrame | None = None) -> DataFrame:
    """(id, term, tf, size): term counts, of the terms in ``only`` if given, and how many terms the row has in all."""
    words = df.select(F.col(id_col), F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit("([a-z0-9]+)"), 1).alias("w"))
    each = words.select(id_col, F.size("w").alias("size"), F.explode("w").alias("term"))
    if only is not None:
        each = each.join(only, "term", "left_semi")
    return each.groupBy(id_col, "size", "term").agg(F.count("*").alias("tf"))


def query_terms(queries: DataFrame, query_col: str, text_col: str) -> DataFrame:
    """Distinct (query, term) with terms of ``LEAST_TERM`` letters and more."""
    return terms(queries, query_col, text_col).where(F.length("term") >= LEAST_TERM).select(query_col, "term")


def ranked(scores: DataFrame, query_col: str, id_col: str, k: int) -> DataFrame:
    """The k best of each query, ties by id; the limit is a window group limit, applied before the shuffle too."""
    w = Window.partitionBy(query_col).orderBy(F.desc("score"), id_col)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class Asked:
    """The terms of all queries by number, and each query's terms with a weight."""

    def __init__(self, rows: list, query_col: str):
        self.terms = {t: k for k, t in enumerate(sorted({r["term"] for r in rows}))}
        self.queries = sorted({r[query_col] for r in rows})
        place = {q: k for k, q in enumerate(self.queries)}
        self.row = np.array([place[r[query_col]] for r in rows], np.int64)
        self.term = np.array([self.terms[r["term"]] for r in rows], np.int64)
        self.weight = np.array([float(r["tf"]) for r in rows])


def asked_terms(asked: DataFrame, query_col: str, most: int) -> Asked | None:
    """The queries' terms (query, term, tf), unless they are too many to be held."""
    rows = asked.limit(most + 1).collect()
    return Asked(rows, query_col) if len(rows) <= most else None


def postings(blocks: DataFrame, asked: Asked, id_col: str, text_col: str, pairs: bool) -> DataFrame:
    """A row per document: ``id, size, terms, counts`` of the asked terms in it. ``pairs``: words of two letters and more, and pairs of neighbours."""
    words, number = re.compile(LONG_WORD if pairs else WORD), asked.terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text").to_pylist():
                own = words.findall(text)
                sizes.append(len(own))
                found = Counter(filter(number.__contains__, own))
                if pairs:
                    found.update(filter(number.__contains__, map(" ".join, zip(own, own[1:]))))
                terms.append([number[x] for x in found])
                counts.append(list(found.values()))
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(terms, lists), pa.array(counts, lists)], names=["id", "size", "terms", "counts"])

    slim = blocks.select(F.col(id_col).cast("long").alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    return slim.mapInArrow(count, "id long, size long, terms array<int>, counts array<int>")


def document_frequency(found: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each asked term is: as many numbers as there are asked terms."""
    out = np.zeros(terms)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        out[r["t"]] = r["count"]
    return out


def best_rows(found: DataFrame, asked: Asked, weights: np.ndarray, part: Callable, k: int, id_col: str, query_col: str, kind: str, positive: bool) -> DataFrame:
    """(query, id, score, rank): the k best of each query by the sum over terms of ``weights`` (of query and term) and ``part`` (of a document's terms).

    ``part`` gets numbers of terms, counts and, for each, the row's other columns. ``positive``: scores that round to nothing do not count.
    """
    order = np.argsort(asked.row, kind="stable")
    row, term, weight = asked.row[order], asked.term[order], weights[order]
    starts = np.searchsorted(row, np.arange(0, len(asked.queries) + COLUMN_BLOCK, COLUMN_BLOCK))
    numbers, n_terms = len(asked.queries), len(asked.terms)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []  # of queries: their terms' columns, and the weights
        for b in range(len(starts) - 1):
            own = slice(starts[b], starts[b + 1])
            used, at = np.unique(term[own], return_inverse=True)
            dense = np.zeros((len(used), min(COLUMN_BLOCK, numbers - b * COLUMN_BLOCK)))
            dense[at, row[own] - b * COLUMN_BLOCK] = weight[own]
            column = np.full(n_terms, -1, np.int32)
            column[used] = np.arange(len(used))
            blocks.append((column, dense))
        best_score, best_id = np.full((numbers, k), -np.inf), np.full((numbers, k), np.iinfo(np.int64).max)
        for whole in batches:
            for at in range(0, whole.num_rows, ROW_BLOCK):
                batch = whole.slice(at, ROW_BLOCK)
                terms, counts = batch.column("terms"), batch.column("counts")
                sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
                of, own = np.repeat(np.arange(batch.num_rows), sizes), terms.flatten().to_numpy()
                value = part(own, counts.flatten().to_numpy(), {c: batch.column(c).to_numpy(zero_copy_only=False)[of] for c in batch.schema.names if c not in ("id", "terms", "counts")})
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                for b, (column, dense) in enumerate(blocks):
                    in_block = np.flatnonzero(column[own] >= 0)
                    left = np.zeros((batch.num_rows, len(dense)))
                    left[of[in_block], column[own[in_block]]] = value[in_block]
                    raw = (left @ dense).T
                    rounded = np.round(raw, 6)
                    rounded[(rounded if positive else raw) <= 0] = -np.inf
                    q = slice(b * COLUMN_BLOCK, b * COLUMN_BLOCK + len(raw))
                    scores = np.concatenate([best_score[q], rounded], 1)
                    names = np.concatenate([best_id[q], np.broadcast_to(ids, rounded.shape)], 1)
                    first = np.lexsort((names, -scores), axis=1)[:, :k]
                    best_score[q], best_id[q] = np.take_along_axis(scores, first, 1), np.take_along_axis(names, first, 1)
        q, place = np.nonzero(np.isfinite(best_score))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(best_id[q, place]), pa.array(best_score[q, place])], names=["q", "id", "score"])

    spark = found.sparkSession
    names = spark.createDataFrame(list(enumerate(asked.queries)), f"q long, `{query_col}` {kind}")
    top = ranked(found.mapInArrow(score, "q long, id long, score double"), "q", "id", k)
    return top.join(names, "q").select(query_col, F.col("id").alias(id_col), "score", "rank")


def bm25(blocks: DataFrame, queries: DataFrame, k: int, id_col: str, query_col: str, text_col: str = "text", query_text: str = "text", most: int = ASKED_TERMS) -> DataFrame:
    """(query, id, score, rank). Statistics are those of all blocks; terms that no query has go beside the scan. Ids are whole numbers."""
    own = query_terms(queries, query_col, query_text).withColumn("tf", F.lit(1))
    asked = asked_terms(own, query_col, most)
    if asked is None:
        return joined_bm25(blocks, queries, k, id_col, query_col, text_col, query_text)
    found = written(postings(blocks, asked, id_col, text_col, False), "postings")
    n, mean = found.agg(F.count("*"), F.avg("size")).first()
    df = document_frequency(found, len(asked.terms))
    idf = np.log((n - df + 0.5) / (df + 0.5))
    idf[idf <= 0] = 1e-6

    def part(terms: np.ndarray, counts: np.ndarray, other: dict) -> np.ndarray:
        return idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * other["size"] / mean))

    return best_rows(found, asked, np.ones(len(asked.term)), part, k, id_col, query_col, queries.schema[query_col].dataType.simpleString(), False)


def joined_bm25(blocks: DataFrame, queries: DataFrame, k: int, id_col: str, query_col: str, text_col: str = "text", query_text: str = "text") -> DataFrame:
    """As ``bm25``, for any number of query terms: they are joined with the blocks' terms.

    The queries' terms are written first, so that Spark knows their size and broadcasts them only if it allows.
    """
    asked = written(query_terms(queries, query_col, query_text), "query-terms")
    wanted = terms(blocks, id_col, text_col, asked.select("term").distinct())
    sizes = blocks.select(F.size(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit("([a-z0-9]+)"), 1)).alias("size"))
    totals = sizes.agg(F.count("*").alias("n"), F.avg("size").alias("mean"))
    return scored(wanted, totals, asked, k, id_col, query_col)


def scored(wanted: DataFrame, totals: DataFrame, asked: DataFrame, k: int, id_col: str, query_col: str) -> DataFrame:
    """BM25 of the asked terms over their postings; totals is one row."""
    df = wanted.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.when(idf > 0, idf).otherwise(F.lit(1e-6))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean"))
    each = wanted.join(df, "term").crossJoin(F.broadcast(totals)).select(id_col, "term", (weight * F.col("tf") * (K1 + 1) / norm).alias("part"))  # totals: one row
    scores = asked.join(each, "term").groupBy(query_col, id_col).agg(F.round(F.sum("part"), 6).alias("score"))
    return ranked(scores, query_col, id_col, k)


def grams(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf) over words of two letters and more, and pairs of neighbouring ones."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit("([a-z0-9_]{2,})"), 1)
    w = df.select(F.col(id_col), words.alias("w"))
    count = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("w", F.lit(1), count), F.slice("w", F.lit(2), count), lambda a, b: F.concat_ws(" ", a, b))
    return w.select(id_col, F.explode(F.concat("w", pairs)).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def gram_counter() -> Callable:
    """A function from texts to (row, term, tf, hash) of their ``grams``; equal terms have equal hashes everywhere. Tasks get it by value."""

    def count(texts: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray] | None:
        own = [re.findall(LONG_WORD, text) for text in texts]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        if not sizes.sum():
            return None
        coded = pa.array(chain.from_iterable(own), pa.string()).dictionary_encode()
        number, name, of = coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.repeat(np.arange(len(own)), sizes)
        hashes = np.fromiter((zlib.crc32(x.encode()) for x in name.to_pylist()), np.int64, len(name))
        follows = np.flatnonzero(of[1:] == of[:-1])
        pairs, pair = np.unique(number[follows] * len(name) + number[follows + 1], return_inverse=True)
        a, b = np.divmod(pairs, len(name))
        every = np.concatenate([number, pair + len(name)])
        names = pa.concat_arrays([name, pc.binary_join_element_wise(name.take(pa.array(a)), name.take(pa.array(b)), " ")])
        hashes = np.concatenate([hashes, (hashes[a] * 1_000_003 + hashes[b]) >> 7])
        found, tf = np.unique(np.concatenate([of, of[follows]]) * len(names) + every, return_counts=True)
        row, term = np.divmod(found, len(names))
        return row, names.take(pa.array(term)), tf, hashes[term]

    return count


def _texts(blocks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return blocks.select(F.col(id_col).cast("long").alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))


def all_grams(blocks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf) as ``grams``, counted beside the scan."""

    block_grams = gram_counter()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROW_BLOCK) for whole in batches for at in range(0, whole.num_rows, ROW_BLOCK)):
            found = block_grams(batch.column("text").to_pylist())
            if found:
                row, term, tf, _ = found
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), term, pa.array(tf, pa.int32())], names=["id", "term", "tf"])

    return _texts(blocks, id_col, text_col).mapInArrow(count, "id long, term string, tf int")


def tfidf_lengths(blocks: DataFrame, n: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, length) of the TF-IDF vectors. All terms travel once, to as many tasks as ``words`` words ask for, and are counted where they meet.

    They travel in blocks: a row holds those of some documents that go to one task, which holds what it gets, with a frequent
    term's rows. Beyond ``HELD_DOCUMENTS`` documents they travel one by one to a window, which spills.
    """
    parts = max(partitions_for(blocks.sparkSession), -(-2 * words // TERM_ROWS))
    if n > HELD_DOCUMENTS:
        each = all_grams(blocks, id_col, text_col).repartition(parts, "term")
        weight = (1 + F.log("tf")) * (F.log((1 + F.lit(n)) / (1 + F.count("*").over(Window.partitionBy("term")))) + 1)
        return each.select("id", F.pow(weight, 2).alias("square")).groupBy("id").agg(F.sqrt(F.sum("square")).alias("length"))

    block_grams, block = gram_counter(), 8 * ROW_BLOCK

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, block) for whole in batches for at in range(0, whole.num_rows, block)):
            found = block_grams(batch.column("text").to_pylist())
            if found:
                row, term, tf, hashes = found
                to = hashes % parts
                order = np.argsort(to, kind="stable")
                dealt = pa.RecordBatch.from_arrays([term, batch.column("id").take(pa.array(row)), pa.array(tf, pa.int32())], names=["term", "id", "tf"]).take(pa.array(order))
                used, starts = np.unique(to[order], return_index=True)
                sizes = np.diff(np.append(starts, len(order)))
                data = [dealt.slice(at, size).serialize().to_pybytes() for at, size in zip(starts.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], names=["task", "data"])

    schema = pa.schema({"term": pa.string(), "id": pa.int64(), "tf": pa.int32()})

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [pa.ipc.read_record_batch(pa.py_buffer(x), schema) for batch in batches for x in batch.column("data").to_pylist()]
        if blocks:
            got = pa.Table.from_batches(blocks)
            code = got.column("term").cast(pa.large_string()).combine_chunks().dictionary_encode().indices.to_numpy()
            idf = np.log((1 + n) / (1 + np.bincount(code))) + 1
            found, at = np.unique(got.column("id").to_numpy(), return_inverse=True)
            part = ((1 + np.log(got.column("tf").to_numpy())) * idf[code]) ** 2
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.bincount(at, part))], names=["id", "square"])

    squared = _texts(blocks, id_col, text_col).mapInArrow(deal, "task int, data binary").repartition(parts, "task").mapInArrow(squares, "id long, square double")
    return squared.groupBy("id").agg(F.sqrt(F.sum("square")).alias("length"))


def tfidf(blocks: DataFrame, queries: DataFrame, k: int, id_col: str, query_col: str, text_col: str = "text", query_text: str = "text", most: int = ASKED_TERMS) -> DataFrame:
    """(query, id, score, rank) by the cosine of sublinear, smoothed TF-IDF vectors; positive scores only. Ids are whole numbers."""
    asked = asked_terms(grams(queries, query_col, query_text), query_col, most)
    if asked is None:
        return joined_tfidf(blocks, queries, k, id_col, query_col, text_col, query_text)
    found = written(postings(blocks, asked, id_col, text_col, True), "postings")
    n, words = found.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    df = document_frequency(found, len(asked.terms))
    idf = np.where(df > 0, np.log((1 + n) / (1 + df)) + 1, 0.0)  # terms of no document count for nothing
    weights = (1 + np.log(asked.weight)) * idf[asked.term]
    length = np.sqrt(np.bincount(asked.row, weights * weights, len(asked.queries)))
    weights = weights / np.where(length > 0, length, 1)[asked.row]
    own = found.drop("size").join(tfidf_lengths(blocks, n, words, id_col, text_col), "id")

    def part(terms: np.ndarray, counts: np.ndarray, other: dict) -> np.ndarray:
        return (1 + np.log(counts)) * idf[terms] / other["length"]

    return best_rows(own, asked, weights, part, k, id_col, query_col, queries.schema[query_col].dataType.simpleString(), True)


def joined_tfidf(blocks: DataFrame, queries: DataFrame, k: int, id_col: str, query_col: str, text_col: str = "text", query_text: str = "text") -> DataFrame:
    """As ``tfidf``, for any number of query terms."""
    tf = written(all_grams(blocks, id_col, text_col).withColumnRenamed("id", id_col).withColumn("w", 1 + F.log("tf")), "terms")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = blocks.agg(F.count("*").alias("n"))
    idf = df.crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))  # n: one row
    weighted = tf.join(idf, "term").select(id_col, "term", (F.col("w") * F.col("idf")).alias("w"))
    lengths = weighted.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    asked = grams(queries, query_col, query_text).join(idf, "term").select(query_col, "term", ((1 + F.log("tf")) * F.col("idf")).alias("q"))
    asked_length = asked.groupBy(query_col).agg(F.sqrt(F.sum(F.col("q") * F.col("q"))).alias("q_length"))
    dots = asked.join(weighted, "term").groupBy(query_col, id_col).agg(F.sum(F.col("q") * F.col("w")).alias("dot"))
    scores = dots.join(lengths, id_col).join(asked_length, query_col).select(query_col, id_col, F.round(F.col("dot") / (F.col("length") * F.col("q_length")), 6).alias("score"))
    return ranked(scores.where("score > 0"), query_col, id_col, k)


def vector_search(vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """(query, id, score, rank): exact cosine of each query with every other vector, block against block.

    Vectors travel in blocks; a block of queries meets a block of vectors as one matrix
    product that keeps its k best, so what is shuffled grows with queries times blocks.
    """

    def blocked(df: DataFrame, size: int, name: str) -> DataFrame:
        slim = df.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<float>").alias("v"))

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, size):
                    own = batch.slice(at, size)
                    yield pa.RecordBatch.from_arrays([pa.array([own.column("i").to_pylist()], pa.list_(pa.int64())), pa.array([np.ascontiguousarray(own.column("v").flatten().to_numpy(zero_copy_only=False), np.float32).tobytes()], pa.binary())], names=[f"{name}_ids", f"{name}_data"])

        return slim.where("v is not null").mapInArrow(gather, f"{name}_ids array<long>, {name}_data binary")

    pairs = blocked(vectors, VECTOR_BLOCK, "v").crossJoin(blocked(queries, QUERY_BLOCK, "q"))
    few = COLUMN_BLOCK

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One pair of blocks at a time, and of that a few queries: a batch may hold many pairs.
        for batch in batches:
            for n in range(batch.num_rows):
                ids, qids = (batch.column(c)[n].values.to_numpy() for c in ("v_ids", "q_ids"))
                v, q = (np.frombuffer(batch.column(c)[n].as_buffer(), np.float32).reshape(len(i), -1).astype(np.float64) for c, i in (("v_data", ids), ("q_data", qids)))
                v, q = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) for x in (v, q))
                for at in range(0, len(qids), few):
                    own = qids[at : at + few]
                    score = np.round(q[at : at + few] @ v.T, 6)
                    score[own[:, None] == ids[None, :]] = -np.inf
                    best = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
                    rows = np.repeat(np.arange(len(own)), best.shape[1])
                    flat = best.ravel()
                    good = np.isfinite(score[rows, flat])
                    yield pa.RecordBatch.from_arrays([pa.array(own[rows[good]]), pa.array(ids[flat[good]]), pa.array(score[rows[good], flat[good]])], names=["query_id", "vec_id", "score"])

    return ranked(pairs.mapInArrow(products, "query_id long, vec_id long, score double"), "query_id", "vec_id", k)


def fused(lists: list[DataFrame], query_col: str, id_col: str) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists: (query, id, score)."""
    all_ranks = None
    for own in lists:
        part = own.select(query_col, id_col, (1.0 / (RANK_OFFSET + F.col("rank"))).alias("part"))
        all_ranks = part if all_ranks is None else all_ranks.unionByName(part)
    return all_ranks.groupBy(query_col, id_col).agg(F.round(F.sum("part"), 8).alias("score"))


def next_in_order(df: DataFrame, group_col: str, id_col: str) -> DataFrame:
    """(group, id, next): each row's next one by id within its group; the last of a group has none.

    Groups may be of any size: rows are range-partitioned by (group, id), and only the first and last row of each
    partition meet in one task.
    """
    spark = df.sparkSession
    slim = df.select(F.col(group_col).alias("g"), F.col(id_col).alias("i"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    schema = f"g {kinds['g']}, i {kinds['i']}, g2 {kinds['g']}, i2 {kinds['i']}, part int"

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch if last is None else pa.concat_batches([last, batch])
            head = head or batch.slice(0, 1)
            last = batch.slice(batch.num_rows - 1)
            a, b = own.slice(0, own.num_rows - 1), own.slice(1)
            yield pa.RecordBatch.from_arrays([*a.columns, *b.columns, pa.nulls(a.num_rows, pa.int32())], names=["g", "i", "g2", "i2", "part"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([*head.columns, *last.columns, pa.array([TaskContext.get().partitionId()], pa.int32())], names=["g", "i", "g2", "i2", "part"])

    dealt = slim.repartitionByRange(partitions_for(spark), "g", "i").sortWithinPartitions("g", "i")
    rows = written(dealt.mapInArrow(follow, schema), "in-order")
    # One row a partition: the last row of each is followed by the first of the next.
    w = Window.orderBy("part")
    edges = rows.where("part is not null").select(F.col("g2").alias("g"), F.col("i2").alias("i"), F.lead("g").over(w).alias("g2"), F.lead("i").over(w).alias("i2"))
    both = rows.where("part is null").drop("part").unionByName(edges)
    return both.select(F.col("g").alias(group_col), F.col("i").alias(id_col), F.when(F.col("g").eqNullSafe(F.col("g2")), F.col("i2")).alias("next"))


def neighbours(df: DataFrame, group_col: str, id_col: str) -> DataFrame:
    """(id, neighbour): the rows before and after each within its group."""
    pairs = next_in_order(df, group_col, id_col).where("next is not null")
    return pairs.select(id_col, F.col("next").alias("neighbour")).unionByName(pairs.select(F.col("next").alias(id_col), F.col(id_col).alias("neighbour")))


def with_neighbours(scores: DataFrame, neighbours: DataFrame, query_col: str, id_col: str) -> DataFrame:
    """Neighbours of the best ``SEEDS`` get a share of the seed's score as it then stands: an earlier seed's share
    counts for a later one. The steps are few and in order, so they are unrolled; each one's scores are written, as
    the next one reads them twice."""
    scores = written(scores, "scores")
    seeds = written(ranked(scores, query_col, id_col, SEEDS).select(query_col, F.col(id_col).alias("__seed"), F.col("rank").alias("__step")), "seeds")
    for step in range(1, SEEDS + 1):
        now = seeds.where(F.col("__step") == step).join(scores.withColumnRenamed(id_col, "__seed"), [query_col, "__seed"]).select(query_col, "__seed", F.col("score").alias("__score"))
        bonus = now.join(neighbours.withColumnsRenamed({id_col: "__seed", "neighbour": id_col}), "__seed").select(query_col, id_col, (NEIGHBOUR_SHARE * F.col("__score")).alias("score"))
        last, scores = scores, written(scores.unionByName(bonus).groupBy(query_col, id_col).agg(F.sum("score").alias("score")), "scores")
        drop(last)
    return scores.withColumn("score", F.round("score", 8))


def required_first(scores: DataFrame, query_col: str, id_col: str, required: str, k: int) -> DataFrame:
    """The k best, rows with a required type before all others."""
    w = Window.partitionBy(query_col).orderBy(F.desc(required), F.desc("score"), id_col)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def diversified(hits: DataFrame, pool: DataFrame, query_col: str, id_col: str, kind_col: str, k: int) -> DataFrame:
    """Each kind that the k hits lack takes the last place that no kind holds alone, by its best row of the pool.

    Both tables are (query, id, kind, score) with a bounded number of rows a query.
    """

    def swap(key, hits, pool):
        own = sorted(zip(-hits["score"], hits[id_col], hits[kind_col], strict=True))[:k]
        have = {x[2] for x in own}
        for kind in sorted(set(pool[kind_col]) - have):
            best = min(zip(-pool.loc[pool[kind_col] == kind, "score"], pool.loc[pool[kind_col] == kind, id_col], strict=True))
            counts = {}
            for x in own:
                counts[x[2]] = counts.get(x[2], 0) + 1
            spare = [j for j, x in enumerate(own) if counts[x[2]] > 1]
            if spare:
                own[spare[-1]] = (best[0], best[1], kind)
        import pandas as pd

        return pd.DataFrame([(key[0], x[1], x[2], -x[0], j + 1) for j, x in enumerate(own)], columns=[query_col, id_col, kind_col, "score", "rank"])

    kinds = {f.name: f.dataType.simpleString() for f in hits.schema}
    schema = f"{query_col} {kinds[query_col]}, {id_col} {kinds[id_col]}, {kind_col} {kinds[kind_col]}, score double, rank int"
    best = Window.partitionBy(query_col, kind_col).orderBy(F.desc("score"), id_col)
    pool = pool.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").select(*(F.col(c).alias(c) for c in pool.columns))
    return hits.groupBy(query_col).cogroup(pool.groupBy(query_col)).applyInPandas(swap, schema)


def gate(hits: DataFrame, query_col: str, least: int = 2) -> DataFrame:
    """Per query: whether its packet (id, paper, expected paper, text digest) may be used, and why not."""
    per = hits.groupBy(query_col).agg(F.count("*").alias("n"), F.count_if(F.col("paper") != F.col("expected_paper")).alias("foreign"), (F.count("*") - F.countDistinct("digest")).alias("repeated"))
    reasons = F.array_compact(F.array(F.when(F.col("n") < least, F.lit("too_few_hits")), F.when(F.col("foreign") > 0, F.lit("foreign_paper")), F.when(F.col("repeated") > 0, F.lit("repeated_block"))))
    return per.select(query_col, F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("usable"))


def write_index(blocks: DataFrame, path: str, id_col: str, text_col: str = "text") -> None:
    """The tables that BM25 needs: postings sorted by term, so that a query reads few row groups, and totals."""
    tf = terms(blocks, id_col, text_col)
    tf.repartitionByRange("term").sortWithinPartitions("term", id_col).write.mode("errorifexists").parquet(f"{path}/postings")
    sizes = blocks.select(F.size(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit("([a-z0-9]+)"), 1)).alias("size"))
    sizes.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).write.mode("errorifexists").parquet(f"{path}/totals")


def indexed_bm25(spark, path: str, queries: DataFrame, k: int, id_col: str, query_col: str, query_text: str = "text") -> DataFrame:
    """As ``bm25``, from a written index."""
    asked = query_terms(queries, query_col, query_text)
    wanted = spark.read.parquet(f"{path}/postings").join(asked.select("term").distinct(), "term", "left_semi")
    return scored(wanted, spark.read.parquet(f"{path}/totals"), asked, k, id_col, query_col)
