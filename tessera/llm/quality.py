"""Quality classifier on subword vectors, trained by numpy stochastic gradient descent.

A document is the average of the vectors of its hashed words and their character n-grams, a
softmax layer turns that into a probability. A word that comes n times weighs 1 + log n times
as much as one that comes once, while the divisor counts every occurrence, so repetition moves
a document towards the bias; a linear average could not tell it from other text.
Training sees a bounded sample of labelled documents (``TRAIN_DOCS`` whole texts of at most
``TRAIN_CHARS`` characters); every document is scored whole. Average and output layer are
linear, so scoring needs one number a bucket instead of a vector, and one complex number
(sum, count) for each cached word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, documents, sliced

BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 17, 8, 8, 0.5
GRAMS = (3, 4)
TRAIN_DOCS, TRAIN_CHARS = 2000, 50_000
FOLDS, HELD_OUT = 3, 1
CACHE_WORDS, CACHE_CHARS = 400_000, 48


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's digits, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def features(word: str, buckets: int) -> list[int]:
    """Buckets of a word and of its character n-grams, with marks at both ends."""
    crc, edged = zlib.crc32, f"<{word}>"
    found = [crc(word.encode("utf-8", "replace")) % buckets]
    for n in GRAMS:
        found += [crc(edged[k : k + n].encode("utf-8", "replace"), n) % buckets for k in range(len(edged) - n + 1)]
    return found


def weights_of(counts: np.ndarray) -> np.ndarray:
    """How much a word weighs by its number of occurrences."""
    return 1 + np.log(counts)


class Model:
    """Vectors, output layer and bias for two classes."""

    def __init__(self, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (buckets, dimensions))
        self.output = np.zeros((dimensions, 2))
        self.bias = np.zeros(2)

    def train(self, texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 2) -> Model:
        """Gradient descent, one document at a time, with a rate that falls to zero."""
        cache: dict[str, np.ndarray] = {}
        examples = []
        for text, label in zip(texts, labels, strict=True):
            counts = Counter(text.split())
            if not counts:
                continue
            for w in set(counts).difference(cache):
                cache[w] = np.array(features(w, len(self.vectors)), np.int32)
            times, sizes = np.fromiter(counts.values(), float), np.array([len(cache[w]) for w in counts])
            own, place = np.unique(np.concatenate([cache[w] for w in counts]), return_inverse=True)
            weight = np.bincount(place, np.repeat(weights_of(times), sizes)) / (times @ sizes)
            examples.append((own, weight.astype(np.float32), label))
        del cache
        if not examples:
            return self
        share = np.bincount([y for _, _, y in examples], minlength=2) / len(examples)
        self.bias = np.log(np.maximum(share, 1e-3))
        rng, step, total = np.random.default_rng(seed), 0, epochs * len(examples)
        for _ in range(epochs):
            for k in rng.permutation(len(examples)):
                own, weight, label = examples[k]
                hidden = weight @ self.vectors[own]
                logits = hidden @ self.output + self.bias
                wrong = np.exp(logits - logits.max())
                wrong /= wrong.sum()
                wrong[label] -= 1
                now = rate * (1 - step / total)
                back = self.output @ wrong
                self.output -= now * np.outer(hidden, wrong)
                self.bias -= now * wrong
                self.vectors[own] -= now * weight[:, None] * back * 20  # most documents share few features
                step += 1
        return self

    def collapsed(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log-odds of label 1, and the bias."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0]), float(self.bias[1] - self.bias[0])


_worker: dict = {}  # word sums of this Python worker, by model


def scores(texts: list[str], weights: np.ndarray, bias: float, key: int) -> list[float]:
    """The probability of label 1 for each whole text."""
    if _worker.get("key") != key:
        _worker.update(key=key, weights=weights.tolist(), words={})
    table, cache, buckets = _worker["weights"], _worker["words"], len(weights)
    out = []
    for text in texts:
        counts = Counter(text.split())
        long: dict[str, complex] = {}
        for w in set(counts).difference(cache):
            ids = features(w, buckets)
            (cache if len(w) <= CACHE_CHARS else long)[w] = complex(sum(map(table.__getitem__, ids)), len(ids))
        sums = np.array([long[w] if w in long else cache[w] for w in counts] if long else list(map(cache.__getitem__, counts)), complex)
        times = np.fromiter(counts.values(), float, len(counts))
        logit = bias + (float(weights_of(times) @ sums.real) / float(times @ sums.imag) if counts else 0.0)
        out.append(1 / (1 + np.exp(-min(max(logit, -500.0), 500.0))))
        if len(cache) > CACHE_WORDS:
            cache.clear()
    return out


def training_sample(df: DataFrame, labels: DataFrame, size: int = TRAIN_DOCS, chars: int = TRAIN_CHARS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[list[str], list[int]]:
    """At most ``size`` labelled documents of at most ``chars`` characters outside the held-out fold, chosen by a hash of id and text.

    Only labels that have such a document count. Repeated rows are one document; an id with
    both labels is learned with both.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & (fold(id_col, FOLDS) != HELD_OUT)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).distinct()
    short = df.where(F.length(text_col) <= chars).select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col).cast("string")).alias("__version"), F.col(text_col).cast("string").alias("__text"))
    order = [F.xxhash64("__id", "__version", F.lit(7)), F.col("__id"), F.col("__version"), F.col("__label")]
    chosen = short.select("__id", "__version").join(known, "__id").distinct().orderBy(*order).limit(size)
    # ``size`` rows of three numbers: a bounded broadcast. Its rows fetch their texts, one each.
    rows = short.join(F.broadcast(chosen), ["__id", "__version"]).distinct().orderBy(*order).limit(size).collect()
    return [r["__text"] for r in rows], [r["__label"] for r in rows]


def score_quality(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, or with ``keep`` all columns and ``score``.

    Null and empty texts get the bias's probability. A null id is not held out. Repeated
    rows are scored alike, texts are scored whole, however long, and an empty table gives no rows.
    """
    bounded_batches(df.sparkSession)
    weights, bias = model.collapsed()
    weights = weights.astype(np.float32)
    key = zlib.crc32(weights.tobytes())
    slim = df.withColumn("score", F.lit(0.0)) if keep else df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias(text_col))
    schema = slim.schema if keep else "doc_id long, score double"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = pa.array(scores([x or "" for x in batch.column(text_col).to_pylist()], weights, bias, key), pa.float64())
            if keep:
                yield batch.set_column(batch.schema.get_field_index("score"), "score", made)
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], names=["doc_id", "score"])

    found = slim.mapInArrow(scored, schema)
    if keep:
        return found
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def trained(df: DataFrame, labels: DataFrame, **columns) -> Model:
    """A model from the training sample; with no sample, one that gives every text the same score."""
    return Model().train(*training_sample(df, labels, **columns))


def accepted(df: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with a score of at least ``least``, with their columns."""
    name = "score" if "score" not in df.columns else None
    own = df if name else df.withColumnRenamed("score", "__own_score")
    found = score_quality(own, trained(df, labels, id_col=id_col, text_col=text_col), id_col, text_col, keep=True).where(F.col("score") >= least).drop("score")
    return found if name else found.withColumnRenamed("__own_score", "score")


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
