"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads bytes in both directions, gives every position a probability for each
language, and a document's are the mean over all its positions. It is trained in numpy by
backpropagation through time on a bounded sample: at most ``LANG_DOCS`` documents of each
language, fewer where languages are so many that this makes over ``TRAIN_DOCS`` in all, and
``DOC_WINDOWS`` windows of each from anywhere in the text. Every language is learned.

Documents are read whole, many side by side. A long one is read in stretches: its forward
state is carried from one to the next, and the backward pass of a stretch begins ``OVERLAP``
bytes behind its end, or at the end of the text if that comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, sliced, text_of
from tessera.llm.quality import fold

HIDDEN, TRAIN_WINDOW = 8, 64
LANG_DOCS, TRAIN_DOCS, DOC_WINDOWS = 400, 80_000, 3
MOST_LANGS = 20_000
SPARE = 4
STEPS, BATCH, RATE = 260, 160, 0.02
FOLDS, HELD_OUT = 4, 2
STRETCH, OVERLAP = 2048, 256
POSITIONS, LOGITS = 1 << 19, 1 << 19  # of a stretch of all documents side by side, whose states are held; of probabilities held at once
ROWS, BYTES = 16_384, 32 << 20  # of documents that are read together


def has_letter(text: str) -> bool:
    """Whether a character is of a letter category (Lu, Ll, Lt, Lm, Lo), as the sample's ``\\p{L}`` has it."""
    return any(map(str.isalpha, text))


def gates(hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One direction: what each byte and the state before add to update gate, reset gate and candidate."""
    return {"x": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32), "h": rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32), "b": np.zeros(3 * hidden, np.float32)}


def run_direction(p: dict, codes: np.ndarray, active: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each position, for columns of ``codes`` sorted by falling length; ``active`` columns go on at each step."""
    steps, wide = codes.shape
    size = p["h"].shape[0]
    states = np.zeros((steps, wide, size), np.float32)
    table = p["x"] + p["b"]
    h = np.zeros((wide, size), np.float32)
    for t in range(steps):
        n = active[t]
        if not n:
            break
        h = h[:n]
        x, u = table[codes[t, :n]], h @ p["h"]
        zr = 0.5 * np.tanh(0.5 * (x[:, : 2 * size] + u[:, : 2 * size])) + 0.5
        z, r = zr[:, :size], zr[:, size:]
        new = np.tanh(x[:, 2 * size :] + r * u[:, 2 * size :])
        if trace is not None:
            trace.append((h, z, r, u[:, 2 * size :], new))
        h = new + z * (h - new)
        states[t, :n] = h
    return states


def back_direction(p: dict, codes: np.ndarray, trace: list, grown: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of one direction from those of its states, back through time. All columns are full."""
    steps, wide, size = grown.shape
    out = {k: np.zeros_like(v) for k, v in p.items()}
    dh = np.zeros((wide, size), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, un, new = trace[t]
        dh = dh + grown[t]
        dn = dh * (1 - z) * (1 - new * new)
        dz = dh * (h - new) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        dx = np.concatenate([dz, dr, dn], 1)
        du = np.concatenate([dz, dr, dn * r], 1)
        np.add.at(out["x"], codes[t], dx)
        out["b"] += dx.sum(0)
        out["h"] += h.T @ du
        dh = dh * z + du @ p["h"].T
    return out


class Network:
    """Two directions and an output layer over the classes."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.ahead, self.back = gates(hidden, rng), gates(hidden, rng)
        self.out = {"w": rng.normal(0, 0.3, (2 * hidden, len(classes))).astype(np.float32), "b": np.zeros(len(classes), np.float32)}

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 4) -> Network:
        """``windows`` (examples, positions) of bytes; each position is to carry its window's label. Adam, falling rate."""
        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=len(self.classes)).clip(1)
        weight = (len(labels) / len(self.classes) / share).astype(np.float32)
        parts = [self.ahead, self.back, self.out]
        means = [{k: np.zeros_like(v) for k, v in p.items()} for p in parts]
        squares = [{k: np.zeros_like(v) for k, v in p.items()} for p in parts]
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(labels), batch)
            codes, wanted = np.ascontiguousarray(windows[chosen].T), labels[chosen]
            turned = codes[::-1]
            full = np.full(len(codes), batch)
            ahead_trace, back_trace = [], []
            a = run_direction(self.ahead, codes, full, ahead_trace)
            b = run_direction(self.back, turned, full, back_trace)[::-1]
            both = np.concatenate([a, b], 2)
            p = softmax(both @ self.out["w"] + self.out["b"])
            p[:, np.arange(batch), wanted] -= 1
            p *= (weight[wanted] / (batch * len(codes)))[None, :, None]
            grown = p @ self.out["w"].T
            size = a.shape[2]
            grads = [back_direction(self.ahead, codes, ahead_trace, grown[:, :, :size]), back_direction(self.back, turned, back_trace, grown[::-1, :, size:]), {"w": np.einsum("tbh,tbc->hc", both, p), "b": p.sum((0, 1))}]
            now = rate * min(1.0, 2 * (1 - (step - 1) / steps)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for part, mean, square, grad in zip(parts, means, squares, grads, strict=True):
                for k in part:
                    mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
                    square[k] = 0.999 * square[k] + 0.001 * grad[k] ** 2
                    part[k] -= (now * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
        return self

    def stretch_sums(self, codes: np.ndarray, active: np.ndarray, ahead: np.ndarray) -> np.ndarray:
        """Per document, the probabilities summed over the positions of a stretch of it.

        ``codes`` (positions, documents) reach ``OVERLAP`` beyond the stretch; the first ``active[t]`` documents have
        position t. ``ahead`` is the forward state, which is moved to the stretch's end.
        """
        steps, wide = min(STRETCH, len(codes)), codes.shape[1]
        size = ahead.shape[1]
        a, b = np.zeros((2, steps, wide, size), np.float32)
        own = Direction(self.ahead)
        for t in range(steps):
            n = active[t]
            ahead[:n] = a[t, :n] = own.moved(ahead[:n], codes[t, :n])
        own = Direction(self.back)
        back = np.zeros((wide, size), np.float32)
        for t in range(len(codes) - 1, -1, -1):
            n = active[t]
            back[:n] = own.moved(back[:n], codes[t, :n])
            if t < steps:
                b[t, :n] = back[:n]
        total = np.zeros((wide, len(self.classes)))
        most = np.abs(self.out["w"]).sum(0).max() + np.abs(self.out["b"]).max()  # of a logit, as states are within one of zero
        one = np.ones((len(self.classes), 1), np.float32)
        together = max(1, LOGITS // (wide * len(self.classes)))
        for t in range(0, steps, together):
            part = slice(t, min(steps, t + together))
            p = a[part].reshape(-1, size) @ self.out["w"][:size]
            p += b[part].reshape(-1, size) @ self.out["w"][size:]
            p += self.out["b"]
            if most > 40:
                p -= p.max(1, keepdims=True)
            np.exp(p, out=p)
            p *= (np.arange(wide)[None, :] < active[part, None]).reshape(-1, 1) / (p @ one)
            total += p.reshape(-1, wide, len(self.classes)).sum(0)
        return total

    def probabilities(self, raws: list[bytes]) -> np.ndarray:
        """Mean class probabilities of each non-empty byte string."""
        sizes = np.array([len(x) for x in raws], np.int64)
        order = np.argsort(-sizes, kind="stable")
        total = np.zeros((len(raws), len(self.classes)))
        at = 0
        while at < len(order) and sizes[order[at]]:
            own = order[at : at + max(1, POSITIONS // min(STRETCH, int(sizes[order[at]])))]
            at += len(own)
            ahead = np.zeros((len(own), self.ahead["h"].shape[0]), np.float32)
            for s in range(0, int(sizes[own[0]]), STRETCH):
                own = own[: int((sizes[own] > s).sum())]
                ahead = ahead[: len(own)]
                steps = min(STRETCH + OVERLAP, int(sizes[own[0]]) - s)
                codes = np.frombuffer(b"".join(raws[d][s : s + steps].ljust(steps, b"\0") for d in own), np.uint8).reshape(len(own), steps).T
                active = (sizes[own][None, :] > s + np.arange(steps)[:, None]).sum(1)
                total[own] += self.stretch_sums(np.ascontiguousarray(codes), active, ahead)
        return total / np.maximum(sizes, 1)[:, None]


class Direction:
    """One direction's weights for reading: with the gates' parts halved, as a logistic is half of one and a tanh of the half."""

    def __init__(self, p: dict):
        size = p["h"].shape[0]
        table = p["x"] + p["b"]
        self.gates, self.new = np.ascontiguousarray(table[:, : 2 * size] / 2), np.ascontiguousarray(table[:, 2 * size :])
        self.to_gates, self.to_new = np.ascontiguousarray(p["h"][:, : 2 * size] / 2), np.ascontiguousarray(p["h"][:, 2 * size :] / 2)

    def moved(self, h: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after one more byte."""
        gates = self.gates.take(codes, 0)
        gates += h @ self.to_gates
        np.tanh(gates, out=gates)
        gates += 1
        new = h @ self.to_new
        new *= gates[:, h.shape[1] :]
        new += self.new.take(codes, 0)
        np.tanh(new, out=new)
        kept = h - new
        kept *= gates[:, : h.shape[1]]
        kept *= 0.5
        kept += new
        return kept


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(-1, keepdims=True)
    return x


def per_language(langs: int) -> int:
    """Documents to learn from of each language."""
    return max(1, min(LANG_DOCS, TRAIN_DOCS // max(1, langs)))


def training_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, byte windows and language numbers, from documents outside the held-out fold, chosen by a hash of id and text.

    Rows with one id and one text are one document. Null ids and texts without letters are not learned from. More
    languages than ``MOST_LANGS`` are an error.
    """
    spark = df.sparkSession
    version = F.xxhash64(text_of(text_col))
    usable = F.col(lang_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT) & F.col(text_col).rlike(r"\p{L}")
    known = df.where(usable).select(F.col(id_col).cast("string").alias("__id"), version.alias("__version"), F.col(lang_col).cast("string").alias("__lang"), text_of(text_col).cast("binary").alias("__raw"))
    counts = known.groupBy("__lang").count().limit(MOST_LANGS + 1).collect()
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    classes = sorted(r["__lang"] for r in counts)
    docs = per_language(len(classes))
    if not classes:
        return [], np.zeros((0, TRAIN_WINDOW), np.uint8), np.zeros(0, np.int64)
    # A share of each language by hash, of some times the documents needed, then the first of them: one scan for all
    # languages, and no language's rows meet in one task.
    shares = spark.createDataFrame([(r["__lang"], min(1.0, SPARE * docs / r["count"])) for r in counts], "__lang string, __share double")
    order = F.xxhash64("__id", "__version", F.lit(11))
    # ``MOST_LANGS`` rows at most are broadcast.
    pool = known.join(F.broadcast(shares), "__lang").where(F.pmod(order, F.lit(1 << 30)) < F.col("__share") * (1 << 30))
    one = pool.select("__lang", "__id", "__version").distinct()
    first = F.row_number().over(Window.partitionBy("__lang").orderBy(order, "__id", "__version"))
    chosen = one.withColumn("__k", first).where(F.col("__k") <= docs).drop("__k")
    start = F.pmod(F.xxhash64("__id", "__k"), F.greatest(F.octet_length("__raw") - TRAIN_WINDOW, F.lit(0)) + 1).cast("int") + 1
    # At most ``TRAIN_DOCS`` rows, or one a language, are broadcast.
    picked = known.join(F.broadcast(chosen), ["__lang", "__id", "__version"], "left_semi").select("__lang", "__id", "__raw", F.explode(F.sequence(F.lit(1), F.lit(DOC_WINDOWS))).alias("__k"))
    rows = picked.select(F.col("__id").alias("i"), F.col("__k").alias("k"), F.col("__lang").alias("l"), F.substring("__raw", start, F.lit(TRAIN_WINDOW)).alias("w")).distinct().collect()
    found = sorted((r["i"], r["k"], r["l"], bytes(r["w"])) for r in rows)
    number = {c: k for k, c in enumerate(classes)}
    windows = [(x * (TRAIN_WINDOW // len(x) + 1))[:TRAIN_WINDOW] for *_, x in found]  # a short text is repeated to fill its window
    return classes, np.frombuffer(b"".join(windows), np.uint8).reshape(-1, TRAIN_WINDOW), np.array([number[x[2]] for x in found], np.int64)


def trained(df: DataFrame, **columns) -> Network | None:
    """A network from the training sample, or none if no document can be learned from."""
    classes, windows, labels = training_windows(df, **columns)
    return Network(classes).train(windows, labels) if len(labels) else None


def predict(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, a row per input row.

    A text without letters, null and empty ones included, is ``und`` with score 0, and so is
    every text if there is no network. A null id is not held out. Texts are read whole, however
    long; of equal probabilities the first language by name counts. Repeated rows give a row
    each, an empty table gives none, and other columns are left out.
    """

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS, BYTES):
            texts = batch.column("text").to_pylist()
            own = [k for k, x in enumerate(texts) if network and has_letter(x)]
            names, score = ["und"] * len(texts), np.zeros(len(texts))
            if own:
                p = network.probabilities([texts[k].encode("utf-8", "replace") for k in own])
                score[own] = p.max(1).clip(0, 1)
                for k, c in zip(own, p.argmax(1), strict=True):
                    names[k] = network.classes[c]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    found = slim.mapInArrow(named, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, trained(docs))
