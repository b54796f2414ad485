"""Toxicity: misspelled lexicon terms by Levenshtein automata, judged by the words around them.

The lexicon is learned: stems whose hits a toxic training document are far above those of clean ones, counted over
documents that are no copies of each other. It is a trie. Each distinct word of a text becomes a Levenshtein automaton that
walks the trie in step, so only branches that can still match are entered; words without any piece of a term that its
edits must leave whole are not walked. A stem matches the beginning of a word. A stem loses the
misspellings that clean training documents show as words of their own. A hit is then read in its window: quotation marks
and words of reporting make it a mention, words of address and other hits make it abuse. A logistic layer on the hits of each
kind and their density, trained by gradient descent towards stated priors, gives the score. Training reads a bounded sample
(``TRAIN_DOCS`` whole texts a class, of at most ``TRAIN_CHARS`` characters); every text is scored whole.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, documents, sliced
from tessera.llm.quality import FOLDS, HELD_OUT, fold, training_sample

TRAIN_DOCS, TRAIN_CHARS = 2000, 50_000
LEAST_EVIDENCE = 24.0  # log-likelihood ratio of a term; above what chance gives the best of 100,000 stems
LEAST_ODDS = 1.8  # log-odds of a term's hits in toxic and clean documents
MISSPELLED_ODDS = 3.0  # a term in toxic against its misspelling in clean documents; below, that misspelling is another word
MOST_HITS = 4  # of a term that one training document counts
STEMS = (3, 12)  # letters of a term
SUFFIX = 3  # letters that may follow a misspelled stem
WINDOW = 6
EDITS = ((8, 2), (4, 1))  # letters of a term, misspellings allowed
CACHE_WORDS = 300_000
FEATURES = ("abuse", "misspelled", "mentioned", "addressed", "density")
PRIOR, PRIOR_WEIGHT = np.array([2.0, 1.5, 0.2, 0.2, 1.0, -4.0]), 0.02  # weights of the features, then the bias
STEPS, RATE = 2000, 0.3

LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})
OPENING, CLOSING = "\"'`“‘«„‹", "\"'`”’»“‘›"
REPORTING = frozenset("said says say saying called calls calling word words term terms quote quotes quoted quoting wrote writes written slur slurs insult insults phrase meaning means definition palabra dijo término mot terme dit wort wörter sagte begriff".split())
ADDRESS = frozenset("you your yours you're youre ur u are tu te ton ta tes vous votre es du dich dein deine bist ihr euch tú eres ustedes sois".split())
EDGES = ".,;:!?\"'`´“”‘’«»„‹›()[]{}<>*#%&$@+=~^_-/|\\…–—"
PARTS = re.compile(r"[^\w@$!|]+|_+")
RUNS = re.compile(r"(.)\1{2,}")


def spellings(raw: str) -> list[str]:
    """The words of a token as the lexicon spells them: lower case, look-alike signs as letters, long runs as one letter."""
    word = raw.strip(EDGES)
    if not word.isascii():
        word = unicodedata.normalize("NFKC", word)
    if word.isalpha():
        word = word.lower()
        return [RUNS.sub(r"\1", word) if RUNS.search(word) else word] if word else []
    found = []
    for part in PARTS.split(word):
        part = part.lower().strip(EDGES)
        if any(map(str.isalpha, part)):
            found.append(RUNS.sub(r"\1", part.translate(LETTERS)))
    return found


def allowed(length: int) -> int:
    """Misspellings that a term of so many letters may have."""
    return next((edits for least, edits in EDITS if length >= least), 0)


class Trie:
    """Terms by letter; each node knows its term and how many edits a term below it allows."""

    def __init__(self, terms: list[str], edits: list[int] | None = None):
        self.terms, self.edits = terms, [allowed(len(t)) for t in terms] if edits is None else edits
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.most: list[int] = [max(self.edits, default=0)]
        for k, term in enumerate(terms):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], self.edits[k])
            self.term[node] = k
        self.pieces = ahocorasick.Automaton()
        for term, e in zip(terms, self.edits, strict=True):
            for piece in whole_pieces(term, e):
                self.pieces.add_word(piece, True)
        if terms:
            self.pieces.make_automaton()

    def near(self, word: str) -> list[tuple[int, int]]:
        """(term, edits) of every term that begins the word within the edits that it allows, by the word's automaton.

        Edits are insertions, deletions and substitutions of a letter; a swap of neighbours that is the only edit counts as one. A
        misspelled term may be followed by ``SUFFIX`` letters, an exact one by any. A state set is an integer an edit count: bit
        i says that i letters of the word are read.
        """
        if not self.terms or next(self.pieces.iter(word), None) is None:
            return []
        size = len(word)
        full, ends = (1 << size + 1) - 1, -1 << max(0, size - SUFFIX)
        at: dict[str, int] = {}
        for i, letter in enumerate(word):
            at[letter] = at.get(letter, 0) | 1 << i
        found = []
        stack = [(0, [(1 << e + 1) - 1 & full for e in range(self.most[0] + 1)], 0, 0)]
        while stack:
            node, states, swapped, half = stack.pop()
            k = self.term[node]
            if k >= 0:
                if states[0]:
                    found.append((k, 0))
                elif self.edits[k] and (states[1] | swapped) & ends:
                    found.append((k, 1))
                elif self.edits[k] > 1 and states[2] & ends:
                    found.append((k, 2))
            for letter, child in self.children[node].items():
                here = at.get(letter, 0)
                now = [(states[0] & here) << 1]
                for e in range(1, self.most[child] + 1):
                    now.append(((states[e] & here) << 1 | states[e - 1] | states[e - 1] << 1 | now[e - 1] << 1) & full)
                after = ((swapped & here) << 1 | (half & here) << 2) if self.most[child] else 0
                pending = states[0] & here >> 1 if self.most[child] else 0
                if any(now) or after or pending:
                    stack.append((child, now, after, pending))
        return found


def whole_pieces(term: str, edits: int) -> set[str]:
    """Pieces of which every word within the edits has one: cut in one more piece than edits, one stays whole; a swap across the only cut is a piece."""
    cuts = [len(term) * k // (edits + 1) for k in range(edits + 2)]
    found = {term[a:b] for a, b in zip(cuts, cuts[1:], strict=False)}
    if edits == 1:
        c = cuts[1]
        found.add(term[: c - 1] + term[c] + term[c - 1] + term[c + 1 :])
    return found


def stem_counts(texts: list[str]) -> tuple[int, Counter, Counter, Counter]:
    """Number of documents, each stem's hits (``MOST_HITS`` a document at most) and documents, and each word's documents; near copies are one document."""
    hits: Counter = Counter()
    docs: Counter = Counter()
    words: Counter = Counter()
    known: dict[str, list[str]] = {}
    signatures, n = set(), 0
    for text in texts:
        tokens = text.split()
        raw = Counter(tokens)
        signature = tuple(sorted({zlib.crc32(" ".join(x).encode("utf-8", "replace")) for x in zip(tokens, tokens[1:], tokens[2:], strict=False)})[:3]) if len(tokens) > 4 else text
        if signature in signatures:
            continue
        signatures.add(signature)
        n += 1
        stems: Counter = Counter()
        own = set()
        for token, count in raw.items():
            if token not in known:
                known[token] = spellings(token)
            for word in known[token]:
                own.add(word)
                for k in range(STEMS[0], min(len(word), STEMS[1]) + 1):
                    stems[word[:k]] += count
        words.update(own)
        docs.update(stems.keys())
        hits.update({s: min(c, MOST_HITS) for s, c in stems.items()})
    return n, hits, docs, words


def evidence(a: int, m: int, c: int, n: int) -> float:
    """Twice the log-likelihood ratio of a in m against c in n, to both at one rate."""
    rate = (a + c) / (m + n)
    return 2 * (a * np.log(a / (rate * m)) + (c * np.log(c / (rate * n)) if c else 0.0))


def learned_terms(toxic: list[str], clean: list[str]) -> tuple[list[str], list[int]]:
    """Stems that mark toxic documents, strongest first, and the misspellings that each allows."""
    if not toxic or not clean:
        return [], []
    (m, hits, docs, _), (n, clean_hits, clean_docs, clean_words) = stem_counts(toxic), stem_counts(clean)
    found = []
    for stem, a in docs.items():
        odds = np.log((hits[stem] + 0.5) / (m + 1)) - np.log((clean_hits[stem] + 0.5) / (n + 1))
        if a < 2 or odds < LEAST_ODDS or not stem.isalpha():
            continue
        if evidence(a, m, clean_docs[stem], n) >= LEAST_EVIDENCE:
            found.append((-round(evidence(hits[stem], m, clean_hits[stem], n), 6), -len(stem), stem))
    terms: list[str] = []
    for _, _, stem in sorted(found):
        if not any(stem.startswith(t) or t.startswith(stem) for t in terms):
            terms.append(stem)
    trie = Trie(terms)
    other: Counter = Counter()
    for word, count in clean_words.items():
        for k, edits in trie.near(word):
            other[k, edits] += count
    edits = []
    for k, term in enumerate(terms):
        limit = np.exp(-MISSPELLED_ODDS) * docs[term] / m
        edits.append(next((e - 1 for e in range(1, trie.edits[k] + 1) if other[k, e] / n > limit), trie.edits[k]))
    return terms, edits


class Model:
    """A trie of terms and the weights of the features and the bias."""

    def __init__(self, terms: list[str], edits: list[int] | None = None, weights: np.ndarray = PRIOR):
        self.terms, self.edits, self.weights = terms, edits, np.array(weights, float)
        self.trie, self.cache = Trie(terms, edits), {}
        self.key = zlib.crc32(repr((terms, edits, self.weights.tolist())).encode())

    def __reduce__(self) -> tuple:
        return Model, (self.terms, self.edits, self.weights)

    def nearest(self, raw: str) -> int:
        """0 if no term is near the token, else 1 + the least number of edits."""
        return min((edits + 1 for word in spellings(raw) for _, edits in self.trie.near(word)), default=0)

    def hits(self, text: str) -> tuple[list[str], list[tuple[int, int]]]:
        """The text's tokens, and (place, edits) of those near a term."""
        words, cache = text.split(), self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = self.nearest(w)
        return words, [(k, near - 1) for k, near in enumerate(map(cache.__getitem__, words)) if near]

    def features(self, text: str) -> np.ndarray:
        """The logarithm of one plus the number of hits of each kind, the hits that are no mentions to the hundred words, and 1."""
        words, hits = self.hits(text)
        abuse = misspelled = mentioned = addressed = 0
        places = [k for k, _ in hits]
        for n, (k, edits) in enumerate(hits):
            if quoted(words, k):
                mentioned += 1
                continue
            around = {w.strip(EDGES).lower() for w in words[max(0, k - WINDOW) : k] + words[k + 1 : k + 1 + WINDOW]}
            close = (n and k - places[n - 1] <= WINDOW) or (n + 1 < len(places) and places[n + 1] - k <= WINDOW)
            directed = bool(close) or not ADDRESS.isdisjoint(around)
            if not directed and not REPORTING.isdisjoint(around):
                mentioned += 1
                continue
            abuse, misspelled, addressed = abuse + (not edits), misspelled + bool(edits), addressed + directed
        density = 100 * (abuse + misspelled) / (len(words) + 50)
        return np.array([*np.log1p([abuse, misspelled, mentioned, addressed]), min(density, 3.0), 1.0])

    def train(self, toxic: list[str], clean: list[str]) -> Model:
        """Gradient descent on the logistic loss, pulled to the prior."""
        x = np.array([self.features(t) for t in [*toxic, *clean]]).reshape(-1, len(PRIOR))
        y = np.array([1.0] * len(toxic) + [0.0] * len(clean))
        weights = PRIOR.copy()
        for _ in range(STEPS if len(y) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
            weights -= RATE * (x.T @ (p - y) / len(y) + PRIOR_WEIGHT * (weights - PRIOR) / np.sqrt(len(y)))
        return Model(self.terms, self.edits, weights)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -50, 50))))


def quoted(words: list[str], k: int) -> bool:
    """Whether quotation marks open at or before the token, and close at or after it, within the window."""
    if words[k][:1] in OPENING:
        opened = k
    else:
        opened = next((j for j in range(k - 1, max(-1, k - WINDOW - 1), -1) if words[j][:1] in OPENING or words[j].rstrip(".,;:!?")[-1:] in CLOSING), None)
        if opened is None or words[opened][:1] not in OPENING or (len(words[opened]) > 1 and words[opened].rstrip(".,;:!?")[-1:] in CLOSING):
            return False
    return any(len(w) > (j == opened) and w.rstrip(".,;:!?")[-1:] and w.rstrip(".,;:!?")[-1] in CLOSING for j, w in enumerate(words[k : k + WINDOW + 1], k))


def trained(df: DataFrame, labels: DataFrame, size: int = TRAIN_DOCS, chars: int = TRAIN_CHARS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from at most ``size`` labelled documents a class outside the held-out fold; without toxic or clean ones, it has no terms."""
    classes = [training_sample(df, labels.where(F.col(label_col) == k), size, chars, id_col, text_col, label_col)[0] for k in (1, 0)]
    return Model(*learned_terms(*classes)).train(*classes)


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts get the bias's probability. A null id is not held out. Repeated rows are scored alike, texts are scored
    whole, however long, and an empty table gives no rows.
    """
    bounded_batches(df.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _worker.setdefault(model.key, model)
        for batch in sliced(batches):
            made = [own.score(x or "") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.float64())], names=["doc_id", "score"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = slim.mapInArrow(scored, "doc_id long, score double")
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


_worker: dict[int, Model] = {}  # the model of this Python worker, with its cache of words


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
