"""Best-fit packing by linear grouping.

Only a histogram of lengths (one row a length, so ``capacity`` rows at most) reaches the
driver. The planner works on counts: large lengths are split into groups of equal
cardinality and rounded up to their group's largest, a linear programme over the few
sizes' configurations says how many sequences of each configuration to open, real lengths
take the slots, and the small lengths go best-fit into what is left. Its result, runs of
equal placements, has a size bounded by the number of lengths, not of documents. Documents
find their place by their rank among those of equal length; the ranks are counted over
(length, hash bucket), so that no length, however common, meets in one task.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, documents, partitions_for, sliced, text_of, written

CAPACITY = 2048
GROUPS = 24
LARGE_PARTS = 4  # lengths over capacity / LARGE_PARTS are large: fewer than LARGE_PARTS fit a sequence
TOKENIZER = "word_bpe_49k.json"
END = b"\0\0\0\0"  # id 0 after each document
CACHE_CHUNKS, CACHE_WORDS, CACHE_CHARS = 120_000, 200_000, 48
# Unicode white space as the tokenizer's normaliser has it; str.split() would also cut at the separators 1C to 1F.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")

# Chunks of ASCII and Latin-1 letters need no normaliser but lower-casing, and this is the tokenizer's own split of them.
PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
# The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_others = iter(range(256, 512))
BYTES = {k: chr(k if k in PRINTABLE else next(_others)) for k in range(256)}

_worker: dict = {}  # a Python worker's tokenizer and caches, by path


def little_endian(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


class Chunks:
    """Little-endian 32-bit ids of chunks between white space, kept for as many as fit a bound."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = {t.content: little_endian([k]) for k, t in self.whole.get_added_tokens_decoder().items()}  # matched as they stand, before the normaliser
        self.literal = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.model = self.whole.model
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        if word in self.words:
            return self.words[word]
        mapped = word if word.isascii() else "".join([BYTES[b] for b in word.encode()])
        found = self.words[word] = little_endian([t.id for t in self.model.tokenize(mapped)])
        return found

    def encode(self, chunk: str) -> bytes:
        if len(chunk) > CACHE_CHARS or not (chunk.isascii() and chunk.isprintable() or PLAIN.fullmatch(chunk)):
            return little_endian(self.whole.encode(chunk, add_special_tokens=False).ids)
        lower = chunk.lower()
        if lower.isalpha():
            return self.word(lower)
        if lower[:-1].isalpha() and not lower[-1].isalnum():  # a word and one mark
            return self.word(lower[:-1]) + self.word(lower[-1])
        return b"".join(map(self.word, PLAIN_WORDS.findall(lower)))

    def text(self, text: str) -> bytes:
        if any(map(text.__contains__, self.added)):
            return b"".join([self.added[part] if part in self.added else self.between(part) for part in self.literal.split(text)])
        return self.between(text)

    def between(self, text: str) -> bytes:
        """The ids of a text without the literal of an added token."""
        split = SPACES.split(text) if ODD_SPACE.search(text) else text.split()
        cache, long = self.chunks, {}
        for c in set(split).difference(cache):
            (cache if len(c) <= CACHE_CHARS else long)[c] = self.encode(c)
        out = b"".join([long[c] if c in long else cache[c] for c in split]) if long else b"".join(map(cache.__getitem__, split))
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        return out


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Little-endian 32-bit ids of each text.

    The tokenizer's words never span white space and its normaliser works within it, so
    equal chunks between white space have equal ids, and each is encoded once. The literal of
    an added token is cut out first, wherever it stands, as the tokenizer does.
    """
    if path not in _worker:
        _worker[path] = Chunks(path)
    return list(map(_worker[path].text, texts))


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (little-endian 32-bit).

    A null or empty text is the end id alone. Ids may be null or repeated.
    """
    bounded_batches(df.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows, ids = [], batch.column("doc_id").to_pylist()
            for doc, data in zip(ids, token_bytes(batch.column("text").to_pylist(), tokenizer_path), strict=True):
                data += END
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own), own))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)][: len(names)], names=names)

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return slim.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def configurations(sizes: list[int], capacity: int) -> np.ndarray:
    """Every multiset of the sizes that fits, as columns of counts."""
    found = []
    for n in range(1, capacity // min(sizes) + 1):
        found += [c for c in itertools.combinations_with_replacement(range(len(sizes)), n) if sum(sizes[k] for k in c) <= capacity]
    out = np.zeros((len(sizes), len(found)))
    for j, c in enumerate(found):
        np.add.at(out[:, j], list(c), 1)
    return out


def fewest(configs: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """How often to use each configuration: the least total that meets the demand, by the simplex method, not yet whole."""
    m = len(demand)
    basis = np.array([int(np.flatnonzero((configs.sum(0) == 1) & (configs[k] == 1))[0]) for k in range(m)])
    amount = demand.astype(float)
    for step in range(50 * m + 200):
        inverse = np.linalg.inv(configs[:, basis])
        amount = np.maximum(inverse @ demand, 0)
        gain = 1 - inverse.sum(0) @ configs
        enter = int(gain.argmin()) if step < 25 * m else int((gain < -1e-9).argmax())  # the lowest index can't cycle
        if gain[enter] >= -1e-9:
            break
        column = inverse @ configs[:, enter]
        ratio = np.where(column > 1e-9, amount / np.where(column > 1e-9, column, 1), np.inf)
        basis[int(ratio.argmin())] = enter
    out = np.zeros(configs.shape[1])
    out[basis] = amount
    return out


class Plan:
    """Runs of equal placements, by length and rank; bins of equal room stay together."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.next_rank = dict.fromkeys(counts, 0)
        self.bins = 0
        self.room: dict[int, list[tuple[int, int]]] = {}  # free tokens: (first bin, bins)
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first rank, per bin, first bin, offset

    def place(self, length: int, first_bin: int, bins: int, each: int, offset: int) -> None:
        self.runs.append((length, self.next_rank[length], each, first_bin, offset))
        self.next_rank[length] += bins * each
        self.left[length] -= bins * each

    def open(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def give(self, free: int, first_bin: int, bins: int) -> None:
        if bins and free:
            self.room.setdefault(free, []).append((first_bin, bins))

    def large(self, lengths: list[int], groups: int) -> None:
        """Linear grouping; what the rounding down of the programme leaves stays for best fit."""
        total = sum(self.left[x] for x in lengths)
        if not total:
            return
        share = -(-total // groups)
        grouped: list[list[list[int]]] = [[]]  # per group: [length, count], longest first
        held = 0
        for x in sorted(lengths, reverse=True):
            n = self.left[x]
            while n:
                if held == share:
                    grouped.append([])
                    held = 0
                grouped[-1].append([x, took := min(n, share - held)])
                held += took
                n -= took
        sizes = [g[0][0] for g in grouped]
        merged = {s: [y for g, t in zip(grouped, sizes, strict=True) if t == s for y in g] for s in dict.fromkeys(sizes)}
        sizes = list(merged)
        configs = configurations(sizes, self.capacity)
        uses = np.floor(fewest(configs, np.array([sum(n for _, n in merged[s]) for s in sizes])) + 1e-7)
        for j in np.flatnonzero(uses >= 1):
            slots = [s for k, s in enumerate(sizes) for _ in range(int(configs[k, j]))]
            bins = min(int(uses[j]), *(sum(n for _, n in merged[s]) // slots.count(s) for s in slots))
            while bins > 0:  # a stretch of bins in which each slot keeps one real length
                stretch = min(bins, *(merged[s][0][1] // slots.count(s) or 1 for s in slots))
                first, offset = self.open(stretch), 0
                for s in slots:
                    length = merged[s][0][0]
                    self.place(length, first, stretch, 1, offset)
                    self._use(merged[s], stretch)
                    offset += length
                self.give(self.capacity - offset, first, stretch)
                bins -= stretch

    @staticmethod
    def _use(rows: list[list[int]], n: int) -> None:
        rows[0][1] -= n
        if not rows[0][1]:
            rows.pop(0)

    def best_fit(self, length: int) -> None:
        """Each document into the fullest sequence that can hold it; equal sequences are served together."""
        while n := self.left[length]:
            free = min((f for f in self.room if f >= length), default=0)
            if not free:
                each = self.capacity // length
                whole, rest = divmod(n, each)
                for bins, k in ((whole, each), (1, rest)):
                    if bins and k:
                        first = self.open(bins)
                        self.place(length, first, bins, k, 0)
                        self.give(self.capacity - k * length, first, bins)
                return
            first, bins = self.room[free].pop()
            if not self.room[free]:
                del self.room[free]
            each, at = free // length, self.capacity - free
            whole, rest = (bins, 0) if n >= bins * each else divmod(n, each)
            if whole:
                self.place(length, first, whole, each, at)
                self.give(free - each * length, first, whole)
            if rest:
                self.place(length, first + whole, 1, rest, at)
                self.give(free - rest * length, first + whole, 1)
            used = whole + (rest > 0)
            self.give(free, first + used, bins - used)

    def arrays(self) -> np.ndarray:
        return np.array(sorted(self.runs), np.int64).reshape(-1, 5)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan for ``counts`` documents of each length from 1 to ``capacity``."""
    plan = Plan({int(k): int(v) for k, v in counts.items() if v}, capacity)
    large = [x for x in plan.left if x * LARGE_PARTS > capacity and x < capacity]
    if plan.left.get(capacity):
        n = plan.left[capacity]
        plan.place(capacity, plan.open(n), n, 1, 0)
    plan.large(large, groups)
    for x in sorted(plan.left, reverse=True):
        plan.best_fit(x)
    return plan


def place(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Rows with a ``length`` from 1 to ``capacity`` get ``sequence_id`` and ``offset``. ``pieces`` is read three times."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    runs = plan_packing(counts, capacity, groups).arrays()
    start = (runs[:, 0] << 40) + runs[:, 1]
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(partitions_for(spark))).cast("int")
    dealt = pieces.withColumn("__bucket", bucket)
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "__bucket").count().select("length", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    rank = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("__rank", rank).join(base, ["length", "__bucket"]).withColumn("__rank", F.col("__rank").cast("long") - 1 + F.col("__base")).drop("__bucket", "__base")
    schema = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            own = runs[np.searchsorted(start, (length << 40) + rank, "right") - 1]
            step = rank - own[:, 1]
            made = {"sequence_id": pa.array(own[:, 3] + step // own[:, 2]), "offset": pa.array(own[:, 4] + step % own[:, 2] * length)}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in schema.names], names=schema.names)

    return ranked.mapInArrow(located, schema)


def pack_documents(df: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``; see ``token_pieces`` for odd inputs.

    Equal rows get places of their own. An empty table gives an empty result.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    return place(written(token_pieces(df, tokenizer_path, capacity, id_col, text_col, with_ids), "pieces"), capacity, groups)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
