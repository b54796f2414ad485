"""Exact substring dedup over sorted suffixes.

Every ``LENGTH``-byte string picks the least hash among its ``LEAD``-byte substrings, so
equal strings pick equal suffixes at equal places: of all suffixes, only those picked (about
2 in ``LENGTH - LEAD + 2``) need sorting, and no repeat is missed. Of these, a suffix whose
leading bytes occur nowhere else cannot be part of a repeat and goes (by a hash of the leading
bytes, whose collisions only keep more). Hashes filter; what is removed is decided by bytes.

1. Each document gives its picked suffixes; those with repeated leading bytes are kept.
2. They fetch their surroundings from the texts: as far on either side as any string that
   picked them. Equal ones within a batch are settled there, all but the first being covered.
3. The rest is range-partitioned by leading bytes with sampled splitters. Each bucket is
   sorted by multikey quicksort, to the right and, from the lead leftwards, to the left. Common
   prefixes of sorted neighbours give the classes of equal extent on each side; strings are
   equal where both classes are, and all but the first place of each are covered.
4. A lead with more suffixes than a bucket's share would not part in step 3. Its strings are
   range-partitioned by all their bytes and their place, so that equal ones may part, sorted by
   multikey quicksort, and the first of a bucket is compared with the last of the bucket before.
5. Documents meet their covered stretches and are cut.

Texts are shuffled compressed, and only in steps 2 and 5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, partitions_for, sliced, text_of, written

LENGTH, LEAD = 100, 24
REACH = LENGTH - LEAD  # how far beyond its lead, on either side, a string that picked a suffix can go
ROW = 184  # bytes from the lead on, how many, bytes before the lead (the last one first), how many; padded to whole words
LEFT = LENGTH + 1  # where the bytes before begin
BLOCK = 1 << 17
RUN_ROWS, LEAST_RUN = 100_000, 1024  # a lead with more suffixes than the former, or than a bucket's share and the latter, is split
STATE_LEADS = 1 << 20
TEXT_ROWS, HASHED_ROWS = 512, 2048
NO_ID = (1 << 63) - 1
STRETCH = "doc long, version long, start int, stop int"
_random = np.random.default_rng(2024)
CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = {n: _random.integers(1, 1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (1, 2, 4, 8, 16, 99, 100)}


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * STEP[99]
    return (x ^ (x >> np.uint64(29))) * STEP[100]


def joined(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The hash of a string from those of its two parts, the right one ``size`` long."""
    return (left ^ (left >> np.uint64(32))) * STEP[size] + right


def doubled(x: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of twice the length, along the last axis."""
    return joined(x[..., :-size], x[..., size:], size)


def sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``size`` neighbours."""
    span = 1
    while span * 2 <= size:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def lead_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all ``LEAD``-byte stretches, along the last axis."""
    h = CODES[codes]
    for size in (1, 2, 4):
        h = doubled(h, size)
    h16 = doubled(h, 8)
    return stirred(joined(h16[..., :-8], h[..., 16:], 8))


def picked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the picked suffixes of a text and the hashes of their leads.

    Long texts go block by block; ties within a string pick all of their places.
    """
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    codes = np.frombuffer(raw, np.uint8)
    leads = len(raw) - LEAD + 1
    found = []
    for s in range(0, leads, BLOCK):
        e = min(leads, s + BLOCK)
        low, high = max(0, s - REACH), min(leads, e + REACH)
        lead = lead_hashes(codes[low : high - 1 + LEAD])
        least = sliding(lead, REACH + 1, np.minimum)
        edge = np.zeros(REACH, np.uint64)
        chosen = lead == sliding(np.concatenate([edge, least, edge]), REACH + 1, np.maximum)
        at = np.flatnonzero(chosen[s - low : e - low]) + (s - low)
        found.append((at + low, lead[at]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_of(text_col)).alias("version"), text_of(text_col).cast("binary").alias("raw"))


def candidates(keyed: DataFrame) -> DataFrame:
    """(lead, doc, version, pos, sure) of every picked suffix.

    ``sure`` ones come third or later with their lead in a task, so they are known to repeat: a common lead sends two
    rows a task to its partition, the rest is dealt by place.
    """

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # leads of this task so far, sorted, and how often they came
        for batch in sliced(batches):
            own = [picked(x.as_buffer().to_pybytes()) for x in batch.column("raw")]
            pos, lead = (np.concatenate(x) for x in zip(*own, strict=True))
            of = np.repeat(np.arange(len(own)), [len(x[0]) for x in own])
            order = np.argsort(lead, kind="stable")
            of, pos, lead = of[order], pos[order], lead[order]
            leads, start, size = np.unique(lead, return_index=True, return_counts=True)
            at = np.searchsorted(known, leads)
            old = np.flatnonzero(at < len(known))
            old = old[known[at[old]] == leads[old]]
            before = np.zeros(len(leads), np.int64)
            before[old] = times[at[old]]
            sure = np.arange(len(lead)) - np.repeat(start - before, size) >= 2
            times[at[old]] += size[old]
            new = np.setdiff1d(np.arange(len(leads)), old, assume_unique=True)
            known, times = np.concatenate([known, leads[new]]), np.concatenate([times, size[new]])
            order = np.argsort(known, kind="stable")
            known, times = known[order], times[order]
            if len(known) > STATE_LEADS:
                known, times = known[:0], times[:0]
            doc, version = (batch.column(c).to_numpy(zero_copy_only=False)[of] for c in ("doc", "version"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lead.view(np.int64), doc, version, pos.astype(np.int32), sure)], names=["lead", "doc", "version", "pos", "sure"])

    return keyed.mapInArrow(suffixes, "lead long, doc long, version long, pos int, sure boolean")


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by lead: places of the suffixes that are sure or share their lead with another."""
    names = ["doc", "version", "pos"]
    held = None  # the last row so far, whose next one is not known
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        if held:
            columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
        lead, doc, version, pos, keep = columns
        keep = keep.copy()
        same = lead[1:] == lead[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        held = [lead[-1:], doc[-1:], version[-1:], pos[-1:], keep[-1:]]
        own = np.flatnonzero(keep[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[own]) for x in (doc, version, pos)], names=names)
    if held and held[4][0]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[1:4]], names=names)


def packed_texts(keyed: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in sliced(batches):
            data = pa.array([squeeze(x.as_buffer()) for x in batch.column("raw")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("version"), data], names=["doc", "version", "data"])

    return keyed.mapInArrow(pack, "doc long, version long, data binary")


def rows_of(raw: bytes, places: np.ndarray) -> np.ndarray:
    """The surroundings of suffixes of a text, as rows of ``ROW`` bytes that sort as the suffixes do, shorter ones first."""
    padded = np.zeros(REACH + len(raw) + LENGTH, np.uint8)
    padded[REACH : REACH + len(raw)] = np.frombuffer(raw, np.uint8)
    around = np.lib.stride_tricks.sliding_window_view(padded, REACH + LENGTH)[places]
    out = np.zeros((len(places), ROW), np.uint8)
    out[:, :LENGTH] = around[:, REACH:]
    out[:, LENGTH] = np.minimum(len(raw) - places, LENGTH)
    out[:, LEFT : LEFT + REACH] = around[:, REACH - 1 :: -1]
    out[:, LEFT + REACH] = np.minimum(places, REACH)
    return out


def byte_column(rows: np.ndarray) -> pa.Array:
    """Rows of equal width as an Arrow column of bytes."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def byte_rows(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The other way round."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [np.frombuffer(c.buffers()[2], np.uint8)[int(np.frombuffer(c.buffers()[1], np.int32)[c.offset]) :][: len(c) * width] for c in chunks if len(c)]
    return np.concatenate(parts).reshape(-1, width) if parts else np.zeros((0, width), np.uint8)


def multikey_quicksort(words: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The order of fixed-width strings given as columns of 8-byte words: three-way splits on one word at a time."""
    todo = [(np.arange(len(words)) if rows is None else rows, 0)]
    out = []
    while todo:  # depth first, the least part on top
        own, depth = todo.pop()
        if len(own) < 2 or depth == words.shape[1]:
            out.append(own)
            continue
        word = words[own, depth]
        if len(own) < 256:
            out.append(own[np.lexsort(words[own, depth:].T[::-1])])
            continue
        pivot = np.partition(word[[0, len(own) // 4, len(own) // 2, 3 * len(own) // 4, -1]], 2)[2]
        less, same = word < pivot, word == pivot
        todo += [(own[~less & ~same], depth), (own[same], depth + 1), (own[less], depth)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def words_of(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as 8-byte words of the same order."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64)


def classes_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in sorted order, and where in it a row differs from the one before."""
    order = multikey_quicksort(words)
    new = np.ones(len(order), bool)
    for k in range(1, len(order), 1 << 16):
        own = words[order[k - 1 : k + (1 << 16)]]
        new[k : k + (1 << 16)] = (own[1:] != own[:-1]).any(1)
    return order, new


def first_of(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each row in sorted order, the least row of its class: rows come by document and place."""
    if not len(order):
        return order
    return np.minimum.reduceat(order, np.flatnonzero(new))[np.cumsum(new) - 1]


def common_prefixes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many bytes each sorted row has in common with the one before; none for the first."""
    out = np.zeros(len(rows), np.int64)
    for k in range(1, len(rows), 1 << 16):
        own, n = rows[k - 1 : k + (1 << 16)], sizes[k - 1 : k + (1 << 16)]
        differ = own[1:] != own[:-1]
        first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[k : k + (1 << 16)] = np.minimum(first, np.minimum(n[1:], n[:-1]))
    return out


def settled(rows: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that come by document and place: the first of each class of equal surroundings, in sorted order, and those that repeat one of another place."""
    order, new = classes_of(words_of(rows))
    first = first_of(order, new)
    return first[new], order[(doc[order] != doc[first]) | (pos[order] != pos[first])]


def stretch_batches(doc: np.ndarray, version: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(doc), 1 << 16):
        own = slice(k, k + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(version[own]), pa.array(start[own].astype(np.int32)), pa.array(stop[own].astype(np.int32))], names=["doc", "version", "start", "stop"])


def surroundings(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, version, start, stop, around): suffixes with their surroundings, start being the lead's place, and, where
    ``around`` is null, covered stretches that were settled within a batch."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in sliced(batches, TEXT_ROWS):
            batch = batch.take(pyarrow.compute.sort_indices(batch.column("doc")))
            places = [np.unique(x.values.to_numpy()).astype(np.int64) for x in batch.column("places")]
            rows = np.concatenate([rows_of(unpack(x.as_buffer()), p) for x, p in zip(batch.column("data"), places, strict=True)])
            sizes = [len(p) for p in places]
            doc, version = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("doc", "version"))
            pos = np.concatenate(places)
            first, again = settled(rows, doc, pos)
            first = np.sort(first)
            start, stop = pos[again] - rows[again, LEFT + REACH], pos[again] + rows[again, LENGTH]
            columns = [np.concatenate(x) for x in ((doc[first], doc[again]), (version[first], version[again]), (pos[first].astype(np.int32), start.astype(np.int32)), (pos[first].astype(np.int32), stop.astype(np.int32)))]
            around = pa.concat_arrays([byte_column(rows[first]), pa.nulls(len(again), pa.binary())])
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), around], names=["doc", "version", "start", "stop", "around"])

    places = found.groupBy("doc", "version").agg(F.collect_list("pos").alias("places"))
    return texts.join(places.hint("shuffle_hash"), ["doc", "version"]).mapInArrow(fetch, f"{STRETCH}, around binary")


def compared(rows: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with start and end of stretches that also occur earlier. Rows come by document and place, all suffixes of a lead being there."""
    first, again = settled(rows, doc, pos)
    found = [(again, pos[again] - rows[again, LEFT + REACH], pos[again] + rows[again, LENGTH])]
    # Those left differ in their surroundings. Neighbours' common prefixes to the right; leads of one suffix can match none.
    right = common_prefixes(rows[first, :LENGTH], rows[first, LENGTH])
    run = np.cumsum(right < LEAD) - (right[:1] < LEAD).sum()
    many = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
    first, right = first[many], right[many]
    n = len(first)
    if n:
        left_order = multikey_quicksort(words_of(rows[first, LEFT:]))
        left = common_prefixes(rows[first[left_order], LEFT : LEFT + REACH], rows[first[left_order], LEFT + REACH])
        by_place = np.argsort(first)
        after, before = rows[first, LENGTH], rows[first, LEFT + REACH]
        marks = np.zeros((n, REACH + 1), bool)
        own_left = np.zeros(n, np.int64)
        for d in range(REACH + 1):  # strings that begin d bytes before the lead
            own_right = np.cumsum(right < LENGTH - d)
            own_left[left_order] = np.cumsum(left < d)
            valid = (after >= LENGTH - d) & (before >= d)
            shared = np.bincount(own_right[valid], minlength=own_right[-1] + 1) > 1
            at = by_place[(valid & shared[own_right])[by_place]]
            key = own_right[at] * (n + 1) + own_left[at]
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = key[1:] != key[:-1]
            if new.all():
                continue
            least = first[at[np.flatnonzero(new)[np.cumsum(new) - 1]]]
            own = first[at]
            marks[at[(doc[own] != doc[least]) | (pos[own] != pos[least])], REACH - d] = True
        row, low, high = stretches_of(marks)
        place = pos[first[row]] - REACH
        found.append((first[row], place + low, place + high + LENGTH))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def stretches_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first and last columns of the runs of true values."""
    edges = np.diff(np.pad(marks.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edges == 1)
    return row, low, np.nonzero(edges == -1)[1] - 1


def gathered(batches: Iterator[pa.RecordBatch], column: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A partition by document and place: bytes, doc, version, start."""
    filled = [b for b in batches if b.num_rows]
    if not filled:
        return np.zeros((0, width), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = pa.Table.from_batches(filled)
    doc, version, start = (table.column(c).to_numpy() for c in ("doc", "version", "start"))
    order = np.lexsort((start, version, doc))
    return byte_rows(table.column(column), width)[order], doc[order], version[order], start[order].astype(np.int64)


def compare_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: (doc, version, start, stop) of stretches that also occur earlier."""
    rows, doc, version, pos = gathered(batches, "around", ROW)
    own, start, stop = compared(rows, doc, pos)
    yield from stretch_batches(doc[own], version[own], start, stop)


def strings_of(rows: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings that picked each suffix: bytes, row and start."""
    around = np.concatenate([rows[:, LEFT : LEFT + REACH][:, ::-1], rows[:, :LENGTH]], 1)
    lead = lead_hashes(around)
    own = lead[:, REACH : REACH + 1]
    least = (np.minimum.accumulate(lead[:, REACH::-1], 1)[:, ::-1] >= own) & (np.minimum.accumulate(lead[:, REACH:], 1) >= own)
    d = REACH - np.arange(REACH + 1)[None, :]
    row, c = np.nonzero(least & (rows[:, LEFT + REACH, None] >= d) & (rows[:, LENGTH, None] >= LENGTH - d))
    return np.lib.stride_tricks.sliding_window_view(around, LENGTH, axis=1)[row, c], row, pos[row] - REACH + c


def compare_across(suffixes: DataFrame) -> DataFrame:
    """The stretches of leads with too many suffixes for a bucket, by sorting their strings over all buckets."""
    spark = suffixes.sparkSession

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, HASHED_ROWS):
            rows, doc, version, pos = gathered(iter([batch]), "around", ROW)
            text, row, start = strings_of(rows, pos)
            order = np.lexsort((start, doc[row]))
            text, row, start = text[order], row[order], start[order]
            first, again = settled(text, doc[row], start)
            both = np.concatenate([first, again])
            column = pa.concat_arrays([byte_column(text[first]), pa.nulls(len(again), pa.binary())])
            yield pa.RecordBatch.from_arrays([pa.array(doc[row[both]]), pa.array(version[row[both]]), pa.array(start[both].astype(np.int32)), column], names=["doc", "version", "start", "string"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        text, doc, version, start = gathered(batches, "string", LENGTH)
        if not len(text):
            return
        order, new = classes_of(words_of(text))
        first = first_of(order, new)
        again = order[(doc[order] != doc[first]) | (start[order] != start[first])]
        for batch in stretch_batches(doc[again], version[again], start[again], start[again] + LENGTH):
            extra = [pa.nulls(batch.num_rows, k) for k in (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names)
        a, b = first[0], first[-1]
        edge = [doc[a], version[a], start[a], start[a] + LENGTH, TaskContext.get().partitionId(), text[a].tobytes(), text[b].tobytes(), doc[b], start[b]]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(edge, kinds, strict=True)], names=names)

    names = ["doc", "version", "start", "stop", "bucket", "low", "high", "high_doc", "high_start"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32()]
    each = written(suffixes.mapInArrow(strings, "doc long, version long, start int, string binary"), "strings")
    dealt = each.where("string is not null").repartitionByRange(partitions_for(spark), "string", "doc", "start")
    sorted_strings = written(dealt.mapInArrow(sort, f"{STRETCH}, bucket int, low binary, high binary, high_doc long, high_start int"), "sorted-strings")
    # Across boundaries: one row a bucket, however many strings.
    last, covered = None, []
    for e in sorted(sorted_strings.where("bucket is not null").collect(), key=lambda r: r["bucket"]):
        goes_on = last is not None and last[0] == e["low"]
        if goes_on and last[1:] != (e["doc"], e["start"]):
            covered.append((e["doc"], e["version"], e["start"], e["stop"]))
        if not (goes_on and e["low"] == e["high"]):
            last = (e["high"], e["high_doc"], e["high_start"])
    names_of = [x.split()[0] for x in STRETCH.split(", ")]
    early = each.where("string is null").select("doc", "version", "start", (F.col("start") + LENGTH).alias("stop"))
    return sorted_strings.where("bucket is null").select(*names_of).unionByName(early).unionByName(spark.createDataFrame(covered, STRETCH))


def repeated_stretches(keyed: DataFrame, texts: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(doc, version, start, stop) of stretches that also occur earlier; they may overlap."""
    spark = keyed.sparkSession
    parts = partitions_for(spark)
    dealt_by = F.when(F.col("sure"), F.xxhash64("doc", "pos")).otherwise(F.col("lead"))
    by_lead = candidates(keyed).repartition(parts, dealt_by).sortWithinPartitions("lead")
    found = written(by_lead.mapInArrow(_repeated, "doc long, version long, pos int"), "suffixes")
    near = written(surroundings(texts, found), "surroundings", compression="zstd")
    suffixes = near.where("around is not null").withColumn("lead", F.substring("around", 1, LEAD))
    share = max(LEAST_RUN, suffixes.count() // parts)
    hot = written(suffixes.groupBy("lead").count().where(F.col("count") > min(run_rows, share)).select("lead"), "hot-leads")
    cold, across = suffixes, None
    if not hot.isEmpty():
        cold, across = suffixes.join(hot, "lead", "left_anti"), compare_across(suffixes.join(hot, "lead", "left_semi").drop("lead"))
    stretches = cold.repartitionByRange(parts, "lead").drop("lead").mapInArrow(compare_bucket, STRETCH)
    stretches = stretches.unionByName(near.where("around is null").drop("around"))
    return written(stretches.unionByName(across) if across else stretches, "stretches")


def spans(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a text, merged."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order]) if len(stop) else stop
    if not len(start):
        return []
    heads = np.concatenate([[True], start[1:] > reach[:-1]])
    return list(zip(start[heads].tolist(), reach[np.concatenate([heads[1:], [True]])].tolist(), strict=True))


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN_ROWS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: what stays, which may cut characters), a row per input row.

    A null text is empty. A null id counts as the largest and stays null. Rows with one id
    and one text are the same document; texts shorter than ``LENGTH`` bytes stay whole. Texts
    are read whole, however long, an empty table gives no rows, and other columns are left out.
    """
    keyed = _keyed(df, id_col, text_col)
    texts = packed_texts(keyed)
    stretches = repeated_stretches(keyed, texts, run_rows)
    marks = stretches.groupBy("doc", "version").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in sliced(batches, TEXT_ROWS):
            rows = []
            for data, *lists in zip(batch.column("data"), *(batch.column(c) for c in ("starts", "stops")), strict=True):
                raw = unpack(data.as_buffer())
                gone = spans(*(x.values.to_numpy().astype(np.int64) for x in lists)) if lists[0].is_valid else []
                edges = [0, *(x for span in gone for x in span), len(raw)]
                rows.append((len(raw), sum(b - a for a, b in gone), len(gone), b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([batch.column("doc"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True))], names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    out = texts.join(marks.hint("shuffle_hash"), ["doc", "version"], "left").mapInArrow(cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
