"""Packing, line dedup, decontamination, media, SimHash, substrings: against brute force, with odd inputs."""

import hashlib
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import decontam, linededup, ogg, packing, simhash, suffixes
from tessera.operators import components
from tests.llm.cases import both, documents, rows

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_packing_places_every_piece_without_gaps(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    got = packing.pack_documents(documents(spark), with_ids=True).collect()
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, t in rows():
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[a : a + 2048], "<u4").tobytes()
            expected.append((i, k, a, len(own) // 4, zlib.crc32(own)))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=repr) == sorted(expected, key=repr)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 2049, 5000), rng.integers(500, 1500, 4000), np.minimum(2048, rng.lognormal(6.5, 1, 9000).astype(int) + 1), np.full(1000, 700), np.array([2048] * 5)):
        values, counts = np.unique(sizes, return_counts=True)
        plan = packing.plan_packing(dict(zip(values.tolist(), counts.tolist(), strict=True)))
        placed = defaultdict(int)
        runs = plan.arrays()
        for length in values.tolist():
            own = runs[runs[:, 0] == length]
            for k, run in enumerate(own):
                end = own[k + 1][1] if k + 1 < len(own) else counts[values == length][0]
                for step in range(end - run[1]):
                    placed[int(run[3] + step // run[2])] += length
        assert sum(placed.values()) == sizes.sum() and max(placed.values()) <= 2048 and len(placed) == plan.bins
        large = sum(1 for s in sizes if s > 1024)
        assert plan.bins <= max(-(-int(sizes.sum()) // 2048), large, -(-len(sizes) // 2) if min(sizes) > 682 else 0) * 1.12 + 2


def lines_by_hand(data):
    first = {}
    for i, t in sorted(data, key=lambda x: (x[0] is None, x[0] or 0)):
        for line in (t or "").split("\n"):
            first.setdefault(line.strip(" \t\n\x0b\x0c\r").translate(LOWER), i)
    out = []
    for i, t in data:
        own = (t or "").split("\n")
        kept = [x for x in own if len(k := x.strip(" \t\n\x0b\x0c\r").translate(LOWER)) < 10 or first[k] == i]
        out.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [False, True])
def test_line_dedup(spark, hot):
    data = rows() + ([(5000 + k, f"Shared line of the site\nown line number {k} here\n\tSHARED LINE OF THE SITE ") for k in range(300)] if hot else [])
    got = linededup.dedup_lines(documents(spark, data)).withColumn("sha", F.sha2("text", 256))
    assert both(got, "doc_id", "n_lines", "n_dropped", "sha") == lines_by_hand(data)
    assert {"lang", "pos", "version"} <= set(got.columns)
    assert linededup.dedup_lines(documents(spark, [])).count() == 0


def words_by_hand(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def contamination_by_hand(data, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words_by_hand(t)
        for s in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[s : s + 13])].add(i)
    out = []
    for i, t in data:
        w, hit, found = words_by_hand(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[g]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def benchmark_items():
    data = dict(rows()[:60])
    cut = lambda k, a, b: " ".join(words_by_hand(data[k])[a:b])
    return [(1, cut(20, 2, 30)), (2, cut(21, 0, 13)), (3, cut(22, 0, 4)), (10, cut(20, 5, 25)), (4, None), (5, "?!"), (None, cut(23, 0, 14)), (6, "STRASSE straße é")]


@pytest.mark.parametrize("limit", [10**9, 3000, 0])
def test_contamination(spark, limit):
    shared = benchmark_items()[0][1]  # a window that very many items have
    asked = benchmark_items() + [(k, shared) for k in range(100, 2100)]
    items = spark.createDataFrame(asked, "item_id long, text string")
    windows = decontam.benchmark_windows(items)
    n, words = windows.count(), windows.selectExpr("sum(octet_length(concat_ws(' ', window_words)) + 16 * window_size + 32)").first()[0]
    assert (32 * n <= limit) == (limit > 0) and (words <= limit) == (limit > 3000)
    got = decontam.contamination(documents(spark), items, broadcast_bytes=limit)
    assert both(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == contamination_by_hand(rows(), asked)


def test_contamination_without_items_and_without_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontam.contamination(documents(spark), none).collect()} == {0}
    assert decontam.contamination(documents(spark, []), none).count() == 0


def test_contaminated_documents_and_spans_go(spark):
    items = spark.createDataFrame(benchmark_items(), "item_id long, text string")
    bad = [r[0] for r in contamination_by_hand(rows(), benchmark_items()) if r[5]]
    left = decontam.without_contaminated(documents(spark), items)
    assert left.columns == documents(spark).columns
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(i) for i, _ in rows() if i not in bad)
    cut = decontam.without_spans(documents(spark), items)
    assert not any(r.contaminated for r in decontam.contamination(cut, items).collect())
    assert cut.count() == len(rows())


def test_ogg_round_trip(spark):
    got = {r.doc_id: r for r in ogg.read_ogg(ogg.to_ogg(documents(spark))).collect()}
    for i, t in rows():
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), None)
    assert ogg.to_ogg(documents(spark, [])).count() == 0
    assert ogg.ogg_packets(ogg.to_ogg(documents(spark, [(1, "x" * 1200)]))).orderBy("first_sample").select("first_sample").collect()[-1][0] == 1152


def test_ogg_checksum_is_the_published_one():
    table = []
    for k in range(256):
        r = k << 24
        for _ in range(8):
            r = (r << 1 ^ 0x04C11DB7 if r & 1 << 31 else r << 1) & 0xFFFFFFFF
        table.append(r)
    crc = 0
    for b in b"OggS some page":
        crc = (crc << 8 ^ table[crc >> 24 ^ b]) & 0xFFFFFFFF
    assert ogg.page_checksum(b"OggS some page") == crc.to_bytes(4, "little")


@pytest.mark.parametrize("harm", [lambda m: m[:-1], lambda m: m[:100] + b"?" + m[101:], lambda m: m[1:], lambda m: b"x" + m, lambda m: m + m])
def test_ogg_tells_broken_media(spark, harm):
    media = harm(ogg.mux(ogg.padded(b"payload " * 9000)))
    row = ogg.read_ogg(spark.createDataFrame([(1, 5, bytearray(media)), (2, 5, None)], "doc_id long, n_bytes long, media binary")).collect()
    assert all(r.error and r.payload_sha256 is None for r in row)


def test_ogg_packets_may_span_pages():
    packet = bytes(range(256)) * 300
    table = ogg.lacing(len(packet))
    raw = lambda flags, seq, segs, body: (lambda x: x[:22] + ogg.page_checksum(x) + x[26:])(ogg.HEAD.pack(b"OggS", 0, flags, 9, 7, seq, 0, len(segs)) + segs + body)
    cut = 255 * 255
    media = raw(ogg.FIRST, 0, table[:255], packet[:cut]) + raw(ogg.CONTINUED | ogg.LAST, 1, table[255:], packet[cut:])
    assert [x[0] for x in ogg.demux(media)[7]] == [packet]


def simhash_by_hand(t):
    w = (t or "").encode().lower().split()
    grams = [b" ".join(w[k : k + 3]) for k in range(max(len(w) - 2, 1))] if w else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def components_by_hand(fps):
    names = sorted(set(fps))
    group = {f: f for f in names}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            if (a ^ b).bit_count() <= 2:
                group[root(a)] = root(b)
    return {f: root(f) for f in names}


def test_simhash_components(spark):
    fps = [(i, simhash_by_hand(t)) for i, t in rows()]
    group = components_by_hand([f for _, f in fps])
    least = {}
    for i, f in fps:
        if i is not None:
            least[group[f]] = min(i, least.get(group[f], i))
    expected = sorted(((i, f"{f:016x}", least.get(group[f])) for i, f in fps), key=repr)
    assert both(simhash.simhash_components(documents(spark)), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.one_of_each(documents(spark))
    assert {r.doc_id for r in kept.collect()} == set(least.values()) | {None}
    assert kept.columns == documents(spark).columns
    assert simhash.simhash_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [20_000, 60, 5])
def test_links_miss_none_in_buckets_of_any_size(spark, limit):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 62, 4)
    fps = {int(c) for c in centre}
    for c in centre.tolist():
        for _ in range(120):
            x = c
            for b in rng.integers(0, 62, rng.integers(1, 5)).tolist():
                x ^= 1 << b
            fps.add(x)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    star = {r.a: r.b for r in components.components(simhash.links(df, 2, limit)).collect()}
    by_hand = components_by_hand(fps)
    got = defaultdict(set)
    expected = defaultdict(set)
    for f in fps:
        got[star.get(f, f)].add(f)
        expected[by_hand[f]].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_covering_masks_cover():
    masks = simhash.covering_masks(2)
    for a in range(64):
        for b in range(a, 64):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 200)] + [(500, 500), (600, 601), (601, 600)], "a long, b long")
    assert {(r.a, r.b) for r in components.components(edges).collect()} == {(k, 1) for k in range(2, 201)} | {(601, 600)}


def substrings_by_hand(data):
    seen, out = {}, []
    for i, t in sorted({(i, t or "") for i, t in data}, key=lambda x: (x[0] is None, x[0] or 0)):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if seen.setdefault(raw[p : p + 100], (i, p)) != (i, p):
                gone[p : p + 100] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1)
        out += [(i, len(raw), int(gone.sum()), len(edges), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())] * data.count((i, t if t else t))
    return out


@pytest.mark.parametrize("limit", [20_000, 3])
def test_substring_dedup(spark, limit):
    rng = np.random.default_rng(8)
    data = [(i, t or "") for i, t in rows()]
    shared = "".join(chr(c) for c in rng.integers(97, 123, 260))
    data += [(7000 + k, f"{rng.integers(10**9)} {shared[rng.integers(0, 40) : 200 + k % 60]} {rng.integers(10**9)}" * 2) for k in range(80)]
    got = suffixes.dedup_substrings(documents(spark, data), run_rows=limit).withColumn("sha", F.sha2("kept", 256))
    assert both(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == sorted(substrings_by_hand(data), key=repr)
    assert suffixes.dedup_substrings(documents(spark, [])).count() == 0


def test_multikey_quicksort():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 6, (5000, 3)).astype(np.uint64)
    order = suffixes.multikey_quicksort(words)
    assert (words[order] == words[np.lexsort(words.T[::-1])]).all() and len(set(order.tolist())) == 5000
