"""Each stage of the pipeline on its predecessor's rows against brute force, with odd rows; and no rows at all."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from tessera.llm import quality
from tests.llm.cases import WORDS, sentence
from tests.llm.test_nearcopies import kept_by_brute_force
from tests.llm.test_pieces import LOWER, contamination_by_hand

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, version string"


def corpus():
    rng = random.Random(9)
    passage = " ".join(f"b{rng.randrange(10**6)}" for _ in range(20))
    texts = ["\n".join(" ".join(f"{rng.choice(WORDS)}{rng.randrange(10**4)}" for _ in range(rng.randrange(6, 40))) for _ in range(rng.randrange(1, 6))) for _ in range(120)]
    for k in range(100, 120):
        texts[k] = " ".join(f"{w.upper()}!!" for w in sentence(rng, 60).split())  # what labels call bad
    texts[3] = texts[2]
    texts[5] = texts[4] + " and a tail"
    texts[7] = texts[6] + "\nA line that the site has everywhere"
    texts[8] += "\n a LINE that the site has everywhere\t"
    texts[9] = passage + " " + texts[9]
    texts[10] = "own words before " + passage
    texts[11] = "\n".join(f"very long line {rng.randrange(10**9)} " + " ".join(str(rng.randrange(10**6)) for _ in range(40)) for _ in range(400))
    rows = [(k, t) for k, t in enumerate(texts)] + [(500, None), (501, ""), (502, ""), (20, texts[20]), (20, texts[20]), (None, "a text without an id that is kept"), (None, None)]
    labels = [(k, int(k < 100), 0) for k in range(120)] + [(None, 1, 0), (7, None, 0), (9999, 0, 1)]
    return rows, labels, [(1, passage), (2, None), (None, "one two three")]


def lines_by_hand(rows):
    first = {}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        for line in (t or "").split("\n"):
            first.setdefault(key(line), i)
    return [(i, "\n".join(x for x in (t or "").split("\n") if len(key(x)) < 10 or first[key(x)] == i)) for i, t in rows]


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels, items = corpus()
    docs = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), 1.0, "x") for i, t in rows], SCHEMA)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    assert list(stages) == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]

    def run(name, before):
        after = stages[name](spark, before, sf).cache()
        if name != "best-fit packing":
            assert after.columns == docs.columns
        return after, Counter((r["doc_id"], r["text"]) for r in after.collect()) if name != "best-fit packing" else None

    now, got = run("quality classifier", docs)
    weights, bias = quality.trained(docs, spark.read.parquet(f"{sf}/labels.parquet")).collapsed()
    good = [x >= 0.5 for x in quality.scores([t or "" for _, t in rows], weights.astype(np.float32), bias, -1)]
    assert got == Counter(x for x, keep in zip(rows, good, strict=True) if keep)
    assert not [i for i, _ in got if i is not None and 100 <= i < 120] and len(got) > 100
    kept = list(got.elements())

    now, got = run("line dedup", now)
    assert got == Counter(lines_by_hand(kept)) and {r.n_chars for r in now.where("doc_id = 502").collect()} == {0}
    kept = list(got.elements())

    now, got = run("simhash near-dedup", now)
    texts = {i: t for i, t in kept if i is not None}
    stay = kept_by_brute_force(list(texts.items()))
    assert got == Counter(x for x in kept if x[0] is None or x[0] in stay)
    kept = list(got.elements())

    now, got = run("benchmark decontamination", now)
    bad = {r[0] for r in contamination_by_hand([x for x in kept if x[0] is not None], items) if r[5]}
    assert bad == {9, 10} and got == Counter(x for x in kept if x[0] not in bad)
    kept = list(got.elements())

    now, _ = run("best-fit packing", now)
    from tokenizers import Tokenizer

    import public_tokenizers

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, t in kept:
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected.update((i, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048)))
    pieces = now.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == expected
    bins = defaultdict(list)
    for r in pieces:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_no_documents_go_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
