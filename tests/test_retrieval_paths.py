"""Retrieval beside the scan against the joined form, and neighbours in order against a sort."""

import random

from tessera.operators import retrieval as R

WORDS = "river stone cloud paper a of the signal matter orange violet_window garden 12 x9".split()


def tables(spark):
    rng = random.Random(7)
    docs = [(k, " ".join(rng.choice(WORDS).title() for _ in range(rng.randrange(0, 60)))) for k in range(300)] + [(300, None), (301, ""), (302, "Stone stone, STONE")]
    asked = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 9)))) for k in range(70)] + [(70, None), (71, "unknown words only"), (72, "of a")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id int, text string")


def rows(df):
    return sorted((r.item_id, r.rank, r.doc_id, round(r.score, 5)) for r in df.collect())


def test_both_forms_agree(spark):
    docs, asked = tables(spark)
    for f in (R.bm25, R.tfidf):
        beside, joined = (f(docs.repartition(3), asked, 5, "doc_id", "item_id", most=most) for most in (10**6, 0))
        assert beside.schema["item_id"].dataType == joined.schema["item_id"].dataType
        assert rows(beside) == rows(joined) and beside.count() > 100
        assert f(docs.limit(0), asked, 5, "doc_id", "item_id").count() == 0 == f(docs, asked.limit(0), 5, "doc_id", "item_id").count()


def test_neighbours_in_order(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), k) for k in rng.sample(range(1000), 400)] + [("alone", 5000)]
    df = spark.createDataFrame(data, "source string, doc_id long")
    groups = {}
    for g, i in sorted(data, key=lambda x: x[1]):
        groups.setdefault(g, []).append(i)
    expected = sorted((a, b) for own in groups.values() for x, y in zip(own, own[1:]) for a, b in ((x, y), (y, x)))
    assert sorted((r.doc_id, r.neighbour) for r in R.neighbours(df, "source", "doc_id").collect()) == expected
    follow = R.next_in_order(df, "source", "doc_id").collect()
    assert len(follow) == len(data) and sum(r.next is None for r in follow) == len(groups)
    assert R.neighbours(df.limit(0), "source", "doc_id").count() == 0


def test_terms_travel_once_and_both_ways_to_count_them_agree(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k * j) % 17}" for j in range(1, 2 + k % 9))) for k in range(1, 60)] + [(90, None), (91, "a b c")]
    blocks = spark.createDataFrame(rows, "d long, text string")
    df = R.tfidf_lengths(blocks, 61, 400, "d", "text")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Join" not in plan
    held = {r["id"]: round(r["length"], 9) for r in df.collect()}
    monkeypatch.setattr(R, "HELD_DOCUMENTS", 0)
    spilled = {r["id"]: round(r["length"], 9) for r in R.tfidf_lengths(blocks, 61, 400, "d", "text").collect()}
    assert held == spilled and set(held) == set(range(1, 60))
    # Of 400 million words no task gets more than TERM_ROWS of the at most twice as many terms, on average.
    many = R.tfidf_lengths(blocks, 61, 400_000_000, "d", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert f"{800_000_000 // R.TERM_ROWS}" in many


def test_vector_blocks_meet_a_few_queries_at_a_time(spark, monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, v array<double>")
    found, kind = [], type(vectors)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, *more, **named: found.append(f) or plain(df, f, *more, **named))
    R.vector_search(vectors, vectors, 3, "vec_id", "v")
    rng = np.random.default_rng(3)
    v, q = rng.random((4096, 8), np.float32), rng.random((512, 8), np.float32)
    one = {"v_ids": list(range(1000, 5096)), "v_data": v.tobytes(), "q_ids": list(range(512)), "q_data": q.tobytes()}
    batch = pa.RecordBatch.from_pylist([one] * 4, pa.schema({"v_ids": pa.list_(pa.int64()), "v_data": pa.binary(), "q_ids": pa.list_(pa.int64()), "q_data": pa.binary()}))
    tracemalloc.start()
    rows = best = 0
    for out in found[-1](iter([batch])):
        rows += out.num_rows
        best = best or out.column("vec_id")[0].as_py()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    a, b = v.astype(float), q[0].astype(float)
    assert rows == 4 * 512 * 3 and best == 1000 + int(np.argmax(a @ b / np.linalg.norm(a, axis=1)))
    assert peak < 20e6  # one matrix of 512 x 4096 scores alone has 16.8 MB
