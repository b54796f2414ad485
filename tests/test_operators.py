"""Order-dependent operators against brute force; sources, sinks and streams by round trip."""

import io
import itertools
import json
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.functions import numbers as N
from tessera.functions import text as X
from tessera.operators import assignment as A
from tessera.operators import readiness, retrieval, sinks
from tessera.operators import relational as R
from tessera.operators.components import components
from tessera.sources import files, markup
from tessera.streaming import ledger


def graphs(n=25):
    rng = random.Random(1)
    for g in range(n):
        yield g, [(g, rng.randrange(5), rng.randrange(5), float(rng.randrange(1, 20))) for _ in range(rng.randrange(1, 12))]


def weights_of(rows):
    out = {}
    for _, a, b, s in rows:
        out[a, b] = max(s, out.get((a, b), 0))
    return out


def matchings(weights):
    edges = list(weights)
    for n in range(len(edges) + 1):
        for chosen in itertools.combinations(edges, n):
            if len({a for a, _ in chosen}) == len({b for _, b in chosen}) == n:
                yield chosen


def test_matchings_are_optimal(spark):
    data = [(g, a, b, s) for g, rows in graphs() for (a, b), s in weights_of(rows).items()]
    df = spark.createDataFrame(data, "g int, a int, b int, s double")
    most = A.most_pairs(df, ["g"], "a", "b").collect()
    heavy = A.heaviest_pairs(df, ["g"], "a", "b", "s", 3.0).collect()
    both = A.heaviest_pairs(df, ["g"], "a", "b", "s", 3.0, count_first=True).collect()
    greedy = A.greedy_pairs(df, ["g"], "a", "b", "s", 3.0).collect()
    for g, rows in graphs():
        own = weights_of(rows)
        good = {k: s for k, s in own.items() if s >= 3}
        for found in (most, heavy, both, greedy):
            pairs = [(r.a, r.b) for r in found if r.g == g]
            assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs) and set(pairs) <= set(own)
        assert sum(r.g == g for r in most) == max(map(len, matchings(own)))
        assert sum(r.s for r in heavy if r.g == g) == max(sum(good[e] for e in m) for m in matchings(good))
        best = max((len(m), sum(good[e] for e in m)) for m in matchings(good))
        assert (sum(r.g == g for r in both), sum(r.s for r in both if r.g == g)) == best


def test_packing_by_budget_and_caps(spark):
    df = spark.createDataFrame([("p", k, size, pr) for k, (size, pr) in enumerate([(60, 9), (50, 8), (40, 7), (200, 6), (5, 5)])], "g string, i int, size int, pr int")
    assert [r.i for r in A.within_budget(df, ["g"], "i", "size", "pr", 110).collect() if r.selected] == [0, 1]
    assert [r.task for r in A.next_fit(df, ["g"], "i", ["size"], [100]).orderBy("i").collect()] == [1, 2, 2, 0, 2]
    assert A.within_budget(df.limit(0), ["g"], "i", "size", "pr", 110).count() == 0


def test_incremental_clusters_do_not_merge(spark):
    df = spark.createDataFrame([(0, 1, ["a"]), (0, 2, ["b"]), (0, 3, ["a", "b"]), (0, 4, ["b"]), (1, 9, ["z"])], "c long, i long, k array<string>")
    assert {(r.i, r.cluster) for r in A.incremental_clusters(df, "c", "i", "k").collect()} == {(1, 1), (2, 2), (3, 1), (4, 1), (9, 9)}


def test_absorbed_by_the_first_alike(spark):
    df = spark.createDataFrame([("g", 1, list("abcd"), "s"), ("g", 2, list("abcx"), "s"), ("g", 3, list("abcx"), "t"), ("g", 4, [], "s")], "g string, i int, t array<string>, s string")
    assert {(r.i, r.kept_as) for r in A.absorbed(df, ["g"], "i", "t", "s").collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}


def test_absorbed_as_one_by_one(spark):
    rng = random.Random(5)
    data = [(rng.choice("gh"), k, rng.sample("abcdefgh", rng.randrange(0, 6)), rng.choice("st")) for k in range(300)]
    kept, expected = [], set()
    for g, i, tokens, source in data:
        own = set(tokens)
        like = [k for h, k, theirs, s in kept if h == g and own and theirs and ((part := len(own & theirs) / min(len(own), len(theirs))) >= 0.92 or s == source and part >= 0.72)]
        kept += [] if like else [(g, i, own, source)]
        expected.add((i, like[0] if like else i))
    df = spark.createDataFrame(data, "g string, i int, t array<string>, s string")
    assert {(r.i, r.kept_as) for r in A.absorbed(df, ["g"], "i", "t", "s").collect()} == expected


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.a, r.b) for r in components(edges).collect()} == {(k, 0) for k in range(1, 61)} | {(101, 100)}


def test_neighbour_bonus_grows_along_seeds(spark):
    scores = spark.createDataFrame([("q", 1, 1.0), ("q", 2, 0.9)], "q string, i long, score double")
    near = spark.createDataFrame([(1, 2), (2, 3)], "i long, neighbour long")
    got = {r.i: r.score for r in retrieval.with_neighbours(scores, near, "q", "i").collect()}
    assert got == {1: 1.0, 2: 1.08, 3: round(0.18 * 1.08, 8)}


def test_text_functions(spark):
    row = spark.sql("SELECT ' https://doi.org/10.1/AB ' AS doi, '12345' AS pmc, 'Éa: B' AS title, '3.50 : 10 :2' AS ratio, 'Not  Reported' AS missing, '-12.50x' AS number, '' AS nothing")
    got = row.select(X.normalize_doi(F.col("doi")), X.normalize_pmcid(F.col("pmc")), X.ratio_parts(F.col("ratio")), X.has_value(F.col("missing")), X.first_number(F.col("number")), X.normalize_doi(F.col("nothing")), N.canonical_number(F.lit("2.500")), X.normalize_title(F.col("title"))).first()
    assert tuple(got) == ("10.1/ab", "PMC12345", "3.50:10:2", False, -12.5, None, "2.5", "e a b")


def test_readiness_precedence(spark):
    row = spark.range(1).select(readiness.verification(F.array(F.lit("manual"), F.lit("rejected"))).alias("v"), readiness.status(F.lit(False), F.lit(True), F.array(F.lit("x"))).alias("s"), readiness.queue_label(F.lit("incomplete"), F.array(F.lit("x")), 3).alias("l")).first()
    assert tuple(row) == ("rejected", "conflict", "almost")


def test_article_blocks(spark):
    xml = "<article><body><sec><title>Results</title><sec><title>Part</title><p id='p1'>One <b>two</b>.</p><p id='p1'>again</p><fig id='f'><caption>Cap</caption></fig></sec></sec></body></article>"
    got = markup.article_blocks(spark.createDataFrame([("a", xml), ("b", "<oops"), ("c", None)], "path string, content string")).collect()
    assert [(r.id, r.section_path, r.block_type, r.text) for r in got if r.block_type != "error"] == [("a", "Results > Part", "paragraph", "One two."), ("a", "Results > Part", "caption", "Cap")]
    assert {r.id for r in got if r.block_type == "error"} == {"b", "c"}


def test_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/x.csv", "a,b\n1,2")
        z.writestr("../evil", "no")
    with tarfile.open(tmp_path / "b.tar", "w") as t:
        info = tarfile.TarInfo("y.txt")
        info.size = 2
        t.addfile(info, io.BytesIO(b"hi"))
    (tmp_path / "c.zip").write_bytes(b"broken")
    got = {(r.archive, r.member): (r.text, r.error is not None) for r in files.archive_members(spark, str(tmp_path)).collect()}
    assert got[("a.zip", "in/x.csv")] == ("a,b\n1,2", False) and got[("a.zip", "../evil")] == (None, True) and got[("b.tar", "y.txt")] == ("hi", False) and got[("c.zip", None)][1]
    hashes = files.file_hashes(spark, str(tmp_path), "*.zip")
    manifest = hashes.select("name", F.lit("completed").alias("status"), F.when(F.col("name") == "a.zip", F.col("sha256")).otherwise("other").alias("sha256"))
    assert {(r["name"], r.complete) for r in files.cached_pages(hashes, manifest).collect()} == {("a.zip", True), ("c.zip", False)}
    (tmp_path / "rows.jsonl").write_text('{"a": 1}\n\nbroken\n{"a": 2}\n')
    assert sorted((r.a or 0, r._corrupt_record) for r in files.json_lines(spark, str(tmp_path / "rows.jsonl"), "a long").collect()) == [(0, "broken"), (1, None), (2, None)]
    (tmp_path / "rows.tsv").write_text('a\tb\n1\t"x ""y"""\n')
    assert files.delimited(spark, str(tmp_path / "rows.tsv"), "\t").first().b == 'x "y"'


def test_sinks_refuse_and_verify(spark, tmp_path):
    df = spark.range(50).withColumn("v", F.lit("x"))
    n, digest = sinks.publish(df, str(tmp_path / "t"))
    assert n == 50 and sinks.content(df.orderBy(F.desc("id"))) == (n, digest) != sinks.content(df.withColumn("v", F.lit("y")))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.publish(df, str(tmp_path / "t"))
    broken = R.violations([("small", df.where("id < 3"), F.col("id"))])
    with pytest.raises(sinks.Refused):
        sinks.publish(df, str(tmp_path / "u"), broken)
    sinks.export_csv(df, str(tmp_path / "csv"), "id")
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 50


def test_ledger_stream_takes_each_record_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [{"key": "a", "value": "1"}, {"key": "a", "value": "1"}, {"key": "b", "value": "2"}]
    (source / "1.json").write_text("\n".join(map(json.dumps, rows)))

    def take():
        stream = ledger.fact_stream(spark, str(source), "key string, value string")
        ledger.accept(stream, str(tmp_path / "ledger"), str(tmp_path / "check"), "key", ["value"]).awaitTermination()
        return sorted((r.key, r.value, r.decision) for r in spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "ledger")).collect())

    assert take() == [("a", "1", "new"), ("b", "2", "new")]
    (source / "2.json").write_text(json.dumps({"key": "a", "value": "9"}) + "\n" + json.dumps({"key": "b", "value": "2"}))
    assert take() == [("a", "1", "new"), ("a", "9", "conflict"), ("b", "2", "new")]
    assert len(take()) == 3


def test_windowed_counts_stream(spark, tmp_path):
    events = spark.createDataFrame([("2024-01-01 00:00:10", "x"), ("2024-01-01 00:00:50", "x"), ("2024-01-01 00:01:10", "y")], "t string, kind string").withColumn("t", F.to_timestamp("t"))
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = ledger.windowed_counts(stream, "t", "kind", "1 minute", "1 minute").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.kind, r.n) for r in spark.table("counts").collect()) == [("x", 2), ("y", 1)]


def test_as_of_takes_the_last_before(spark):
    left = spark.createDataFrame([("k", 5, "a"), ("k", 1, "b"), ("z", 9, "c")], "key string, t int, name string")
    right = spark.createDataFrame([("k", 2, 20), ("k", 5, 50)], "key string, t int, v int")
    assert {(r.name, r.v) for r in R.as_of(left, right, ["key"], "t", "v").collect()} == {("a", 50), ("b", None), ("c", None)}


def test_streaks_and_upserts(spark):
    runs = spark.createDataFrame([("a", k, k not in (2, 6)) for k in range(9)] + [("b", 1, False)], "g string, k int, f boolean")
    assert {(r.g, r.longest) for r in R.streaks(runs, ["g"], ["k"], F.col("f")).collect()} == {("a", 3), ("b", 0)}
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, None), (4, "d")], "k int, v string")
    assert {(r.k, r.v, r.action) for r in R.upserted(old, new, ["k"], ["v"]).collect()} == {(1, "a", "keep"), (2, None, "keep"), (3, None, "update"), (4, "d", "insert")}
