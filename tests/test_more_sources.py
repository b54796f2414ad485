"""Paged sources with retries, parsed records, JSON facts, claims and the written index."""

import http.server
import json
import threading

from pyspark.sql import functions as F

from tessera.operators import claims, retrieval
from tessera.sources import bibliography as B
from tessera.sources import json_facts as J


class Handler(http.server.BaseHTTPRequestHandler):
    failed: set = set()

    def do_GET(self):
        if self.path not in Handler.failed and "start=2" in self.path:
            Handler.failed.add(self.path)
            self.send_response(503)
            self.send_header("Retry-After", "0")
            self.end_headers()
            return
        start = int(self.path.split("start=")[1].split("&")[0])
        body = json.dumps({"resultList": {"result": [{"pmid": str(start), "pmcid": "7" if start == 0 else None, "doi": "https://doi.org/10.1/X", "title": "T"}]}}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_pages_are_fetched_again_and_parsed(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/s?start={{start}}&n={{size}}"
        pages = B.read_pages(spark, url=url, size="2", cap="5", first_wait="0.01")
        got = B.json_records(pages).select("page", "pmid", "pmcid", "doi", "link").orderBy("page").collect()
    finally:
        server.shutdown()
    assert [tuple(r) for r in got] == [(0, "0", "PMC7", "10.1/x", "pmcid:PMC7"), (1, "2", None, "10.1/x", "pmid:2"), (2, "4", None, "10.1/x", "pmid:4")]


def test_waits_double_and_honour_the_server():
    assert [B.wait_before(k, None) for k in range(3)] == [1.0, 2.0, 4.0] and B.wait_before(0, "9") == 9.0 and B.wait_before(3, "2") == 8.0


def test_article_metadata_and_enrichment(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<all><article><pmid>1</pmid><title> T </title><medline_date>Spring 1999-2000</medline_date><types><type>A</type><type>B</type></types></article><article><pmid>2</pmid><year>2001</year></article></all>")
    meta = B.article_metadata(spark, str(tmp_path / "a.xml"))
    assert {(r.pmid, r.year, r.types) for r in meta.collect()} == {("1", 1999, "A; B"), ("2", 2001, None)}
    records = spark.createDataFrame([("1",), ("2",), ("3",)], "pmid string")
    other = spark.createDataFrame([("2", 1900), ("3", 1950)], "pmid string, year int")
    assert {(r.pmid, r.year, r.origin) for r in B.enriched(records, meta, other, "pmid", ["year"]).collect()} == {("1", 1999, "first"), ("2", 2001, "first"), ("3", 1950, "second")}


def test_json_facts(spark):
    doc = {"paper_id": "P", "arms": [{"arm_id": "A1", "dose": 1.5, "tags": ["x", "y"]}, {"dose": None}], "evidence_ids": ["e1"], "n": {"my_evidence_ids": ["e2", "e1"]}}
    rows = J.facts(spark.createDataFrame([(1, json.dumps(doc)), (2, "{"), (3, None)], "i long, j string"), "i", "j").collect()
    got = {(r.json_path, r.record_key, r.value) for r in rows if r.i == 1}
    assert {("$.arms[0].dose", "A1", "1.5"), ("$.arms[0].tags[1]", "A1[1]", '"y"'), ("$.arms[1].dose", "P[1]", "null"), ("$.paper_id", "P", '"P"')} <= got
    assert [r.field for r in rows if r.i != 1] == ["error", "error"]
    assert J.collected_ids(doc) == ["e1", "e2"]
    flat = spark.createDataFrame([(1, "assertion.c.1.value", "5"), (1, "assertion.c.1.unit", "mg"), (1, "other", "x")], "i long, n string, v string")
    assert [(r.group, r["name"], r.number, r.fields) for r in J.regrouped(flat, "i", "n", "v").collect()] == [("assertion", "c", 1, {"value": "5", "unit": "mg"})]


def test_claims(spark):
    df = spark.createDataFrame([(1, "Dose A increased uptake by 40% in mice, but it did not reduce weight"), (2, "It not only increased A and reduced B to 3 mg"), (3, None)], "i long, s string")
    got = claims.claims(df, ["i"], "s", {"increase": r"\bincreas\w*", "reduce": r"\breduc\w*"}).orderBy("i", "start").collect()
    assert [(r.i, r.clause, r.predicate, r.negative, r.number, r.unit) for r in got] == [(1, 0, "increase", False, 40.0, "%"), (1, 1, "reduce", True, None, None), (2, 0, "increase", False, 3.0, "mg"), (2, 0, "reduce", False, 3.0, "mg")]
    assert got[0].subject == "Dose A" and got[0].object == "uptake by 40% in mice" and df.first().s[got[0].start : got[0].stop] == "increased"


def test_a_written_index_scores_alike(spark, tmp_path):
    base = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    retrieval.write_index(docs, str(tmp_path / "index"), "doc_id")
    order = lambda df: sorted(map(tuple, df.select("item_id", "doc_id", "score", F.col("rank")).collect()))
    assert order(retrieval.indexed_bm25(spark, str(tmp_path / "index"), items, 5, "doc_id", "item_id")) == order(retrieval.bm25(docs, items, 5, "doc_id", "item_id"))
