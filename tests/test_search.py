"""Searches against a stub server: two phases, cursors, and runs that die midway and go on without fetching a page twice."""

import http.server
import json
import threading
from collections import Counter
from urllib.parse import parse_qs, urlparse

import pytest

from tessera.sources import bibliography as B
from tessera.sources import search as S

TOTALS = {"lnp": 23, "liver & lung": 7, "nothing": 0}
CURSORS = {"lnp": 5, "liver & lung": 2, "nothing": 1}


class Stub(http.server.BaseHTTPRequestHandler):
    served: Counter = Counter()
    broken: set = set()

    def do_GET(self):
        where = urlparse(self.path)
        asked = {k: v[0] for k, v in parse_qs(where.query).items()}
        place = (where.path, *sorted(asked.items()))
        if (where.path, asked.get("start") or asked.get("cursor")) in Stub.broken:
            self.send_response(404)
            self.end_headers()
            return
        if where.path == "/ids":
            body = {"esearchresult": {"count": str(TOTALS[asked["term"]]), "webenv": f"W {asked['term']}", "querykey": "1", "idlist": []}}
        elif where.path == "/page":
            body = {"resultList": {"result": [{"pmid": f"{asked['history'][2:]}-{int(asked['start']) + k}"} for k in range(int(asked["size"]))]}}
        else:
            at = 0 if asked["cursor"] == "*" else int(asked["cursor"][1:])
            here = int(asked["size"]) if at < CURSORS[asked["term"]] and TOTALS[asked["term"]] else 0
            body = {"nextCursorMark": f"c{at + 1}" if here else asked["cursor"], "resultList": {"result": [{"pmid": f"{asked['term']}-{at}-{k}"} for k in range(here)]}}
        Stub.served[place] += 1
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    Stub.served, Stub.broken = Counter(), set()
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def searches(spark):
    return spark.createDataFrame([(f"s{k}", term) for k, term in enumerate(TOTALS)], "search string, term string")


def by_history(spark, server, cache):
    return S.history_search(searches(spark), cache, f"{server}/ids?term={{term}}&cap={{cap}}", f"{server}/page?history={{history}}&key={{key}}&start={{start}}&size={{size}}", 5, 18, attempts=1)


def by_cursor(spark, server, cache):
    return S.cursor_search(searches(spark), cache, f"{server}/next?term={{term}}&cursor={{cursor}}&size={{size}}", 4, 14, attempts=1)


def test_two_phases_resume(spark, server, tmp_path):
    cache = str(tmp_path / "cache")
    Stub.broken = {("/page", "10")}
    first = by_history(spark, server, cache)
    assert sorted((r.search, r.start) for r in first.collect()) == [("s0", 0), ("s0", 5), ("s0", 15), ("s1", 0), ("s1", 5)]
    assert [(r.search, r.page) for r in S.failures(spark, cache).collect()] == [("s0", 2)]
    Stub.broken = set()
    whole = by_history(spark, server, cache)
    assert sorted((r.search, r.page, r.start, r.records, r.total) for r in whole.collect()) == [("s0", 0, 0, 5, 23), ("s0", 1, 5, 5, 23), ("s0", 2, 10, 5, 23), ("s0", 3, 15, 3, 23), ("s1", 0, 0, 5, 7), ("s1", 1, 5, 2, 7)]
    assert set(Stub.served.values()) == {1} and len(Stub.served) == 9
    ids = {r.pmid for r in B.json_records(whole.select("search", "body")).select("pmid").collect()}
    assert len(ids) == 25 and "liver & lung-6" in ids
    assert S.failures(spark, cache).collect() == []


def test_cursors_resume_and_stop(spark, server, tmp_path):
    cache = str(tmp_path / "cache")
    Stub.broken = {("/next", "c1")}  # both searches with hits stop behind their first page
    assert sorted((r.search, r.page) for r in by_cursor(spark, server, cache).collect()) == [("s0", 0), ("s1", 0), ("s2", 0)]
    Stub.broken = set()
    out = by_cursor(spark, server, cache)
    assert sorted((r.search, r.page, r.cursor, r.records) for r in out.collect()) == [("s0", 0, "*", 4), ("s0", 1, "c1", 4), ("s0", 2, "c2", 4), ("s0", 3, "c3", 2), ("s1", 0, "*", 4), ("s1", 1, "c1", 4), ("s1", 2, "c2", 0), ("s2", 0, "*", 0)]
    assert set(Stub.served.values()) == {1}
    served = sum(Stub.served.values())
    by_cursor(spark, server, cache)
    assert sum(Stub.served.values()) == served


def test_pages_of_another_cursor_are_an_error(spark, server, tmp_path):
    cache = str(tmp_path / "cache")
    by_cursor(spark, server, cache)
    rows = spark.read.schema(S.PAGES).parquet(cache).collect()
    spoiled = [r.asDict() | ({"url": r["url"].replace("cursor=c1", "cursor=c7")} if r["search"] == "s0" and r["page"] == 1 else {}) for r in rows]
    other = str(tmp_path / "other")
    spark.createDataFrame([tuple(r.values()) for r in spoiled], S.PAGES).write.parquet(other)
    with pytest.raises(S.CursorMismatch, match="page 1 of s0"):
        by_cursor(spark, server, other)


def test_spoiled_and_missing_caches(spark, server, tmp_path):
    cache = str(tmp_path / "cache")
    by_history(spark, server, cache)
    rows = [tuple(r) for r in spark.read.schema(S.PAGES).parquet(cache).collect()]
    other = str(tmp_path / "other")
    spark.createDataFrame([(*r[:3], r[3] + "x" if r[1] == 0 else r[3], *r[4:]) for r in rows], S.PAGES).write.parquet(other)
    by_history(spark, server, other)
    assert sorted(Stub.served.values()) == [1] * 7 + [2] * 2  # only the two spoiled pages are fetched again
    none = spark.createDataFrame([], "search string, term string")
    assert S.cursor_search(none, str(tmp_path / "new"), server, 4, 8).collect() == [] and S.failures(spark, str(tmp_path / "new")).collect() == []
