"""WARC archives written and read by Spark, and the external merge of their capture index.

Payload digests are compared through a map-side aggregate, so the rows of a common payload
never meet; only digests that repeat are joined back, in a join that Spark broadcasts if their
written size allows and splits otherwise. A record is one text value whose
line separator is the record's closing blank lines, so Spark's own text writer makes the
archives in whatever store the shared folder is in. An archive is one gzip stream (offsets are those of the unpacked
one), bounded by records and, on average, by bytes, and is unpacked piece by piece. Each is
sorted by URL key and time as it is written: a run. Reading gives index entries; range partitions over the whole
sort key (a host with a third of the captures is split by time and id) each merge their
share of the runs with a loser tree, and the partitions in order are the global history.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import new_table, partitions_for, text_of, written

REVISIT_BYTES = 1000
RECORDS_A_FILE, BYTES_A_FILE = 20_000, 256 << 20
PIECE = 1 << 20
FIRST_CAPTURE = 1_704_067_200  # a page without a capture time is dated by its id, from 2024 on
# Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
INDEX = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured string, archive string, place int, record_offset long, record_bytes long"


def url_key(url: Column) -> Column:
    """A sort key that keeps a site together: host labels from the right, then port, path and query, in lower case."""
    whole = F.lower(F.coalesce(url, F.lit("")))
    parts = r"^(?:[a-z][a-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?(?:www\d*\.)?([^/:?#]*)([^#]*)"
    host = F.array_join(F.reverse(F.split(F.regexp_extract(whole, parts, 1), r"\.")), ",")
    return F.concat(host, F.lit(")"), F.regexp_extract(whole, parts, 2))


def marked(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Captures with digest, type and what a revisit refers to.

    Of equal payloads of at least ``least_bytes`` the largest id is the response. Rows that
    repeat that id are responses too; a null id never is the largest. Null html is empty, a
    null URL has the key ``)``, payloads are taken whole, however long, and an empty table gives no rows.
    """
    seconds = F.unix_timestamp(time_col) if time_col else F.lit(FIRST_CAPTURE) + F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    own = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\x00-\x20\x7f]", "").alias("url"),
        text_of(html_col).alias("payload"),
        F.timestamp_seconds(seconds).alias("at"),
    ).withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    common = own.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    keepers = written(common.drop("n"), "common-payloads")
    joined = own.join(keepers, ["digest", "size"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    return joined.withColumns({"url_key": url_key(F.col("url")), "refers_to": F.when(revisit, F.col("keeper"))}).drop("keeper")


def record() -> Column:
    """The text of a WARC record, without its closing blank lines."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("Payload-Length: "), F.col("size").cast("string")),
        F.concat(F.lit("URL-Key: "), F.col("url_key")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("refers_to")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_warc(pages: DataFrame, path: str, **columns) -> None:
    """Write ``pages`` as gzipped archives under ``path``, each sorted by URL key, time and id."""
    mean = pages.agg(F.avg(F.octet_length(text_of(columns.get("html_col", "html"))))).first()[0] or 0
    per_file = max(1, min(RECORDS_A_FILE, int(BYTES_A_FILE / (mean + 1))))
    runs = marked(pages, **columns).sortWithinPartitions("url_key", "at", "page_id")
    runs.select(record().alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


class WarcError(ValueError):
    """A record that breaks the format or does not match its digest."""


def unpacked(data: memoryview) -> Iterator[bytes]:
    """A gzip file's content in pieces; it may be made of several streams."""
    stream = zlib.decompressobj(31)
    for at in range(0, len(data), PIECE // 4):
        piece = bytes(data[at : at + PIECE // 4])
        while piece:
            if stream.eof:
                stream = zlib.decompressobj(31)
            yield stream.decompress(piece, PIECE)
            piece = stream.unconsumed_tail or stream.unused_data


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, block, offset and bytes of each record of an archive that comes in pieces; one record is held at a time."""
    pieces, held, at = iter(pieces), bytearray(), 0

    def more(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while more(1):
        end = -1
        while more(5) and held[:5] == b"WARC/" and (end := held.find(b"\r\n\r\n")) < 0 and more(len(held) + 1):
            pass
        if end < 0:
            raise WarcError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in held[:end].decode().split("\r\n")[1:])
        body, size = end + 4, end + 8 + int(head["Content-Length"])
        if not more(size) or held[size - 4 : size] != b"\r\n\r\n":
            raise WarcError(f"the record at byte {at} has a wrong length")
        yield head, bytes(held[body : size - 4]), at, size
        del held[:size]
        at += size


def number(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read_warc(spark, path: str) -> DataFrame:
    """An index entry per record, in the order of its archive; digests are computed from the payloads read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def entry(head: dict, block: bytes, *where) -> tuple:
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(head["Payload-Length"])
        if kind == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            size, said, digest = len(payload), digest, hashlib.sha1(payload).hexdigest()
            if digest != said:
                raise WarcError(f"{head['WARC-Record-ID']}: the payload does not match its digest")
        return number(head["WARC-Record-ID"]), size, digest, kind, number(head.get("WARC-Refers-To")), head["URL-Key"], head["WARC-Date"], *where

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in INDEX.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                found = records(unpacked(memoryview(content.as_buffer())))
                rows = [entry(h, b, path.rsplit("/", 1)[-1], k, at, size) for k, (h, b, at, size) in enumerate(found)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    return files.mapInArrow(parsed, INDEX)


class LoserTree:
    """Merge of sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.size = max(1, len(runs))
        self.loser = [-1] * self.size
        for k in range(self.size):
            self._play(k)

    def _beats(self, a: int, b: int) -> bool:
        done_a, done_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if done_a or done_b:
            return done_b and not done_a
        return self.runs[a][self.at[a]] <= self.runs[b][self.at[b]]

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.size) // 2
        while node:
            if self.loser[node] < 0:  # the first to come waits for its opponent
                self.loser[node] = winner
                return
            if not self._beats(winner, self.loser[node]):
                winner, self.loser[node] = self.loser[node], winner
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and self.at[k := self.loser[0]] < len(self.runs[k]):
            yield self.runs[k][self.at[k]]
            self.at[k] += 1
            self._play(k)


def merged(index: DataFrame) -> DataFrame:
    """The runs of ``index`` (from ``read_warc``) as one history: partitions hold ranges in order, rows in order.

    ``range_no`` and ``position`` give the global order. A partition's memory is its range's
    entries, without payloads.
    """
    spark = index.sparkSession
    ranges = index.repartitionByRange(partitions_for(spark), "url_key", "captured", "page_id", "archive", "place").sortWithinPartitions("archive", "place")
    schema = ranges.select("*", F.lit(0).alias("range_no"), F.lit(0).cast("long").alias("position")).schema

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filled = [b for b in batches if b.num_rows]
        if not filled:
            return
        table = pa.Table.from_batches(filled)
        runs: dict[str, list] = {}
        columns = [table.column(c).to_pylist() for c in ("url_key", "captured", "page_id", "archive")]
        for k, (key, time, page, archive) in enumerate(zip(*columns, strict=True)):
            runs.setdefault(archive, []).append((key, time, -(1 << 63) if page is None else page, k))
        order = [x[-1] for x in LoserTree(list(runs.values()))]
        out = table.take(pa.array(order))
        n = len(order)
        out = out.append_column("range_no", pa.array([TaskContext.get().partitionId()] * n, pa.int32())).append_column("position", pa.array(range(n), pa.int64()))
        yield from out.select(schema.names).to_batches(max_chunksize=10_000)

    return ranges.mapInArrow(merge, schema)


def archive_and_index(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back and merge their index; a row per page row, empty for no pages."""
    spark = pages.sparkSession
    path = path or new_table(spark, "warc")
    write_warc(pages, path, **columns)
    index = written(read_warc(spark, path), "index")
    return merged(index)


def op1_warc_index_merge(spark, sf_dir: str) -> DataFrame:
    index = archive_and_index(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""
