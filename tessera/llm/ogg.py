"""Ogg media columns: pages with checksums, packets from lacing values, logical streams and granule times.

The container carries 8-bit PCM. Frames of ``FRAME`` samples alternate between the
logical streams, so that reading needs the whole chain: page checksums, lacing,
demultiplexing and the granule positions that put the frames back in time order.
Encoding and decoding work row by row inside Arrow batches; no row meets another,
so there is no shuffle and a lost executor costs its own tasks only.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, documents, sliced, text_of

FRAME = 576
RATE = 8000
STREAMS = 2
FRAMES_A_PAGE = 85  # three lacing values a frame; a page has 255 at most
# Fixed values of the Ogg page format (RFC 3533).
CAPTURE = b"OggS"
HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
CODEC = struct.Struct("<8sIHBB")  # magic, rate, frame, streams, index
MAGIC = b"\x7fPCM8BIT"
FLIP = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


class OggError(ValueError):
    """A page or packet that breaks the format."""


def page_checksum(page: bytes) -> bytes:
    """The four checksum bytes: CRC-32 by 0x04c11db7, not reflected, from zero.

    zlib's CRC is the reflected one, so the bits of each byte and of the result are turned round.
    """
    crc = zlib.crc32(page.translate(FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return crc.to_bytes(4, "big").translate(FLIP)


def lacing(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


def page(packets: list[bytes], flags: int, granule: int, serial: int, sequence: int) -> bytes:
    table = b"".join(lacing(len(x)) for x in packets)
    raw = HEAD.pack(CAPTURE, 0, flags, granule, serial, sequence, 0, len(table)) + table + b"".join(packets)
    return raw[:22] + page_checksum(raw) + raw[26:]


def mux(payload: bytes, streams: int = STREAMS, rate: int = RATE) -> bytes:
    """``payload`` (8-bit samples, a multiple of FRAME) as an Ogg physical stream."""
    count = len(payload) // FRAME
    out, sequence = [], [1] * streams
    for s in range(streams):
        last = LAST if s >= count else 0
        out.append(page([CODEC.pack(MAGIC, rate, FRAME, streams, s)], FIRST | last, 0, s + 1, 0))
    step = streams * FRAMES_A_PAGE
    for start in range(0, count, step):
        for s in range(streams):
            own = range(start + s, min(start + step, count), streams)
            if own:
                last = LAST if own[-1] + streams >= count else 0
                packets = [payload[k * FRAME : (k + 1) * FRAME] for k in own]
                out.append(page(packets, last, (own[-1] + 1) * FRAME, s + 1, sequence[s]))
                sequence[s] += 1
    return b"".join(out)


def pages(media: bytes) -> Iterator[tuple[int, int, int, int, bytes, int]]:
    """Verified pages: flags, granule, serial, sequence, lacing table and where the body starts."""
    at = 0
    while at < len(media):
        if len(media) - at < HEAD.size or media[at : at + 4] != CAPTURE:
            raise OggError(f"no page at byte {at}")
        _, version, flags, granule, serial, sequence, _, segments = HEAD.unpack_from(media, at)
        body = at + HEAD.size + segments
        table = media[at + HEAD.size : body]
        end = body + sum(table)
        if version or len(table) < segments or end > len(media):
            raise OggError(f"broken page at byte {at}")
        if page_checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != media[at + 22 : at + 26]:
            raise OggError(f"wrong checksum at byte {at}")
        yield flags, granule, serial, sequence, table, body
        at = end


def demux(media: bytes) -> dict[int, list[tuple[bytes, int, bool]]]:
    """Packets by logical stream: bytes, granule of the page that completes it, and whether it is the last to end there."""
    done: dict[int, list[tuple[bytes, int, bool]]] = {}
    open_part: dict[int, list[bytes]] = {}
    expected: dict[int, int] = {}
    ended: set[int] = set()
    for flags, granule, serial, sequence, table, at in pages(media):
        if (flags & FIRST != 0) != (serial not in expected) or serial in ended:
            raise OggError(f"stream {serial} starts or goes on out of turn")
        if sequence != expected.get(serial, sequence):
            raise OggError(f"page lost in stream {serial}")
        expected[serial] = sequence + 1
        part = open_part.pop(serial, [])
        if bool(part) != bool(flags & CONTINUED):
            raise OggError(f"stream {serial} continues no packet")
        own, start = [], at
        for value in table:
            at += value
            if value < 255:
                own.append(b"".join([*part, media[start:at]]))
                part, start = [], at
        if table and table[-1] == 255:
            open_part[serial] = [*part, media[start:at]]
        done.setdefault(serial, []).extend((x, granule, k == len(own) - 1) for k, x in enumerate(own))
        if flags & LAST:
            ended.add(serial)
    if open_part or ended != set(expected):
        raise OggError("the media ends inside a stream")
    return done


def timed(media: bytes) -> list[tuple[int, int, int, bytes]]:
    """Data packets as (first sample, rate, serial, bytes), in time order.

    A page's granule is the time at the end of its last packet; earlier packets of
    that page lie one interleave step back each.
    """
    found = []
    for serial, packets in demux(media).items():
        magic, rate, frame, streams, _ = CODEC.unpack(packets[0][0]) if len(packets[0][0]) == CODEC.size else (b"", 0, 0, 0, 0)
        if magic != MAGIC:
            raise OggError(f"stream {serial} has no known codec header")
        back = 0
        for data, granule, last in reversed(packets[1:]):
            back = 0 if last else back + 1
            found.append((granule - len(data) - back * streams * frame, rate, serial, data))
    return sorted(found, key=lambda x: x[:3])


def payload_of(media: bytes) -> bytes:
    at, out = 0, []
    for start, _, _, data in timed(media):
        if start != at:
            raise OggError(f"samples {at} to {start} are missing")
        out.append(data)
        at += len(data)
    return b"".join(out)


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % FRAME or (0 if text else FRAME))


def feature(samples: bytes) -> str:
    """Exact whole-number features of the samples: length in time, sum, power, crossings of the midline."""
    x = np.frombuffer(samples, np.uint8)
    above = x >= 128
    power = int((np.bincount(x, minlength=256) * np.arange(256) ** 2).sum())
    return f"us={len(x) * 1_000_000 // RATE};sum={int(x.sum(dtype=np.int64))};power={power};crossings={int((above[1:] != above[:-1]).sum())};peak={int(x.max())}"


def to_ogg(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``n_bytes`` and ``media``, an Ogg file with the padded UTF-8 bytes as samples.

    A null text is an empty one, whose payload is one frame of padding. A null id stays
    null, repeated rows stay repeated, other columns are left out, an empty table gives an empty one.
    """
    bounded_batches(df.sparkSession)
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("raw"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raw = [x.as_buffer().to_pybytes() for x in batch.column("raw")]
            media = [mux(padded(x)) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return slim.mapInArrow(encode, "doc_id long, n_bytes long, media binary")


def read_ogg(df: DataFrame) -> DataFrame:
    """Read a ``media`` column back: digests and features of the payload, per row.

    ``error`` is null for sound media; for null, cut or altered media it says what is
    wrong and the payload columns are null. Rows are never dropped.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"

    def measure(media: bytes | None) -> tuple:
        if media is None:
            return None, None, None, None, None, None, "no media"
        own = len(media), hashlib.sha256(media).hexdigest()
        try:
            x = payload_of(media)
        except OggError as e:
            return None, None, None, *own, None, str(e)
        return len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-32:]), *own, feature(x) if x else "", None

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"]
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            rows = [measure(x.as_buffer().to_pybytes() if x.is_valid else None) for x in batch.column("media")]
            made = [pa.array(list(x), k) for x, k in zip(zip(*rows), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *made], names=names)

    return df.select("doc_id", "n_bytes", "media").mapInArrow(decode, schema)


def ogg_packets(df: DataFrame) -> DataFrame:
    """A row per data packet of sound media: ``doc_id, serial, packet_no, first_sample, timestamp_us, n_bytes``."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for doc, media in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                try:
                    found = timed(media or b"")
                except OggError:
                    continue
                rows += [{"doc_id": doc, "serial": s, "packet_no": k, "first_sample": at, "timestamp_us": at * 1_000_000 // rate, "n_bytes": len(x)} for k, (at, rate, s, x) in enumerate(found)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.int64()) for n in ("doc_id", "serial", "packet_no", "first_sample", "timestamp_us", "n_bytes")]))

    return df.select("doc_id", "media").mapInArrow(split, "doc_id long, serial long, packet_no long, first_sample long, timestamp_us long, n_bytes long")


def op7_ogg_media(spark, sf_dir: str) -> DataFrame:
    return read_ogg(to_ogg(documents(spark, sf_dir)))
