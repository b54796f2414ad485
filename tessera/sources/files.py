"""File sources: hashes and cached pages, JSON lines, delimited supplements, XML records, archives."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBER_BYTES = 64 << 20


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, bytes, sha256) of files below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def cached_pages(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest rows (name, status, sha256) with ``complete``: finished, there, and of the right hash."""
    have = files.select("name", F.col("sha256").alias("__now"))
    return manifest.join(have, "name", "left").withColumn("complete", (F.col("status") == "completed") & F.col("sha256").eqNullSafe(F.col("__now"))).drop("__now")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Records of JSON lines; broken lines fail the read if ``strict``, else keep their text in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def delimited(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    return spark.read.option("header", "true").option("sep", separator).option("multiLine", "true").option("quote", '"').option("escape", '"').csv(path)


def xml_records(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, bytes, sha256, text, error) of zip and tar archives.

    Members that would leave the folder, or are over ``MEMBER_BYTES``, give an error row;
    a broken archive gives one error row and stops nothing.
    """
    import hashlib

    def unsafe(name: str) -> bool:
        return name.startswith(("/", "\\")) or ".." in name.replace("\\", "/").split("/")

    def members(name: str, data: bytes):
        if zipfile.is_zipfile(io.BytesIO(data)):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for x in z.infolist():
                    if not x.is_dir():
                        yield x.filename, x.file_size, lambda x=x: z.read(x)
        else:
            with tarfile.open(fileobj=io.BytesIO(data)) as t:
                for x in t:
                    if x.isfile():
                        yield x.name, x.size, lambda x=x: t.extractfile(x).read()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("text", pa.string()), ("error", pa.string())])
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, name = [], path.rsplit("/", 1)[-1]
                try:
                    for member, size, get in members(name, content.as_py()):
                        row = {"archive": name, "member": member, "bytes": size}
                        if unsafe(member) or size > MEMBER_BYTES:
                            rows.append(row | {"error": "unsafe path" if unsafe(member) else "too large"})
                            continue
                        raw = get()
                        rows.append(row | {"sha256": hashlib.sha256(raw).hexdigest(), "text": raw.decode("utf-8", "replace")})
                except (zipfile.BadZipFile, tarfile.TarError, EOFError) as e:
                    rows.append({"archive": name, "error": type(e).__name__})
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, "archive string, member string, bytes long, sha256 string, text string, error string")
