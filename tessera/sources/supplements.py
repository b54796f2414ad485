"""Supplements to blocks: workbooks, delimited and plain text, by themselves or in archives within archives.

Files are read where they lie, one after the other in a task; members are opened from memory up to ``MEMBER_BYTES``, sheets are read row by row as the
XML comes, and a block has ``BLOCK_ROWS`` rows at most, so no row of the result holds a whole table. What cannot be read is a row with its error and stops nothing.
"""

from __future__ import annotations

import csv
import io
import re
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MEMBER_BYTES, DEPTH, BLOCK_ROWS = 256 << 20, 4, 200
SCHEMA = "file string, member string, section string, kind string, part int, first_row int, n_rows int, text string, error string"
FIELDS = pa.schema([(n, pa.int32() if k == "int" else pa.string()) for n, k in (x.split() for x in SCHEMA.split(", "))])
TABLES = {"csv": ",", "tsv": "\t"}
ARCHIVES = ("zip", "tar", "tgz", "gz")
PLACE = re.compile(r"([A-Z]+)(\d+)")


class Unreadable(ValueError):
    """Why a member gives no blocks."""


def unsafe(name: str) -> bool:
    """Whether a member would leave the folder that it is unpacked in."""
    plain = name.replace("\\", "/")
    return plain.startswith("/") or ".." in plain.split("/") or bool(re.match(r"^[A-Za-z]:", plain)) or "\x00" in name


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def events(raw: io.IOBase, *wanted: str) -> Iterator[ElementTree.Element]:
    """The wanted elements of an XML stream as they end; what has been given is freed. Documents with a type declaration are refused."""
    head = raw.read(2048)
    if b"<!DOCTYPE" in head.upper():
        raise Unreadable("declares a document type")
    parser = ElementTree.XMLPullParser(["end"])
    while head:
        parser.feed(head)
        for _, element in parser.read_events():
            if local(element.tag) in wanted:
                yield element
                element.clear()
        head = raw.read(1 << 16)
    parser.close()


def plain_text(element: ElementTree.Element) -> str:
    """The text of an item, of all its runs; phonetic hints are left out."""
    out = []
    for child in element:
        name = local(child.tag)
        if name == "t":
            out.append(child.text or "")
        elif name == "r":
            out += [x.text or "" for x in child if local(x.tag) == "t"]
    return "".join(out)


def column(letters: str) -> int:
    out = 0
    for letter in letters:
        out = 26 * out + ord(letter) - 64
    return out - 1


def cell_text(cell: ElementTree.Element, shared: list[str]) -> str:
    """A cell's value as text: of a formula its last result, nothing if that was not stored."""
    kind, value, inline = cell.get("t", "n"), None, ""
    for child in cell:
        name = local(child.tag)
        if name == "v":
            value = child.text or ""
        elif name == "is":
            inline = plain_text(child)
    if kind == "inlineStr":
        return inline
    if value is None:
        return ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "TRUE" if value.strip() == "1" else "FALSE"
    return value


def sheet_rows(raw: io.IOBase, shared: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(number, cells) of a sheet's rows; cells lie where their reference says, those without one behind the last. Of merged cells only the first has a value."""
    number = 0
    for row in events(raw, "row"):
        number = int(row.get("r") or number + 1)
        cells: list[str] = []
        for cell in row:
            if local(cell.tag) != "c":
                continue
            at = PLACE.match(cell.get("r", ""))
            place = column(at[1]) if at else len(cells)
            if place >= 16_384:
                raise Unreadable(f"column {cell.get('r')} is beyond a sheet's")
            cells += [""] * (place - len(cells))
            cells[place:] = [cell_text(cell, shared)]
        while cells and not cells[-1]:
            cells.pop()
        yield number, cells


def workbook_sheets(data: bytes) -> Iterator[tuple[str, Iterator[tuple[int, list[str]]]]]:
    """(name, rows) of a workbook's sheets, in its order."""
    book = zipfile.ZipFile(io.BytesIO(data))
    names = set(book.namelist())
    for x in book.infolist():
        if x.file_size > MEMBER_BYTES:
            raise Unreadable(f"{x.filename} is too large")
    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        with book.open("xl/sharedStrings.xml") as raw:
            shared = [plain_text(x) for x in events(raw, "si")]
    with book.open("xl/_rels/workbook.xml.rels") as raw:
        targets = {x.get("Id"): x.get("Target", "") for x in events(raw, "Relationship")}
    with book.open("xl/workbook.xml") as raw:
        sheets = [(x.get("name", ""), next((v for k, v in x.attrib.items() if local(k) == "id"), None)) for x in events(raw, "sheet")]
    for name, link in sheets:
        target = targets.get(link, "")
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        if path in names and "worksheets" in path:
            with book.open(path) as raw:
                yield name, sheet_rows(raw, shared)


def blocks(rows: Iterator[tuple[int, list[str]]]) -> Iterator[dict]:
    """Rows that have any text, as blocks of lines with tabs between cells."""
    held: list[str] = []
    first = part = 0
    for number, cells in rows:
        line = "\t".join(re.sub(r"[\t\r\n]+", " ", c) for c in cells)
        if not line.strip():
            continue
        first = first or number
        held.append(line)
        if len(held) == BLOCK_ROWS:
            yield {"kind": "table", "part": part, "first_row": first, "n_rows": len(held), "text": "\n".join(held)}
            held, first, part = [], 0, part + 1
    if held:
        yield {"kind": "table", "part": part, "first_row": first, "n_rows": len(held), "text": "\n".join(held)}


def members(data: bytes, kind: str) -> Iterator[tuple[str, int, bytes | None]]:
    """(name, bytes, content) of an archive's files; no content for those that are unsafe or too large."""
    give = lambda name, size, get: (name, size, None if unsafe(name) or size > MEMBER_BYTES else get())
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for x in z.infolist():
                if not x.is_dir():
                    yield give(x.filename, x.file_size, lambda x=x: z.read(x))
    else:
        with tarfile.open(fileobj=io.BytesIO(data)) as t:
            for x in t:
                if x.isfile():
                    yield give(x.name, x.size, lambda x=x: t.extractfile(x).read())
                elif x.issym() or x.islnk():
                    yield x.name, -1, None


def opened(data: bytes, name: str, path: str = "", depth: int = 0) -> Iterator[dict]:
    """The blocks and errors of a file or member, with ``member`` the way to it through its archives."""
    kind = name.lower().rsplit(".", 1)[-1] if "." in name else ""
    try:
        if kind == "xlsx":
            for sheet, rows in workbook_sheets(data):
                for block in blocks(rows):
                    yield {"member": path, "section": sheet} | block
        elif kind in TABLES:
            text = io.StringIO(data.decode("utf-8-sig", "replace"), newline="")
            for block in blocks(enumerate(csv.reader(text, delimiter=TABLES[kind]), 1)):
                yield {"member": path, "section": ""} | block
        elif kind == "txt":
            text = data.decode("utf-8-sig", "replace").strip()
            if text:
                yield {"member": path, "section": "", "kind": "paragraph", "part": 0, "text": text}
        elif kind in ARCHIVES:
            if depth == DEPTH:
                raise Unreadable("archives lie too deep in each other")
            for inner, size, content in members(data, kind):
                way = f"{path}!{inner}" if path else inner
                if content is None:
                    yield {"member": way, "error": "unsafe path" if unsafe(inner) else "link" if size < 0 else "too large"}
                else:
                    yield from opened(content, inner, way, depth + 1)
    except (zipfile.BadZipFile, tarfile.TarError, ElementTree.ParseError, EOFError, KeyError, IndexError, OSError, RuntimeError, NotImplementedError, ValueError, csv.Error, zlib.error) as e:
        yield {"member": path, "error": f"{type(e).__name__}: {e}"}


def supplement_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, member, section, kind, part, first_row, n_rows, text, error) of all files below ``path``.

    Kinds that are none of these (xlsx, csv, tsv, txt and archives of them) give no rows. Empty files and sheets give none either.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name, held, size = file.rsplit("/", 1)[-1], [], 0
                for row in opened(content.as_py(), name):
                    held.append({"file": name} | row)
                    size += len(row.get("text") or "")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, FIELDS)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, FIELDS)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, SCHEMA)
