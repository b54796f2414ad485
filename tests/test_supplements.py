"""Workbooks and archives made here: sparse, formula, merged and rich cells, nested archives, hostile paths, broken files."""

import io
import tarfile
import zipfile

from tessera.sources import supplements as S

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def packed(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


def workbook(sheets, strings=()):
    files = {
        "xl/workbook.xml": f"<workbook {MAIN}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="{"/xl/" if k else ""}worksheets/s{k}.xml"/>' for k in range(len(sheets))) + "</Relationships>",
        "xl/sharedStrings.xml": f"<sst {MAIN}>" + "".join(strings) + "</sst>",
    }
    for k, body in enumerate(sheets.values()):
        files[f"xl/worksheets/s{k}.xml"] = f"<worksheet {MAIN}><sheetData>{body}</sheetData><mergeCells><mergeCell ref='A1:B1'/></mergeCells></worksheet>"
    return packed(files)


BOOK = workbook(
    {
        "Doses": '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"/><c r="D1" t="s"><v>1</v></c></row><row r="3"><c r="B3"><f>1+1</f><v>2</v></c><c r="C3"><f>A9</f></c><c r="D3" t="str"><f>x</f><v>a&amp;b</v></c><c r="AA3" t="b"><v>1</v></c></row><row><c><v>5</v></c><c t="inlineStr"><is><t>in</t></is></c><c t="e"><v>#N/A</v></c></row>',
        "Empty": "",
        "Long": "".join(f'<row r="{k}"><c r="A{k}"><v>{k}</v></c></row>' for k in range(1, 452)),
    },
    ["<si><t>merged head</t></si>", "<si><r><t>rich </t></r><r><t>text</t></r><rPh><t>hint</t></rPh></si>"],
)


def test_cells_rows_and_blocks(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(BOOK)
    rows = sorted(S.supplement_blocks(spark, str(tmp_path)).collect(), key=lambda r: (r.section, r.part))
    assert [(r.section, r.part, r.first_row, r.n_rows) for r in rows] == [("Doses", 0, 1, 3), ("Long", 0, 1, 200), ("Long", 1, 201, 200), ("Long", 2, 401, 51)]
    head, formulas, bare = rows[0].text.split("\n")
    assert head == "merged head\t\t\trich text" and bare == "5\tin\t#N/A"
    assert formulas.split("\t") == ["", "2", "", "a&b", *[""] * 22, "TRUE"]


def tarred(files):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, data in files.items():
            info = tarfile.TarInfo(name)
            if data is None:
                info.type, info.linkname = tarfile.SYMTYPE, "/etc/passwd"
                t.addfile(info)
            else:
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archives_in_archives(spark, tmp_path):
    inner = packed({"deep/b.xlsx": BOOK, "t.csv": '\ufeffa,b\n"x, y",1\n\n', "../out.txt": "no", "p.pdf": "ignored"})
    whole = tarred({"in.zip": inner, "n.txt": "  note \n".encode(), "/abs.txt": b"no", "C:\\w.txt": b"no", "link.txt": None, "broken.zip": b"PK no zip", "bad.xlsx": packed({"x": "y"}), "dtd.xlsx": packed({"xl/_rels/workbook.xml.rels": "<!DOCTYPE a><a/>"}), "e.txt": b""})
    (tmp_path / "s.tar.gz").write_bytes(whole)
    (tmp_path / "only.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "torn.xlsx").write_bytes(BOOK[:500])
    rows = S.supplement_blocks(spark, str(tmp_path)).collect()
    text = {(r.file, r.member, r.section, r.part): (r.kind, r.text) for r in rows if r.error is None}
    assert text["s.tar.gz", "in.zip!t.csv", "", 0] == ("table", "a\tb\nx, y\t1") and text["s.tar.gz", "n.txt", "", 0] == ("paragraph", "note")
    assert text["only.tsv", "", "", 0] == ("table", "a\tb\n1\t2") and len(text) == 7
    errors = {(r.file, r.member): r.error for r in rows if r.error}
    assert {k: v for k, v in errors.items() if v in ("unsafe path", "link")} == {("s.tar.gz", "in.zip!../out.txt"): "unsafe path", ("s.tar.gz", "/abs.txt"): "unsafe path", ("s.tar.gz", "C:\\w.txt"): "unsafe path", ("s.tar.gz", "link.txt"): "link"}
    assert "BadZipFile" in errors["s.tar.gz", "broken.zip"] and "KeyError" in errors["s.tar.gz", "bad.xlsx"] and "document type" in errors["s.tar.gz", "dtd.xlsx"] and ("torn.xlsx", "") in errors
    assert len(errors) == 8


def test_archives_too_deep_are_told():
    data = packed({"a.txt": "x"})
    for _ in range(S.DEPTH):
        data = packed({"z.zip": data})
    assert [r["error"] for r in S.opened(data, "z.zip")] == ["Unreadable: archives lie too deep in each other"]
