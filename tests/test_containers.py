import io
import zipfile
from email.message import EmailMessage

import pytest

from docloom.operators import containers, documents, enrich


def packed(**entries) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in entries.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml"), text)
    return out.getvalue()


W, A, S = "xmlns:w='urn:w'", "xmlns:a='urn:a'", "xmlns='urn:s'"
DOCX = packed(
    word__document_xml=f"<w:document {W}><w:body><w:p><w:r><w:t>Hello </w:t></w:r><w:r><w:t>world</w:t><w:tab/><w:t>x</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>in a cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>",
    word__footnotes_xml=f"<w:footnotes {W}><w:p><w:r><w:t>A note &amp; more</w:t></w:r></w:p></w:footnotes>",
    docProps__core_xml="<cp:p xmlns:cp='urn:cp' xmlns:dc='urn:dc'><dc:title>The title</dc:title><dc:creator>Ann</dc:creator></cp:p>",
)
XLSX = packed(
    xl__sharedStrings_xml=f"<sst {S}><si><t>name</t></si><si><r><t>to</t></r><r><t>tal</t></r></si></sst>",
    xl__worksheets__sheet1_xml=f"<worksheet {S}><sheetData><row><c t='s'><v>0</v></c><c t='s'><v>1</v></c></row><row><c t='inlineStr'><is><t>Ann</t></is></c><c><v>42.5</v></c></row></sheetData></worksheet>",
    xl__worksheets__sheet10_xml=f"<worksheet {S}><sheetData><row><c><v>10</v></c></row></sheetData></worksheet>",
    xl__worksheets__sheet2_xml=f"<worksheet {S}><sheetData><row><c><v>2</v></c></row></sheetData></worksheet>",
)
PPTX = packed(**{f"ppt__slides__slide{n}_xml": f"<p:sld xmlns:p='urn:p' {A}><a:p><a:r><a:t>Slide {n}</a:t></a:r></a:p></p:sld>" for n in (1, 2, 11)})
ODT = packed(
    content_xml="<o:d xmlns:o='urn:o' xmlns:t='urn:t'><t:h>Head</t:h><t:p>One <t:span>two</t:span></t:p><t:table><t:table-row><t:table-cell><t:p>a</t:p></t:table-cell><t:table-cell><t:p>b</t:p></t:table-cell></t:table-row></t:table></o:d>",
    meta_xml="<m xmlns:dc='urn:dc'><dc:title>Open</dc:title></m>",
)
RTF = (rb"{\rtf1\ansi{\fonttbl{\f0 Arial;}}{\*\generator tool;}Plain \b bold\b0\par caf\'e9 " + b"\\" + b"u8364?uro " + rb"\{x\}{\header hidden}\tab end}")


def mail() -> bytes:
    m = EmailMessage()
    m["Subject"], m["From"], m["To"] = "Größe", "Ann <a@x.org>", "b@x.org"
    m.set_content("plain body ü")
    m.add_alternative("<p>html body</p>", subtype="html")
    m.add_attachment(b"\x00\x01", maintype="application", subtype="octet-stream", filename="raw.bin")
    return m.as_bytes()


@pytest.mark.parametrize("name, content, text, some", [
    ("a.docx", DOCX, "Hello world x\nin a cell\nA note & more", {"title": "The title", "creator": "Ann"}),
    ("a.XLSX", XLSX, "name total\nAnn 42.5\n2\n10", {}),
    ("a.pptx", PPTX, "Slide 1\nSlide 2\nSlide 11", {}),
    ("a.odt", ODT, "Head\nOne two\na b", {"title": "Open"}),
    ("a.rtf", RTF, "Plain bold\ncafé €uro {x} end", {}),
    ("noending", RTF, "Plain bold\ncafé €uro {x} end", {}),
    ("a.eml", mail(), "plain body ü", {"dc:title": "Größe", "attachments": "raw.bin"}),
])
def test_text_of(name, content, text, some):
    got, found = enrich.extract(content, name)
    assert got == text and some.items() <= found.items() and found["content-length"] == str(len(content))
    assert found["content-type"] in containers.TYPES.values()


def test_bounds_and_broken_files(monkeypatch):
    for content, name in ((b"no zip", "a.docx"), (DOCX[:60], "a.docx"), (packed(word__document_xml="<broken"), "a.docx")):
        assert enrich.extract(content, name) is None
    assert enrich.extract(packed(other_xml="<a/>"), "a.docx")[0] == "" and enrich.extract(b"{\\rtf1 }}}{{", "b.rtf") is not None
    bomb = packed(word__document_xml=f"<w:document {W}><w:p><w:t>" + "x" * 100_000 + "</w:t></w:p></w:document>")
    assert len(bomb) < 2000
    monkeypatch.setattr(containers, "ENTRY_BYTES", 50_000)
    assert enrich.extract(bomb, "a.docx") is None


def test_html_only_mail():
    m = EmailMessage()
    m["Subject"] = "s"
    m.set_content("<p>Only &amp; html</p>", subtype="html")
    assert enrich.extract(m.as_bytes(), "x.eml")[0] == "Only & html"


def test_documents_get_their_text(spark):
    rows = documents.blank(spark.createDataFrame([("/a.docx", DOCX, None), ("/b.txt", b"plain", None), ("/c.docx", b"broken", None)], "URI string, content binary, format string"))
    got = {r["URI"]: r["extracted_text"] for r in enrich.with_text(rows).collect()}
    assert got == {"/a.docx": "Hello world x\nin a cell\nA note & more", "/b.txt": "plain", "/c.docx": None}
