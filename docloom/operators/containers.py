"""Text and metadata of office files and mail: zipped XML (OOXML, ODF), RTF and MIME messages, with bounds on what is unpacked."""

from __future__ import annotations

import email
import email.policy
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

#: Bytes of one entry of a zip, and of all that are read of a file, beyond which its text is refused.
ENTRY_BYTES, FILE_BYTES = 64 << 20, 256 << 20
#: The content types of the endings.
TYPES = {
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "odt": "application/vnd.oasis.opendocument.text",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "odp": "application/vnd.oasis.opendocument.presentation",
    "rtf": "application/rtf",
    "eml": "message/rfc822",
}
#: The entries that hold a file's text, in order.
_BODIES = {"docx": r"word/(document|footnotes|endnotes|comments)\.xml", "xlsx": r"xl/worksheets/sheet\d+\.xml", "pptx": r"ppt/slides/slide\d+\.xml"}


class TooLarge(ValueError):
    pass


def _local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


class _Zip:
    """Entries of a zip, read under the bounds whatever sizes its directory claims."""

    def __init__(self, content: bytes):
        self.zip, self.left = zipfile.ZipFile(io.BytesIO(content)), FILE_BYTES

    def names(self, pattern: str) -> list[str]:
        found = [n for n in self.zip.namelist() if re.fullmatch(pattern, n)]
        return sorted(found, key=lambda n: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", n)])

    def tree(self, name: str) -> ET.Element | None:
        if name not in self.zip.namelist():
            return None
        most = min(ENTRY_BYTES, self.left)
        with self.zip.open(name) as f:
            raw = f.read(most + 1)
        if len(raw) > most:
            raise TooLarge(name)
        self.left -= len(raw)
        return ET.fromstring(raw)


def _blocks(root: ET.Element, block: tuple[str, ...], text: tuple[str, ...], breaks: dict[str, str]) -> Iterator[str]:
    """The text of each block element; breaks: what stands for elements such as tabs."""
    for e in root.iter():
        if _local(e) in block:
            yield "".join((x.text or "") if _local(x) in text else breaks.get(_local(x), "") for x in e.iter())


def _properties(root: ET.Element | None) -> dict[str, str]:
    """Leaf values of a properties part, by name: dc:title, creator and the like."""
    return {} if root is None else {_local(e): e.text.strip() for e in root.iter() if len(e) == 0 and (e.text or "").strip()}


def _word(z: _Zip) -> Iterator[str]:
    for name in z.names(_BODIES["docx"]):
        yield from _blocks(z.tree(name), ("p",), ("t",), {"tab": "\t", "br": "\n", "cr": "\n"})


def _slides(z: _Zip) -> Iterator[str]:
    for name in z.names(_BODIES["pptx"]):
        yield from _blocks(z.tree(name), ("p",), ("t",), {"br": "\n"})


def _sheets(z: _Zip) -> Iterator[str]:
    """Each row of each sheet, its cells separated by tabs."""
    table = z.tree("xl/sharedStrings.xml")
    shared = [] if table is None else ["".join(t.text or "" for t in si.iter() if _local(t) == "t") for si in table if _local(si) == "si"]
    for name in z.names(_BODIES["xlsx"]):
        for row in (e for e in z.tree(name).iter() if _local(e) == "row"):
            cells = []
            for c in (c for c in row if _local(c) == "c"):
                value = next((v.text or "" for v in c if _local(v) == "v"), "")
                if c.get("t") == "s":
                    value = shared[int(value)] if value.isdigit() and int(value) < len(shared) else ""
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter() if _local(t) == "t")
                cells.append(value)
            yield "\t".join(cells)


def _open_document(z: _Zip) -> Iterator[str]:
    """Paragraphs and headings, and each row of a table, its cells separated by tabs."""

    def walk(e: ET.Element) -> Iterator[str]:
        if _local(e) == "table-row":
            yield "\t".join("".join(c.itertext()) for c in e if _local(c).endswith("table-cell"))
        elif _local(e) in ("p", "h"):
            yield "".join(e.itertext())
        else:
            for c in e:
                yield from walk(c)

    root = z.tree("content.xml")
    yield from walk(root) if root is not None else ()


#: Fixed words of RTF: destinations that hold no text of the document, and what control words stand for.
_RTF_SKIPPED = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "footer", "generator", "listtable", "listoverridetable", "rsidtbl", "themedata", "xmlnstbl", "filetbl"}
_RTF_SIGNS = {"par": "\n", "line": "\n", "sect": "\n", "page": "\n", "row": "\n", "tab": "\t", "cell": "\t", "emdash": "—", "endash": "–", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "bullet": "•"}
_RTF = re.compile(r"\\([a-z]{1,32})(-?\d{1,10})? ?|\\'([0-9a-fA-F]{2})|\\(\*)|\\([^a-z])|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.IGNORECASE)


def rtf_text(content: bytes) -> str:
    """The text of RTF: control words as signs or nothing, hidden destinations left out, characters by code page 1252 or as \\u."""
    out, stack, hidden, skip, fallback = [], [], False, 0, 1
    for word, number, code, star, sign, brace, text in _RTF.findall(content.decode("latin-1")):
        if brace == "{":
            stack.append((hidden, fallback))
        elif brace == "}":
            hidden, fallback = stack.pop() if stack else (False, 1)
        elif star or word.lower() in _RTF_SKIPPED:
            hidden = True
        elif word == "u" and number:
            if not hidden:
                out.append(chr(int(number) % 65536))
            skip = fallback
        elif word == "uc" and number:
            fallback = int(number)
        elif not hidden:
            shown = _RTF_SIGNS.get(word.lower(), "") if word else bytes.fromhex(code).decode("cp1252", "replace") if code else {"~": "\u00a0", "_": "-"}.get(sign, sign if sign in "\\{}" else "") if sign else text
            if skip and (code or text):
                shown, skip = ("", skip - 1) if code else (text[skip:], max(0, skip - len(text)))
            out.append(shown)
    return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def mail_text(content: bytes, of_html) -> tuple[str, dict[str, str]]:
    """The bodies of a message, the plain form of each where there is one, names of attachments, and its main headers. of_html: text of HTML."""
    message = email.message_from_bytes(content, policy=email.policy.default)
    found = {k: str(message[h]) for h, k in (("subject", "dc:title"), ("from", "creator"), ("to", "to"), ("date", "date")) if message[h]}
    parts, files = [], []

    def walk(part) -> None:
        if part.get_content_disposition() == "attachment":
            files.append(part.get_filename() or "")
        elif part.get_content_type() == "multipart/alternative":
            each = list(part.iter_parts())
            plain = [p for p in each if p.get_content_type() == "text/plain"]
            for p in plain[:1] or each[-1:]:
                walk(p)
        elif part.is_multipart():
            for p in part.iter_parts():
                walk(p)
        elif part.get_content_maintype() == "text":
            text = part.get_content()
            parts.append(of_html(text) if part.get_content_subtype() == "html" else text)

    walk(message)
    if files:
        found["attachments"] = ", ".join(files)
    return "\n".join(parts), found


def extract(content: bytes, name: str, of_html) -> tuple[str, dict[str, str]] | None:
    """(text, metadata) of an office file or mail, by its ending or its first bytes; None if it is none. A file beyond the bounds, or broken, raises ValueError."""
    kind = name.rpartition(".")[2].lower()
    if kind not in TYPES:
        kind = "rtf" if content.startswith(b"{\\rtf") else ""
    if not kind:
        return None
    if kind == "rtf":
        return rtf_text(content), {"content-type": TYPES[kind]}
    if kind == "eml":
        text, found = mail_text(content, of_html)
        return text, found | {"content-type": TYPES[kind]}
    try:
        z = _Zip(content)
        lines = {"docx": _word, "xlsx": _sheets, "pptx": _slides}.get(kind, _open_document)(z)
        text = "\n".join(line for line in lines if line.strip())
        found = _properties(z.tree("docProps/core.xml") if kind in _BODIES else z.tree("meta.xml"))
    except (zipfile.BadZipFile, ET.ParseError, RuntimeError, NotImplementedError) as problem:
        raise ValueError(f"{name} can't be read: {problem}") from problem
    return text, found | {"content-type": TYPES[kind]}
