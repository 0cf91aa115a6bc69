"""Whole markup documents: one pass of a stream parser per document.

The parser resolves prefixes to addresses scope by scope and checks the document to its end. Besides, a stack of open
elements is kept, and the places in the document that are written otherwise in the result. An element is the
document's own writing between its tags, so that nesting of any depth, prefixes bound anew, comments and CDATA
sections need no pattern. Rows are independent: nothing is shuffled, and a task holds one document at a time.

Strings of markup that need not parse are for ``notemill.operators.markup``.
"""

import bisect
import re
from dataclasses import dataclass, field
from xml.parsers import expat
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from notemill import fixed_values as fv

ELEMENT = "struct<position:int,depth:int,id:string,note:string,element:string>"
PARSED = f"struct<message:string,line:int,column:int,elements:array<{ELEMENT}>>"

_TAG = re.compile(rb"""<(?:[^>"']|"[^"]*"|'[^']*')*>""")
_ATTRIBUTE = re.compile(rb"""(\s+)([^\s=>"'/]+)(\s*=\s*(?:"[^"]*"|'[^']*'))""")
_TAG_PREFIX = re.compile(rb"^(</?)[^\s>/:]+:")


@dataclass
class Found:
    """An element that was asked for."""
    start: int
    depth: int
    id: str | None
    end: int = 0
    notes: str | None = None
    paragraph: str | None = None


@dataclass
class Open:
    """An element whose end has not come yet: what it is to which found element, and its text as far as it is wanted."""
    start: int
    found: Found | None = None
    role: str = ""
    takes_text: bool = False
    tag_end: int = -1
    text: list[str] = field(default_factory=list)


def plain_tag(tag: bytes) -> bytes:
    """A tag without prefixes, declarations of them, and the dropped attribute."""
    def attribute(match: re.Match) -> bytes:
        space, name, value = match.groups()
        local = name.rpartition(b":")[2]
        if name == b"xmlns" or name.startswith(b"xmlns:") or local == fv.DROPPED_ATTRIBUTE.encode():
            return b""
        return space + local + value

    tag = _TAG_PREFIX.sub(rb"\1", tag)
    return _ATTRIBUTE.sub(attribute, tag) if b"=" in tag else tag


class Reader:
    """Reads one document: all elements below the root with the root's address and the name ``tag``."""

    def __init__(self, data: bytes, tag: str, paragraph: str | None, full_text: bool, dropped: tuple[str, ...]):
        self.data, self.tag, self.paragraph, self.full_text, self.dropped = data, tag, paragraph, full_text, dropped
        self.open: list[Open] = []
        self.found: list[Found] = []
        self.root = ""
        self.inside = 0                                     # open elements that were asked for
        self.edits: list[tuple[int, int, bytes]] = []       # start, end, what stands there in the result
        self.parser = parser = expat.ParserCreate("utf-8", "}")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self.start, self.end, self.text
        parser.CommentHandler = lambda _: self.leave_out(b"-->")
        parser.ProcessingInstructionHandler = lambda *_: self.leave_out(b"?>")
        parser.StartCdataSectionHandler = self.section

    def read(self) -> dict:
        try:
            self.parser.Parse(self.data, True)
        except expat.ExpatError as error:
            return {"message": expat.ErrorString(error.code), "line": error.lineno, "column": error.offset, "elements": []}
        self.edits.sort(key=lambda e: (e[0], -e[1]))
        elements = [{"position": i, "depth": f.depth, "id": f.id, "note": self.note(f), "element": self.written(f)} for i, f in enumerate(self.found)]
        return {"message": None, "line": None, "column": None, "elements": elements}

    @staticmethod
    def note(found: Found) -> str | None:
        """Text of the notes' first paragraph; where that has none, of the notes themselves."""
        text = found.paragraph or found.notes
        return text.strip() if text else None

    def written(self, found: Found) -> str:
        out, at = [], found.start
        for start, end, instead in self.edits[bisect.bisect_left(self.edits, (found.start,)):]:
            if start >= found.end:
                break
            if start >= at:
                out += [self.data[at:start], instead]
                at = end
        return b"".join([*out, self.data[at:found.end]]).decode()

    def edit_tag(self, at: int) -> int:
        """The end of the tag that begins here; within an element that was asked for it is written plainly."""
        end = _TAG.match(self.data, at).end()
        if self.inside:
            tag = self.data[at:end]
            plain = plain_tag(tag)
            if plain != tag:
                self.edits.append((at, end, plain))
        return end

    def leave_out(self, mark: bytes) -> None:
        at = self.parser.CurrentByteIndex
        self.edits.append((at, self.data.index(mark, at + 2) + len(mark), b""))

    def section(self) -> None:
        at = self.parser.CurrentByteIndex
        start = at + len("<![CDATA[")
        end = self.data.index(b"]]>", start)
        self.edits.append((at, end + 3, escape(self.data[start:end].decode()).encode()))

    def start(self, name: str, attributes: dict[str, str]) -> None:
        at = self.parser.CurrentByteIndex
        address, _, local = name.rpartition("}")
        if not self.open:
            self.root = address
            self.open.append(Open(at, tag_end=_TAG.match(self.data, at).end()))
            return
        parent, element = self.open[-1], Open(at)
        if not (parent.role == "paragraph" and self.full_text):
            parent.takes_text = False
        own = parent.found
        if (address, local) == (self.root, self.tag):
            element.found, element.role = Found(at, len(self.open), attributes.get("id")), "found"
            self.found.append(element.found)
            self.inside += 1
        elif parent.role == "found" and (address, local) == (self.root, "notes") and own.notes is None:
            own.notes, element.found, element.role, element.takes_text = "", own, "notes", True
        elif parent.role == "notes" and local == "p" and self.paragraph in (None, address) and own.paragraph is None:
            own.paragraph, element.found, element.role, element.takes_text = "", own, "paragraph", True
        elif self.full_text and parent.role in ("paragraph", "in paragraph"):
            element.found, element.role, element.takes_text, element.text = own, "in paragraph", True, parent.text
        self.open.append(element)
        element.tag_end = self.edit_tag(at)

    def text(self, data: str) -> None:
        if self.open[-1].takes_text:
            self.open[-1].text.append(data)

    def end(self, name: str) -> None:
        at = self.parser.CurrentByteIndex
        element = self.open.pop()
        empty = at == element.tag_end and self.data[at - 2:at] == b"/>"     # <a/> ends where its only tag does
        end = at if empty else self.edit_tag(at)
        if element.role == "found":
            element.found.end = end
            self.inside -= 1
        elif element.role in ("notes", "paragraph"):
            setattr(element.found, element.role, "".join(element.text))
        if element.role != "found" and name.rpartition("}")[2] in self.dropped:
            self.edits.append((element.start, end, b""))


def parsed(document: Column, tag: str, paragraph: str | None = fv.PARAGRAPH_ADDRESS, full_text: bool = False,
           dropped: tuple[str, ...] = fv.DROPPED_ELEMENTS) -> Column:
    """``message``, ``line`` and ``column`` of the first place where a document does not parse, else its ``elements``.

    Elements are all descendants of the root with its address and the name ``tag``, nested ones too, in document
    order: their ``position`` and ``depth``, the attribute ``id`` (null when absent), ``note`` and the ``element``
    without ``dropped`` subtrees, comments, instructions, prefixes and the dropped attribute. The note is the text of the
    first paragraph (address ``paragraph``, None for any) that is a child of the first ``notes`` child, up to its
    first child or whole with ``full_text``; if that is empty, the notes' own leading text; else null. A document
    that does not parse has no elements; an empty one does not parse. Null gives null.
    """
    @F.arrow_udf(PARSED)
    def read(texts: pa.Array) -> pa.Array:
        rows = [None if t is None else Reader(t.encode(), tag, paragraph, full_text, dropped).read() for t in (v.as_py() for v in texts)]
        kind = pa.struct([("message", pa.string()), ("line", pa.int32()), ("column", pa.int32()), ("elements", pa.list_(pa.struct(
            [("position", pa.int32()), ("depth", pa.int32()), ("id", pa.string()), ("note", pa.string()), ("element", pa.string())])))])
        return pa.array(rows, type=kind)

    return read(document)
