"""Pages of PDF files: cross-reference tables and streams, object streams, and the page tree with what pages inherit.

What counts is what the newest cross-references reach from the catalogue: deleted, replaced and orphaned objects are in
the file and play no part. Nothing is drawn; streams are read where they hold references or objects.
"""

from __future__ import annotations

import re
import zlib
from typing import Any, NamedTuple

import numpy as np

BLANK, MOST_DEPTH, MOST_BYTES = b"\0\t\n\f\r ", 200, 1 << 28
TOKEN = re.compile(rb"[\0\t\n\f\r ]*(?:%[^\r\n]*[\0\t\n\f\r ]*)*(<<|>>|[\[\]]|\(|<[0-9A-Fa-f\0\t\n\f\r ]*>|/[^\0\t\n\f\r ()<>\[\]{}/%]*|[^\0\t\n\f\r ()<>\[\]{}/%]+|[{})>])")
NUMBER = re.compile(rb"[+-]?(?:\d+\.?\d*|\.\d+)$")
REFERENCE = re.compile(rb"[\0\t\n\f\r ]+(\d+)[\0\t\n\f\r ]+R(?![^\0\t\n\f\r ()<>\[\]{}/%])")
OBJECT = re.compile(rb"(?<!\d)(\d{1,10})[\0\t\n\f\r ]+(\d{1,5})[\0\t\n\f\r ]+obj(?![A-Za-z])")
#: Width and height in points of a page that names no box: A4.
A4 = (595.0, 842.0)


class Ref(NamedTuple):
    number: int


class Stream(NamedTuple):
    head: dict
    start: int


class Broken(ValueError):
    pass


def parse(data: bytes, at: int, depth: int = 0) -> tuple[Any, int]:
    """The object at a place, and where it ends. Names are texts with a slash, other texts stay bytes."""
    if depth > MOST_DEPTH:
        raise Broken("objects are nested too deeply")
    m = TOKEN.match(data, at)
    if not m:
        raise Broken("the file ends within an object")
    token, at = m[1], m.end()
    if token == b"<<":
        out: dict[str, Any] = {}
        while True:
            key, at = parse(data, at, depth + 1)
            if key == b">>":
                return out, at
            value, at = parse(data, at, depth + 1)
            if value == b">>":
                return out, at
            if isinstance(key, str):
                out[key] = value
    if token == b"[":
        items: list = []
        while True:
            value, at = parse(data, at, depth + 1)
            if value == b"]":
                return items, at
            items.append(value)
    if token == b"(":
        end, level = at, 1
        while level and end < len(data):
            level += {40: 1, 41: -1}.get(data[end], 0)
            end += 2 if data[end] == 92 else 1
        return ("text", data[at : end - 1]), end
    if token[:1] == b"/":
        return "/" + re.sub(rb"#([0-9A-Fa-f]{2})", lambda h: bytes([int(h[1], 16)]), token[1:]).decode("latin-1"), at
    if NUMBER.match(token):
        if token.isdigit() and (r := REFERENCE.match(data, at)):
            return Ref(int(token)), r.end()
        return (int(token) if token.lstrip(b"+-").isdigit() else float(token)), at
    return {b"true": True, b"false": False, b"null": None}.get(token, token), at


def unpredicted(data: bytes, columns: int) -> bytes:
    """Rows of bytes written as differences to what is left of and above them (PNG's five filters)."""
    width, out, above = columns + 1, bytearray(), bytearray(columns)
    for at in range(0, len(data) - width + 1, width):
        kind, row = data[at], bytearray(data[at + 1 : at + width])
        if kind == 2:
            row = bytearray((np.frombuffer(row, np.uint8) + np.frombuffer(above, np.uint8)).tobytes())
        elif kind:
            for i in range(columns):
                left, up, corner = (row[i - 1], above[i], above[i - 1]) if i else (0, above[0], 0)
                nearest = min((left, up, corner), key=lambda x, s=left + up - corner: abs(s - x))
                row[i] = (row[i] + {1: left, 3: (left + up) // 2, 4: nearest}.get(kind, 0)) & 255
        out += row
        above = row
    return bytes(out)


class Pdf:
    """The objects of a file by number: a place, or an object stream and a place within it."""

    def __init__(self, data: bytes):
        self.data, self.places, self.trailer = data, {}, {}
        self.opened: dict[int, tuple[bytes, list[int]]] = {}
        self.begin = max(0, data.find(b"%PDF-", 0, 1024))
        try:
            self._read_references()
            if not isinstance(self.get(self.trailer.get("/Root")), dict):
                raise Broken("no catalogue")
        except (Broken, ValueError, IndexError, KeyError, RecursionError, zlib.error):
            self._rebuild()

    def _read_references(self) -> None:
        last = self.data.rfind(b"startxref")
        m = re.compile(rb"startxref\s+(\d+)").match(self.data, last) if last >= 0 else None
        if not m:
            raise Broken("no startxref")
        todo, seen = [int(m[1])], set()
        while todo:
            at = todo.pop()
            if at in seen:
                continue
            seen.add(at)
            head = self._table(at + self.begin) if self.data[at + self.begin :][:20].lstrip(BLANK).startswith(b"xref") else self._stream_table(at + self.begin)
            self.trailer = {**head, **self.trailer}  # the newest comes first
            todo += [int(head[k]) for k in ("/Prev", "/XRefStm") if isinstance(head.get(k), (int, float))]  # the hybrid part before what is older

    def _table(self, at: int) -> dict:
        at = self.data.index(b"xref", at) + 4
        section = re.compile(rb"\s*(\d+)\s+(\d+)\s*(?=\d{10} )|\s*(\d+)\s+0\s*(?=trailer|\d+ \d+\s)")
        while m := section.match(self.data, at):
            at = m.end()
            first, n = (int(m[1]), int(m[2])) if m[1] is not None else (0, 0)
            for i in range(n):
                e = re.compile(rb"\s*(\d{10}) (\d{5}) ([nf])").match(self.data, at)
                if not e:
                    raise Broken("a line of the references is broken")
                self.places.setdefault(first + i, (None, int(e[1]) + self.begin) if e[3] == b"n" else None)
                at = e.end()
        m = re.compile(rb"\s*trailer").match(self.data, at)
        if not m:
            raise Broken("no trailer")
        return parse(self.data, m.end())[0]

    def _stream_table(self, at: int) -> dict:
        obj = self._object(at)[1]
        if not isinstance(obj, Stream) or obj.head.get("/Type") != "/XRef":
            raise Broken("no references where they should be")
        head, body = obj.head, self.decoded(obj)
        widths = [int(w) for w in head["/W"]]
        index = head.get("/Index") or [0, head["/Size"]]
        pos = 0
        for first, n in zip(index[::2], index[1::2], strict=True):
            for number in range(int(first), int(first) + int(n)):
                row = []
                for w, default in zip(widths, (1, 0, 0), strict=True):
                    row.append(int.from_bytes(body[pos : pos + w]) if w else default)
                    pos += w
                if pos > len(body):
                    return head
                self.places.setdefault(number, {1: (None, row[1] + self.begin), 2: (row[1], row[2])}.get(row[0]))
        return head

    def _rebuild(self) -> None:
        """Without usable references: the last object of each number, in the file and in object streams, and any trailer."""
        self.places, self.trailer, self.opened = {}, {}, {}
        for m in OBJECT.finditer(self.data):
            self.places[int(m[1])] = (None, m.start())
        for m in re.finditer(rb"trailer", self.data):
            try:
                self.trailer |= parse(self.data, m.end())[0]
            except (Broken, TypeError, ValueError):
                continue
        for number in list(self.places):
            try:
                obj = self.get(Ref(number))
                if isinstance(obj, Stream) and obj.head.get("/Type") == "/ObjStm":
                    for k, inner in enumerate(self._contents(number)[1]):
                        self.places.setdefault(inner[0], (number, k))
                elif isinstance(obj, Stream) and obj.head.get("/Type") == "/XRef":
                    self.trailer |= obj.head
                elif isinstance(obj, dict) and obj.get("/Type") == "/Catalog":
                    self.trailer.setdefault("/Root", Ref(number))
            except (Broken, ValueError, IndexError, KeyError, TypeError, zlib.error):
                continue

    def _object(self, at: int) -> tuple[int, Any]:
        m = re.compile(rb"[\0\t\n\f\r ]*(\d+)[\0\t\n\f\r ]+\d+[\0\t\n\f\r ]+obj").match(self.data, at)
        if not m:
            raise Broken("no object where one should be")
        value, end = parse(self.data, m.end())
        s = re.compile(rb"[\0\t\n\f\r ]*stream(?:\r\n|\n|\r)").match(self.data, end) if isinstance(value, dict) else None
        return int(m[1]), Stream(value, s.end()) if s else value

    def decoded(self, stream: Stream) -> bytes:
        size = self.get(stream.head.get("/Length"))
        end = stream.start + size if isinstance(size, int) else -1
        if not re.compile(rb"\s*endstream").match(self.data, max(end, 0)):
            end = self.data.find(b"endstream", stream.start)
        body = self.data[stream.start : end if end >= 0 else len(self.data)]
        filters, how = ([x] if isinstance(x := self.get(stream.head.get(k)), (str, dict)) else x or [] for k in ("/Filter", "/DecodeParms"))
        for i, name in enumerate(filters):
            if name not in ("/FlateDecode", "/Fl"):
                raise Broken(f"filter {name} is not read")
            d = zlib.decompressobj()
            body = d.decompress(body, MOST_BYTES)
            if d.unconsumed_tail:
                raise Broken(f"a stream of references or objects has over {MOST_BYTES} bytes")
            parms = self.get(how[i]) if i < len(how) else None
            if isinstance(parms, dict) and (parms.get("/Predictor") or 1) >= 10:
                body = unpredicted(body, int(parms.get("/Columns") or 1) * int(parms.get("/Colors") or 1) * int(parms.get("/BitsPerComponent") or 8) // 8)
        return body

    def _contents(self, number: int) -> tuple[bytes, list[tuple[int, int]]]:
        if number not in self.opened:
            stream = self._object(self.places[number][1])[1]
            body = self.decoded(stream)
            numbers = [int(x) for x in body[: int(stream.head["/First"])].split()[: 2 * int(stream.head["/N"])]]
            self.opened[number] = body, [(a, int(stream.head["/First"]) + b) for a, b in zip(numbers[::2], numbers[1::2], strict=True)]
        return self.opened[number]

    def get(self, value: Any) -> Any:
        """What a reference, or a chain of them, stands for; null for objects that are not there."""
        for _ in range(MOST_DEPTH):
            if not isinstance(value, Ref):
                return value
            place = self.places.get(value.number)
            if place is None:
                return None
            if place[0] is None:
                number, found = self._object(place[1])
                if number != value.number:
                    raise Broken(f"object {value.number} is not where the references say")
                value = found
            else:
                body, inside = self._contents(place[0])
                value = parse(body, dict(inside)[value.number])[0] if value.number in dict(inside) else None
        raise Broken("a reference leads back to itself")

    def pages(self) -> list[tuple[float, float]]:
        """Width and height in points of each page as it is shown: of its own or inherited box, turned by its own or
        inherited rotation."""
        if "/Encrypt" in self.trailer and self.trailer["/Encrypt"] is not None:
            raise Broken("the file is encrypted")
        root = self.get(self.trailer.get("/Root"))
        if not isinstance(root, dict):
            raise Broken("no catalogue")
        out, todo, seen = [], [(root.get("/Pages"), None, 0)], set()
        while todo:
            ref, box, turn = todo.pop()
            if isinstance(ref, Ref):
                if ref in seen:
                    continue
                seen.add(ref)
            node = self.get(ref)
            if not isinstance(node, dict):
                continue
            own = self.get(node.get("/MediaBox"))
            if isinstance(own, list) and len(own) == 4:
                corners = [self.get(x) for x in own]
                box = corners if all(isinstance(x, (int, float)) for x in corners) else box
            turned = self.get(node.get("/Rotate"))
            turn = int(turned) if isinstance(turned, (int, float)) else turn
            kids = self.get(node.get("/Kids"))
            if isinstance(kids, list):
                todo += [(k, box, turn) for k in reversed(kids)]
            elif node.get("/Type") in ("/Page", None):
                w, h = (abs(box[2] - box[0]), abs(box[3] - box[1])) if box else A4
                out.append((float(h), float(w)) if turn % 180 == 90 else (float(w), float(h)))
        return out


def page_sizes(data: bytes) -> list[tuple[float, float]]:
    """pages() of a file; what is broken beyond repair raises Broken."""
    if data.find(b"%PDF-", 0, 1024) < 0:
        raise Broken("not a PDF")
    try:
        return Pdf(data).pages()
    except (ValueError, IndexError, KeyError, TypeError, RecursionError, zlib.error) as e:
        raise e if isinstance(e, Broken) else Broken(f"{type(e).__name__}: {e}") from e
