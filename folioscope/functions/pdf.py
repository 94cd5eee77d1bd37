"""PDF files in plain Python: pages with an invisible text layer, overlays on given pages, splitting, merging, text.

Reads objects written out one by one and in compressed object streams, in the
order of the file, so that later versions of an object win. Encrypted files, and object streams
packed otherwise than by Flate without a predictor, raise ValueError.
The text layer maps UTF-16 units to themselves, so any script can be searched.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

#: Width of any glyph of the invisible font, in thousandths of its size.
GLYPH = 500
#: What a page takes from the nodes above it, and the size of one that says none. Fixed values of the format.
INHERITED = (b"/Resources", b"/MediaBox", b"/CropBox", b"/Rotate")
DEFAULT_BOX = b"[0 0 612 792]"
_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b")
_REF = re.compile(rb"(?<![\w.])(\d+)\s+\d+\s+R\b")
_SPACE = re.compile(rb"(?:[\0\t\n\f\r ]|%[^\r\n]*)*")
_ATOM = re.compile(rb"<[0-9A-Fa-f\0\t\n\f\r ]*>|\d+[\0\t\n\f\r ]+\d+[\0\t\n\f\r ]+R\b|/?[^\0\t\n\f\r ()<>\[\]{}/%]+|/")
_PAREN = re.compile(rb"\\.|[()]", re.S)
_LAYER = re.compile(rb"/Unseen [^<]*<([0-9a-f]*)> Tj")
_CMAP = b"""/CIDInit /ProcSet findresource begin 12 dict begin begincmap /CMapName /Same def /CMapType 2 def
1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange
endcmap end end"""


@dataclass(frozen=True)
class Obj:
    """A value as written, and the raw bytes of its stream if it has one."""

    value: bytes
    stream: bytes | None = None


Objects = dict[int, Obj]
#: A page's object number and its dictionary, with what it inherits and without its parent.
Page = tuple[int, dict[bytes, bytes]]


def _unreadable(why: str = "") -> ValueError:
    return ValueError(f"not a readable PDF{why and ': '}{why}")


# Values ---------------------------------------------------------------------------------


def _token(data: bytes, at: int) -> tuple[int, int]:
    start = _SPACE.match(data, at).end()
    if data[start : start + 2] in (b"<<", b">>"):
        return start, start + 2
    first = data[start : start + 1]
    if first == b"(":
        depth = 0
        for m in _PAREN.finditer(data, start):
            depth += (m[0] == b"(") - (m[0] == b")")
            if not depth:
                return start, m.end()
    elif first in (b"[", b"]", b"{", b"}"):
        return start, start + 1
    elif m := _ATOM.match(data, start):
        return start, m.end()
    raise _unreadable()


def _value(data: bytes, at: int) -> tuple[int, int]:
    """Where the value after `at` starts and ends."""
    start, end = _token(data, at)
    token, depth = data[start:end], 0
    while True:
        depth += (token in (b"<<", b"[")) - (token in (b">>", b"]"))
        if depth < 0:
            raise _unreadable()
        if not depth:
            return start, end
        a, end = _token(data, end)
        token = data[a:end]


def items(value: bytes) -> list[bytes]:
    """Elements of an array."""
    out, at = [], 1
    while value.startswith(b"["):
        a, b = _token(value, at)
        if value[a:b] == b"]":
            break
        a, at = _value(value, a)
        out.append(value[a:at])
    return out


def entries(value: bytes) -> dict[bytes, bytes]:
    """Names and values of a dictionary; none of any other value."""
    out, at = {}, 2
    while value.startswith(b"<<"):
        a, b = _token(value, at)
        if value[a:b] == b">>":
            break
        c, at = _value(value, b)
        out[value[a:b]] = value[c:at]
    return out


def _dictionary(found: dict[bytes, bytes]) -> bytes:
    return b"<< %s >>" % b" ".join(k + b" " + v for k, v in found.items())


def _map_refs(value: bytes, f: Callable[[int], bytes]) -> bytes:
    """The value with every reference replaced; what looks like one in a string stays."""
    if b"(" not in value and b"%" not in value:
        return _REF.sub(lambda m: f(int(m[1])), value)
    out, at = [], 0
    while _SPACE.match(value, at).end() < len(value):
        a, at = _token(value, at)
        m = _REF.fullmatch(value[a:at])
        out.append(f(int(m[1])) if m else value[a:at])
    return b" ".join(out)


def _refs(value: bytes) -> list[int]:
    out: list[int] = []
    _map_refs(value, lambda n: out.append(n) or b"")
    return out


def resolve(objects: Objects, value: bytes) -> bytes:
    """The value itself, after at most 32 references; null if they lead nowhere."""
    for _ in range(32):
        m = _REF.fullmatch(value)
        if not m:
            return value
        value = objects[int(m[1])].value if int(m[1]) in objects else b"null"
    return b"null"


# Files ----------------------------------------------------------------------------------


def _unpacked(objects: Objects, o: Obj) -> bytes:
    """A stream's bytes without its filters: none, or Flate."""
    head = entries(o.value)
    kind = resolve(objects, head.get(b"/Filter", b"null"))
    filters = items(kind) if kind.startswith(b"[") else [] if kind == b"null" else [kind]
    if not filters:
        return o.stream or b""
    parameters = resolve(objects, head.get(b"/DecodeParms", b"null"))
    if filters not in ([b"/FlateDecode"], [b"/Fl"]) or re.search(rb"/Predictor\s+(?!1\b)", parameters):
        raise _unreadable("a filter that isn't plain Flate")
    try:
        return zlib.decompressobj().decompress(o.stream or b"")
    except zlib.error as e:
        raise _unreadable(str(e)) from e


def _stream_end(data: bytes, begin: int, length: bytes) -> tuple[int, int]:
    """Ends of a stream's bytes and of its closing word. A length that doesn't lead to that word isn't believed."""
    m = _REF.fullmatch(length)
    sizes = re.findall(rb"(?<!\d)%s\s+\d+\s+obj\s+(\d+)" % m[1], data) if m else [length] if length.isdigit() else []
    for size in map(int, sizes):
        mark = re.compile(rb"\s*endstream").match(data, begin + size)
        if mark:
            return begin + size, mark.end()
    at = data.find(b"endstream", begin)
    if at < 0:
        raise _unreadable()
    cut = at - 2 if data[at - 2 : at] == b"\r\n" else at - (data[at - 1 : at] in (b"\n", b"\r"))
    return max(cut, begin), at + 9


def read(data: bytes) -> tuple[Objects, int]:
    """Objects of a file by number, and the number of its root."""
    objects: Objects = {}
    trailers, at = [], 0
    while True:
        m = _OBJECT.search(data, at)
        gap = data[at : m.start() if m else len(data)]
        trailers += [entries(gap[slice(*_value(gap, t.end()))]) for t in re.finditer(rb"\btrailer(?=\s*<<)", gap)]
        if not m:
            break
        start, at = _value(data, m.end())
        if data[start:at] == b"endobj":
            continue
        value, stream = data[start:at], None
        mark = _SPACE.match(data, at).end()
        if value.startswith(b"<<") and data.startswith(b"stream", mark):
            begin = mark + 6
            begin += 2 if data[begin : begin + 2] == b"\r\n" else 1
            end, at = _stream_end(data, begin, entries(value).get(b"/Length", b""))
            stream = data[begin:end]
        o = Obj(value, stream)
        head = entries(value) if stream is not None else {}
        if head.get(b"/Type") == b"/XRef":
            trailers.append(head)
        elif head.get(b"/Type") == b"/ObjStm":
            inside, first = _unpacked(objects, o), int(resolve(objects, head.get(b"/First", b"0")))
            numbers = [int(x) for x in inside[:first].split()[: 2 * int(resolve(objects, head.get(b"/N", b"0")))]]
            for n, offset in zip(numbers[::2], numbers[1::2], strict=True):
                objects[n] = Obj(inside[slice(*_value(inside, first + offset))])
        else:
            objects[int(m[1])] = o
    if any(b"/Encrypt" in t for t in trailers):
        raise _unreadable("encrypted")
    roots = [int(m[1]) for t in trailers if (m := _REF.fullmatch(t.get(b"/Root", b"")))]
    if not roots or roots[-1] not in objects:
        raise _unreadable()
    return objects, roots[-1]


def pages(objects: Objects, root: int) -> list[Page]:
    """The pages in order."""
    out, seen = [], set()
    left = [(entries(objects[root].value).get(b"/Pages", b"null"), {})]
    while left:
        reference, given = left.pop()
        m = _REF.fullmatch(reference)
        if not m or int(m[1]) not in objects or int(m[1]) in seen:
            continue
        node = entries(objects[int(m[1])].value)
        given = given | {k: node[k] for k in INHERITED if k in node}
        if b"/Kids" in node:
            seen.add(int(m[1]))  # a tree that bites its tail ends
            left += [(k, given) for k in items(resolve(objects, node[b"/Kids"]))][::-1]
        else:
            out.append((int(m[1]), {k: v for k, v in (given | node).items() if k != b"/Parent"}))
    return out


def _stream(data: bytes, found: dict[bytes, bytes] | None = None) -> Obj:
    return Obj(_dictionary((found or {}) | {b"/Length": b"%d" % len(data)}), data)


def _write(objects: Objects, root: int, compact: bool = False) -> bytes:
    """A file of the objects; if compact, in one object stream with a cross-reference stream, and with Flate for unpacked streams."""
    out, size = bytearray(b"%PDF-1.5\n%\xe2\xe3\xcf\xd3\n"), max(objects) + 1
    places: dict[int, tuple[int, int, int]] = {}  # type, offset or number of the object stream, index in it

    def put(n: int, o: Obj) -> None:
        places[n] = 1, len(out), 0
        out.extend(b"%d 0 obj\n%s" % (n, o.value))
        if o.stream is not None:
            out.extend(b"\nstream\n%s\nendstream" % o.stream)
        out.extend(b"\nendobj\n")

    if not compact:
        for n in sorted(objects):
            put(n, objects[n])
        start = len(out)
        out += b"xref\n0 %d\n0000000000 65535 f \n" % size
        for n in range(1, size):
            out += b"%010d 00000 n \n" % places[n][1] if n in places else b"0000000000 00000 f \n"
        out += b"trailer\n<< /Size %d /Root %d 0 R >>\n" % (size, root)
        return bytes(out + b"startxref\n%d\n%%%%EOF\n" % start)
    header, body, flate = b"", b"", {b"/Filter": b"/FlateDecode"}
    plain = [n for n in sorted(objects) if objects[n].stream is None]
    for i, n in enumerate(plain):
        places[n] = 2, size, i
        header += b"%d %d " % (n, len(body))
        body += objects[n].value + b"\n"
    for n in sorted(set(objects) - set(plain)):
        head = entries(objects[n].value)
        put(n, objects[n] if b"/Filter" in head else _stream(zlib.compress(objects[n].stream or b""), head | flate))
    put(size, _stream(zlib.compress(header + body), {b"/Type": b"/ObjStm", b"/N": b"%d" % len(plain), b"/First": b"%d" % len(header)} | flate))
    start, places[size + 1] = len(out), (1, len(out), 0)
    rows = b"".join(struct.pack(">BIH", *places.get(n, (0, 0, 65535))) for n in range(size + 2))
    told = {b"/Type": b"/XRef", b"/Size": b"%d" % (size + 2), b"/W": b"[1 4 2]", b"/Root": b"%d 0 R" % root}
    put(size + 1, _stream(zlib.compress(rows), told | flate))
    return bytes(out + b"startxref\n%d\n%%%%EOF\n" % start)


def _join(files: list[tuple[Objects, list[Page]]], compact: bool = False) -> bytes:
    """A file with the given pages of each of the given object tables, and with all that they refer to but other pages."""
    out: Objects = {}
    kids, free = [], 3
    for objects, wanted in files:
        own = {n: _dictionary(found) for n, found in wanted}
        seen, left = set(own), list(own)
        while left:
            n = left.pop()
            for k in _refs(own.get(n) or objects[n].value):
                if k in objects and k not in seen and entries(objects[k].value).get(b"/Type") not in (b"/Page", b"/Pages", b"/Catalog"):
                    seen.add(k)
                    left.append(k)
        number = {n: free + i for i, n in enumerate(sorted(seen))}
        free += len(number)
        for n in seen:
            value = _map_refs(own.get(n) or objects[n].value, lambda k: b"%d 0 R" % number[k] if k in number else b"null")
            out[number[n]] = Obj(value.replace(b"<<", b"<< /Parent 2 0 R", 1), None) if n in own else Obj(value, objects[n].stream)
            if objects[n].stream is not None and n not in own:  # its length is known here, wherever it stood
                out[number[n]] = _stream(objects[n].stream, entries(value))
        kids += [number[n] for n, _ in wanted]
    out[1] = Obj(b"<< /Type /Catalog /Pages 2 0 R >>")
    out[2] = Obj(b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % k for k in kids), len(kids)))
    return _write(out, 1, compact)


# Pages ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Placed:
    """A text and where it goes: x, y of its base line from the bottom left, font size, horizontal scale in percent."""

    text: str
    x: float
    y: float
    font_size: float
    scale: float = 100.0


@dataclass(frozen=True)
class Raster:
    """A picture of a page: a JPEG in RGB, or grey bytes packed by Flate."""

    data: bytes
    width: int
    height: int
    jpeg: bool = True


def text_width(text: str, font_size: float) -> float:
    return len(text.encode("utf-16-be")) / 2 * GLYPH / 1000 * font_size


def _layer(texts: list[Placed], left: float = 0.0, bottom: float = 0.0) -> bytes:
    out = b""
    for t in texts:
        code = t.text.encode("utf-16-be").hex().encode()
        out += b"BT 3 Tr /Unseen %.4f Tf %.4f Tz 1 0 0 1 %.4f %.4f Tm <%s> Tj 0 Tr ET\n" % (t.font_size, t.scale, t.x + left, t.y + bottom, code)
    return out


def _font(at: int) -> Objects:
    """The invisible font in objects `at` to `at` + 2."""
    return {
        at: Obj(b"<< /Type /Font /Subtype /Type0 /BaseFont /Unseen /Encoding /Identity-H /DescendantFonts [%d 0 R] /ToUnicode %d 0 R >>" % (at + 1, at + 2)),
        at + 1: Obj(b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Unseen /CIDSystemInfo << /Registry (Adobe) /Ordering (Identity) /Supplement 0 >> /DW %d >>" % GLYPH),
        at + 2: _stream(_CMAP),
    }


def page(width: float, height: float, texts: list[Placed] = (), jpeg: bytes | None = None, pixels: tuple[int, int] = (1, 1), raster: Raster | None = None) -> bytes:
    """A one-page file: the picture over the whole page, and the texts above it, unseen but searchable."""
    raster = Raster(jpeg, *pixels) if jpeg else raster
    content = b"q %.4f 0 0 %.4f 0 0 cm /Im Do Q\n" % (width, height) if raster else b""
    objects = {
        1: Obj(b"<< /Type /Catalog /Pages 2 0 R >>"),
        2: Obj(b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>"),
        3: Obj(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %.4f %.4f] /Resources << /Font << /Unseen 5 0 R >>%s >> /Contents 4 0 R >>"
               % (width, height, b" /XObject << /Im 8 0 R >>" if raster else b"")),
        4: _stream(content + _layer(texts)),
        **_font(5),
    }
    if raster:
        kind = {b"/Type": b"/XObject", b"/Subtype": b"/Image", b"/Width": b"%d" % raster.width, b"/Height": b"%d" % raster.height, b"/BitsPerComponent": b"8"}
        kind |= {b"/ColorSpace": b"/DeviceRGB", b"/Filter": b"/DCTDecode"} if raster.jpeg else {b"/ColorSpace": b"/DeviceGray", b"/Filter": b"/FlateDecode"}
        objects[8] = _stream(raster.data, kind)
    return _write(objects, 1)


def _first(data: bytes) -> tuple[Objects, Page]:
    objects, root = read(data)
    found = pages(objects, root)
    if not found:
        raise _unreadable("no page")
    return objects, found[0]


def _box(objects: Objects, found: dict[bytes, bytes]) -> tuple[float, float, float, float]:
    value = resolve(objects, found.get(b"/CropBox") or found.get(b"/MediaBox", DEFAULT_BOX))
    x0, y0, x1, y1 = (float(resolve(objects, v)) for v in items(value))
    return min(x0, x1), min(y0, y1), abs(x1 - x0), abs(y1 - y0)


def box(data: bytes) -> tuple[float, float, float, float]:
    """Left, bottom, width and height of the first page's crop box, else of its media box."""
    objects, (_, found) = _first(data)
    return _box(objects, found)


def overlay(data: bytes, texts: list[Placed]) -> bytes:
    """The first page with the texts above what it shows, placed from the corner of its crop box; without texts, the page as it is."""
    objects, (n, found) = _first(data)
    if not texts:
        return _join([(objects, [(n, found)])], compact=True)
    left, bottom, _, _ = _box(objects, found)
    free = max(objects) + 1
    # What the page's own operators leave behind (scales, clips) ends with the closing Q.
    objects = objects | {free: _stream(b"q"), free + 1: _stream(b"Q\n" + _layer(texts, left, bottom)), **_font(free + 2)}
    shown = found.get(b"/Contents", b"[]")
    inner = resolve(objects, shown)
    own = items(inner) if inner.startswith(b"[") else [] if inner == b"null" else [shown]
    resources = entries(resolve(objects, found.get(b"/Resources", b"<<>>")))
    resources[b"/Font"] = _dictionary(entries(resolve(objects, resources.get(b"/Font", b"<<>>"))) | {b"/Unseen": b"%d 0 R" % (free + 2)})
    drawn = b"[%s]" % b" ".join([b"%d 0 R" % free, *own, b"%d 0 R" % (free + 1)])
    return _join([(objects, [(n, found | {b"/Contents": drawn, b"/Resources": _dictionary(resources)})])], compact=True)


def scan_or_white(data: bytes, dpi: int, quality: int) -> Raster:
    """Stand-in for a renderer: the largest JPEG the first page holds (a scan is just that), else a white page at the given resolution."""
    objects, (_, found) = _first(data)
    resources = entries(resolve(objects, found.get(b"/Resources", b"<<>>")))
    pictures = []
    for v in entries(resolve(objects, resources.get(b"/XObject", b"<<>>"))).values():
        m = _REF.fullmatch(v)
        o = objects.get(int(m[1])) if m else None
        head = entries(o.value) if o and o.stream is not None else {}
        if head.get(b"/Filter") in (b"/DCTDecode", b"[/DCTDecode]"):
            size = [int(resolve(objects, head.get(k, b"1"))) for k in (b"/Width", b"/Height")]
            pictures.append((size[0] * size[1], Raster(o.stream, *size)))
    if pictures:
        return max(pictures, key=lambda x: x[0])[1]
    _, _, w, h = _box(objects, found)
    size = max(1, round(w * dpi / 72)), max(1, round(h * dpi / 72))
    return Raster(zlib.compress(b"\xff" * (size[0] * size[1])), *size, jpeg=False)


def split(data: bytes) -> list[bytes]:
    """One file per page."""
    objects, root = read(data)
    return [_join([(objects, [p])]) for p in pages(objects, root)]


def merge(files: list[bytes], compact: bool = False) -> bytes:
    """All pages of all files, in order; without any, one empty page of 1 x 1. An unreadable file raises."""
    tables = [(o, pages(o, r)) for o, r in map(read, files)]
    return _join(tables, compact) if any(p for _, p in tables) else page(1, 1)


def texts(data: bytes) -> list[str]:
    """The text layer of each page, a line per placed text."""
    objects, root = read(data)
    out = []
    for _, found in pages(objects, root):
        shown = found.get(b"/Contents", b"[]")
        inner = resolve(objects, shown)
        parts = [objects[n] for n in _refs(inner if inner.startswith(b"[") else shown) if n in objects]
        content = b"".join(_unpacked(objects, o) for o in parts if entries(o.value).get(b"/Filter", b"/FlateDecode") == b"/FlateDecode")
        out.append("\n".join(bytes.fromhex(h.decode()).decode("utf-16-be") for h in _LAYER.findall(content)))
    return out
