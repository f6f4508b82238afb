"""PDF pages: trees with inherited boxes, incremental updates, reference streams, and files that are broken."""

import struct
import zlib

import pytest

from foliant.sources import pdf


def body(objects, offsets, out):
    for number, text in objects:
        offsets[number] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (number, text)


def table(out, offsets, root, prev=None, gone=()):
    at = len(out)
    out += b"xref\n"
    for number in sorted({*offsets, *gone}):
        out += b"%d 1\n" % number + (b"%010d 00000 n \n" % offsets[number] if number in offsets else b"0000000000 00001 f \n")
    out += b"trailer\n<< /Size 99 /Root %d 0 R %s >>\nstartxref\n%d\n%%%%EOF\n" % (root, b"/Prev %d" % prev if prev is not None else b"", at)
    return at


PAGES = [
    (1, b"<< /Type /Catalog /Pages 2 0 R >>"),
    (2, b"<< /Type /Pages /Kids [3 0 R 4 0 R 7 0 R] /Count 4 /MediaBox [0 0 612 792] >>"),
    (3, b"<< /Type /Page /Parent 2 0 R >>"),
    (4, b"<< /Type /Pages /Parent 2 0 R /Kids [5 0 R 6 0 R] /Rotate 90 /Count 2 >>"),
    (5, b"<< /Type /Page /Parent 4 0 R /MediaBox [10 20 110 220] % note ]\n >>"),
    (6, b"<< /Type /Page /Parent 4 0 R /MediaBox 8 0 R /Rotate -180 /Title (a \\( << /Type /Page) >>"),
    (7, b"<< /Type/Page/Parent 2 0 R/MediaBox[0 0 .5e0 1]/Contents 9 0 R/MediaBox[0 0 30.5 40]>>"),
    (8, b"[0 0 50 60]"),
    (9, b"<< /Length 21 >>\nstream\n/Type /Page /MediaBox\nendstream"),
    (20, b"<< /Type /Page /MediaBox [0 0 1 1] >>"),
]
WANT = [(612, 792), (200, 100), (50, 60), (30.5, 40)]


def plain():
    out, offsets = bytearray(b"%PDF-1.4\n"), {}
    body(PAGES, offsets, out)
    return out, table(out, offsets, 1)


def test_tree_with_inheritance_and_orphans():
    assert pdf.page_sizes(bytes(plain()[0])) == WANT


def test_incremental_updates_replace_and_delete():
    out, at = plain()
    offsets = {}
    body([(2, b"<< /Type /Pages /Kids [3 0 R 4 0 R 7 0 R] /MediaBox [0 0 10 20] >>"), (5, b"<< /Type /Page /MediaBox [0 0 7 9] >>")], offsets, out)
    at = table(out, offsets, 1, at, gone=[7])
    assert pdf.page_sizes(bytes(out)) == [(10, 20), (9, 7), (50, 60)]
    offsets = {}
    body([(7, b"<< /Type /Page >>")], offsets, out)
    table(out, offsets, 1, at)
    assert pdf.page_sizes(bytes(out)) == [(10, 20), (9, 7), (50, 60), (10, 20)]


@pytest.mark.parametrize("predictor", [False, True])
def test_reference_and_object_streams(predictor):
    inner, numbers = b"", []
    for number, text in PAGES:
        if number not in (9, 20):
            numbers.append((number, len(inner)))
            inner += text + b" "
    head = b" ".join(b"%d %d" % x for x in numbers) + b" "
    packed = zlib.compress(head + inner)
    out = bytearray(b"%PDF-1.5\n")
    at = len(out)
    out += b"30 0 obj\n<< /Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d >>\nstream\n" % (len(numbers), len(head), len(packed)) + packed + b"\nendstream\nendobj\n"
    rows = {30: (1, at, 0)} | {n: (2, 30, k) for k, (n, _) in enumerate(numbers)} | {31: (1, len(out), 0)}
    lines = [struct.pack(">BIB", *rows.get(n, (0, 0, 0))) for n in range(32)]
    if predictor:
        filters, above, coded = [0, 1, 2, 3, 4], bytes(6), []
        for i, line in enumerate(lines):
            kind = filters[i % 5]
            guess = lambda j, line=line, above=above: {0: 0, 1: line[j - 1] if j else 0, 2: above[j], 3: ((line[j - 1] if j else 0) + above[j]) // 2, 4: min((line[j - 1] if j else 0, above[j], above[j - 1] if j else 0), key=lambda x: abs((line[j - 1] if j else 0) + above[j] - (above[j - 1] if j else 0) - x))}[kind]  # noqa: B023, E731
            coded.append(bytes([kind]) + bytes((line[j] - guess(j)) & 255 for j in range(6)))
            above = line
        lines = coded
    data = zlib.compress(b"".join(lines))
    start = len(out)
    how = b"/DecodeParms << /Predictor 15 /Columns 6 >>" if predictor else b""
    out += b"31 0 obj\n<< /Type /XRef /Size 32 /W [1 4 1] /Root 1 0 R /Filter /FlateDecode %s /Length %d >>\nstream\n" % (how, len(data)) + data + b"\nendstream\nendobj\nstartxref\n%d\n%%%%EOF" % start
    assert pdf.page_sizes(bytes(out)) == WANT


def test_broken_files():
    out = bytes(plain()[0])
    assert pdf.page_sizes(out.replace(b"startxref", b"startxxxx")) == WANT
    assert pdf.page_sizes(b"junk" + out) == WANT
    assert pdf.page_sizes(out[: out.index(b"xref")]) == WANT  # no trailer either: the catalogue is found
    for bad in (b"", b"no", b"%PDF-1.4 nothing"):
        with pytest.raises(pdf.Broken):
            pdf.page_sizes(bad)
    loop = b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj 2 0 obj << /Type /Pages /Kids [2 0 R 3 0 R] >> endobj 3 0 obj << /Type /Page /MediaBox [0 0 5 6] >> endobj"
    assert pdf.page_sizes(loop) == [(5, 6)]
    with pytest.raises(pdf.Broken):
        pdf.page_sizes(loop.replace(b"[2 0 R 3", b"[" * 3000 + b"3"))
    with pytest.raises(pdf.Broken):
        pdf.page_sizes(loop + b"trailer << /Root 1 0 R /Encrypt 9 0 R >> 9 0 obj << /V 1 >> endobj")
