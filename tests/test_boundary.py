"""Sizes of images, and interfaces that wait for decoders."""

import struct
import zlib

import pytest

from parchment.plans import boundary
from parchment.sources.images import image_size, sizes


def png(w, h):
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"\0" * (w + 1) * h)) + part(b"IEND", b"")


CASES = [
    (png(7, 3), (7, 3)),
    (b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc2\x00\x11\x08" + struct.pack(">HH", 30, 40) + b"\x03", (40, 30)),
    (b"GIF89a" + struct.pack("<HH", 5, 6), (5, 6)),
    (b"BM" + b"\0" * 16 + struct.pack("<ii", 9, -8), (9, 8)),
    (b"II*\0" + struct.pack("<IH", 8, 2) + struct.pack("<HHIHH", 256, 3, 1, 11, 0) + struct.pack("<HHII", 257, 4, 1, 12), (11, 12)),
    (b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"), (100, 50)),
    (b"\xff\xd8\xff\xe0\x00\x04ab", None), (b"\x89PNG\r\n\x1a\n", None), (b"text", None), (b"", None), (None, None),
]


@pytest.mark.parametrize(("data", "size"), CASES)
def test_image_size(data, size):
    assert image_size(data) == size


def test_sizes(spark):
    files = spark.createDataFrame([(str(i), d) for i, (d, _) in enumerate(CASES)], "path string, content binary")
    assert {r.path: (r.width, r.height) for r in sizes(files).collect()} == {str(i): s or (None, None) for i, (_, s) in enumerate(CASES)}


def test_decoders_are_registered():
    with pytest.raises(NotImplementedError, match="pixels.pages"):
        boundary.get("pixels").pages(None)
    with pytest.raises(ValueError, match="pdf_text"):
        boundary.get("sound")

    class Own(boundary.PdfText):
        def page_texts(self, files):
            return "texts"

        def page_words(self, files):
            return "words"

    with pytest.raises(TypeError):
        boundary.register("pixels", Own())
    boundary.register("pdf_text", Own())
    assert boundary.get("pdf_text").page_texts(None) == "texts"
    boundary._REGISTERED.clear()
