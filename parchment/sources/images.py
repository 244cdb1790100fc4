"""Sizes of image files out of their first bytes; no pixel is decoded."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# JPEG markers that hold a frame's size, and those without a length.
_FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
_BARE = {0x01, *range(0xD0, 0xDA)}


def _jpeg(data: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
        elif kind in _BARE:
            at += 2
        elif kind in _FRAMES:
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def _tiff(data: bytes) -> tuple[int, int] | None:
    order = "<" if data[:2] == b"II" else ">"
    at = struct.unpack(order + "I", data[4:8])[0]
    if at + 2 > len(data):
        return None
    found = {}
    for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        entry = data[at + 2 + 12 * i : at + 14 + 12 * i]
        if len(entry) < 12:
            break
        tag, kind = struct.unpack(order + "HH", entry[:4])
        if tag in (256, 257):
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), entry[8 : 10 if kind == 3 else 12])[0]
    return (found[256], found[257]) if len(found) == 2 else None


def _webp(data: bytes) -> tuple[int, int] | None:
    kind = data[12:16]
    if kind == b"VP8 ":
        width, height = struct.unpack("<HH", data[26:30])
        return width & 0x3FFF, height & 0x3FFF
    if kind == b"VP8L":
        bits = struct.unpack("<I", data[21:25])[0]
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8X":
        return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
    return None


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) of a PNG, JPEG, GIF, BMP, TIFF or WEBP file; none for anything else or a file that breaks off."""
    data = data or b""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
        if data[:4] == b"GIF8":
            return struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            width, height = struct.unpack("<ii", data[18:26])
            return width, abs(height)
        if data[:4] in (b"II*\0", b"MM\0*"):
            return _tiff(data)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp(data)
    except struct.error:
        pass
    return None


def sizes(files: DataFrame) -> DataFrame:
    """(path, width, height) of binaryFile rows (path, content); null sizes where a file is no known image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [image_size(x.as_py()) or (None, None) for x in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *(pa.array([f[i] for f in found], pa.int32()) for i in (0, 1))], ["path", "width", "height"])

    return files.select("path", "content").mapInArrow(run, "path string, width int, height int")
