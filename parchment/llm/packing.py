"""Best-fit packing of tokenized documents into sequences of a fixed length.

Bounded-space online best fit: a packer keeps a fixed number of open bins in a
bitset keyed by free space. A piece goes to the open bin it fits most tightly; if
it fits none and all bins are open, the fullest closes and a new one opens.
Only (id, piece, length) rows reach a packer, never tokens, and the number of packers
grows with the number of pieces.
"""

from __future__ import annotations

import array
import os
import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parchment.llm.common import Shared, keep, text_of, trim

#: Open bins of a packer, and the pieces a packer is given at most, about.
OPEN_BINS = 1024
PIECES = 1_000_000
#: First number of a packer's sequences that one piece fills; all others are smaller.
FULL = 1 << 39
#: Segments whose ids a worker remembers, twice as many at most and those of one text; then those that were not asked for since the last time go. Longer segments than LETTERS seldom come again, and are not remembered.
REMEMBERED, LETTERS = 300_000, 64

# Unicode white space. A token of the byte-level vocabulary never goes on from another
# character into white space, so a text can be cut before any run of it. A run of letters ends a
# token too where a character of ASCII that is no letter follows: words are then remembered
# without the punctuation after them.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SEGMENT = re.compile(f"[{_SPACE}]*[{_LATIN}]++(?![^\\x00-\\x7f])|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


class _Known(dict):
    """Segments' ids, found out when first asked for. What was there before the last turn() waits, and comes back when asked for."""

    def __init__(self, find):
        self.find, self.before = find, {}

    def __missing__(self, segment: str) -> bytes:
        out = self.before.pop(segment, None)
        out = self.find(segment) if out is None else out
        if len(segment) <= LETTERS:
            self[segment] = out
        return out

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


class TokenBytes:
    """Token ids of texts as little-endian unsigned 32-bit bytes, by one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self.encode)

    @classmethod
    def get(cls, path: str) -> "TokenBytes":
        return keep(("tokens", path), lambda: cls(path))

    def encode(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        out = array.array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def __call__(self, text: str) -> bytes:
        """As encode(), with segments' ids remembered."""
        if any(s in text for s in self.special):
            return self.encode(text)
        out = b"".join(map(self.known.__getitem__, _SEGMENT.findall(text)))
        if len(self.known) > REMEMBERED:
            self.known.turn()
        return out


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of size, but the first may be shorter."""
    first = n % size or size
    return [(0, min(first, n))] + [(at, size) for at in range(first, n, size)]


def best_fit(lengths: Iterator[int], size: int, open_bins: int = OPEN_BINS) -> Iterator[tuple[int, int]]:
    """(bin, offset) for each length in 1..size, in turn."""
    by_free: dict[int, list[int]] = {}
    bits = is_open = last = 0
    for n in lengths:
        fits = bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            bins = by_free[free]
            b = bins.pop()
            if not bins:
                bits &= ~(1 << free)
        else:
            if is_open >= open_bins:  # the fullest closes
                free = (bits & -bits).bit_length() - 1
                by_free[free].pop()
                if not by_free[free]:
                    bits &= ~(1 << free)
                is_open -= 1
            free, b = size, last
            last += 1
            is_open += 1
        yield b, size - free
        left = free - n
        if left:
            by_free.setdefault(left, []).append(b)
            bits |= 1 << left
        else:
            is_open -= 1


def placed(lengths: Iterator[int], size: int, open_bins: int = OPEN_BINS) -> Iterator[tuple[int, int]]:
    """As best_fit(), but a piece of the full size has a bin of its own, numbered from FULL on, and closes no other."""
    full, feed = FULL, []
    packed = best_fit(iter(feed.pop, None), size, open_bins)
    for n in lengths:
        if n == size:
            yield full, 0
            full += 1
        else:  # lengths are handed over one by one
            feed.append(n)
            yield next(packed)


def tokenized_pieces(docs: DataFrame, tokenizer: str, size: int, id_col: str = "doc_id", text_col: str = "text", end: int = 0) -> DataFrame:
    """(id, piece, start, length, ids_crc32): a document's ids, then the end id, cut into pieces of at most size."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenBytes.get(tokenizer)
        tail = ids_of._ids([end])
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = memoryview(ids_of(text.as_py()) + tail)
                for k, (s, n) in enumerate(cut(len(ids) // 4, size)):
                    at.append(i), piece.append(k), start.append(s), length.append(n)
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["id", "piece", "start", "length", "ids_crc32"],
            )
        trim()

    return rows.mapInArrow(run, schema)


def pack(pieces: DataFrame, shared: Shared, size: int, open_bins: int = OPEN_BINS, per_packer: int = PIECES) -> DataFrame:
    """pieces with sequence_id and offset. Each packer numbers its own sequences; its input is sorted, so reruns agree."""
    pieces = shared.save(pieces, "pieces")
    packers = -(-max(1, pieces.count()) // per_packer)
    # By a hash of id and piece: one long document's pieces go to many packers. Sorted by a hash, lengths come in no order.
    dealt = pieces.withColumn("order", F.xxhash64("id", "piece")).withColumn("packer", F.pmod("order", F.lit(packers)))
    dealt = dealt.repartition(packers, "packer").sortWithinPartitions("packer", "order", "id", "piece", "ids_crc32")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feed: list[int] = []
        packed, of = iter(()), None
        for batch in batches:
            packer = batch.column("packer").to_pylist()
            sequence, offset = [], []
            for p, n in zip(packer, batch.column("length").to_pylist(), strict=True):
                if p != of:  # lengths are handed over one by one
                    feed, of = [], p
                    packed = placed(iter(feed.pop, None), size, open_bins)
                feed.append(n)
                b, o = next(packed)
                sequence.append((p << 40) + b)
                offset.append(o)
            kept = batch.drop_columns(["order", "packer"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*kept.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts make one piece of the end id alone. Repeated rows are packed each on its own;
    rows that share an id have pieces with the same numbers. Ties in free space go to the bin filled last. An empty
    table gives an empty result. Whole texts are tokenized; memory is bounded by the longest one.
    """
    shared = Shared(docs.sparkSession, "packing")
    return pack(tokenized_pieces(docs, tokenizer, size, id_col, text_col), shared, size, open_bins)
