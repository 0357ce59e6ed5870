"""Token files: independent zstandard frames and a trailing seek table.

A file holds

1. data frames: ids of consecutive documents, little-endian unsigned 32-bit, about
   ``FRAME_BYTES`` before compression; a long document goes on in the next frame;
2. one frame with the document table: number of documents (unsigned 64-bit), one
   byte each for "has an id", document ids (64-bit), token counts (64-bit);
3. a skippable frame with the seek table: for each frame before it the compressed
   size, the size before compression and the lower half of its XXH64 checksum,
   then the number of frames, a descriptor byte and the magic number.

The seek table is that of the public seekable zstandard format, so any zstandard
reader reads the frames one after another, and a reader that knows the table
decompresses only those that it wants.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard

FRAME_BYTES = 256 << 10

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")
HEADER = struct.Struct("<II")


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class Writer:
    """Writes documents to a binary stream in the order given."""

    def __init__(self, stream, level: int = 1, frame_bytes: int = FRAME_BYTES):
        self._stream, self._frame_bytes = stream, frame_bytes
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._buffer = bytearray()
        self._entries: list[bytes] = []
        self._ids: list[int | None] = []
        self._counts: list[int] = []
        self.bytes = 0
        self.tokens = 0

    def _frame(self, raw: bytes) -> None:
        packed = self._compress(raw)
        self._stream.write(packed)
        self._entries.append(ENTRY.pack(len(packed), len(raw), _checksum(raw)))
        self.bytes += len(packed)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._ids.append(doc_id)
        self._counts.append(len(ids) // 4)
        self.tokens += len(ids) // 4
        for start in range(0, len(ids), self._frame_bytes):
            self._buffer += ids[start : start + self._frame_bytes]
            if len(self._buffer) >= self._frame_bytes:
                self._frame(bytes(self._buffer))
                self._buffer.clear()

    @property
    def documents(self) -> int:
        return len(self._ids)

    def close(self) -> None:
        if self._buffer:
            self._frame(bytes(self._buffer))
        n = len(self._ids)
        self._frame(
            struct.pack("<Q", n)
            + bytes(i is not None for i in self._ids)
            + np.array([i or 0 for i in self._ids], "<i8").tobytes()
            + np.array(self._counts, "<i8").tobytes()
        )
        seek = b"".join(self._entries)
        self._stream.write(HEADER.pack(SKIPPABLE_MAGIC, len(seek) + FOOTER.size) + seek)
        self._stream.write(FOOTER.pack(len(self._entries), HAS_CHECKSUMS, SEEKABLE_MAGIC))
        self._stream.close()


class Reader:
    """Reads documents of a seekable file; only frames that hold them are read."""

    def __init__(self, file):
        self._file = file
        size = file.size()
        n, descriptor, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or descriptor != HAS_CHECKSUMS:
            raise ValueError("no seek table")
        entries = np.frombuffer(self._at(size - FOOTER.size - n * ENTRY.size, n * ENTRY.size), "<u4").reshape(n, 3)
        self._packed, self._raw, self._sums = entries.T.astype(np.int64)
        self._place = np.concatenate([[0], np.cumsum(self._packed)])
        self._from = np.concatenate([[0], np.cumsum(self._raw[:-1])])
        table = self.frame(n - 1)
        (docs,) = struct.unpack_from("<Q", table)
        valid = np.frombuffer(table, np.uint8, docs, 8)
        ids = np.frombuffer(table, "<i8", docs, 8 + docs).tolist()
        self.doc_ids = [i if v else None for i, v in zip(ids, valid, strict=True)]
        self.counts = np.frombuffer(table, "<i8", docs, 8 + 9 * docs)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def _at(self, place: int, size: int) -> bytes:
        self._file.seek(int(place))
        return self._file.read(int(size))

    def frame(self, k: int) -> bytes:
        raw = zstandard.ZstdDecompressor().decompress(
            self._at(self._place[k], self._packed[k]), max_output_size=max(1, int(self._raw[k]))
        )
        if _checksum(raw) != self._sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def document(self, index: int) -> bytes:
        """Ids of one document."""
        start, end = 4 * self.starts[index], 4 * self.starts[index + 1]
        if start == end:
            return b""
        first = int(np.searchsorted(self._from, start, "right")) - 1
        last = int(np.searchsorted(self._from, end, "left"))
        raw = b"".join(self.frame(k) for k in range(first, last))
        return raw[start - self._from[first] : end - self._from[first]]

    def checksums(self) -> Iterator[int]:
        """CRC32 of each document's ids, in order; one frame is in memory at a time."""
        k, raw, at = 0, b"", 0
        for count in self.counts.tolist():
            left, crc = 4 * count, 0
            while left:
                if at == len(raw):
                    raw, at, k = self.frame(k), 0, k + 1
                take = min(left, len(raw) - at)
                crc = zlib.crc32(memoryview(raw)[at : at + take], crc)
                at, left = at + take, left - take
            yield crc
