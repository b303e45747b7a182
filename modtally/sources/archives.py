"""Compressed streams: decoding that notices a missing or damaged part, and where a file can be cut.

A zst file is a row of frames, an xz file a row of blocks; each decodes by itself. Where they begin
follows from headers alone: frame and block headers of zst, the index at the end of an xz stream.
"""

from __future__ import annotations

import bz2
import gzip
import lzma
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import unquote

# Fixed values of the zst and xz formats.
ZST_FRAME, ZST_SKIPPED = 0xFD2FB528, 0x184D2A50
ZST_RLE = 1
XZ_MAGIC, XZ_END = b"\xfd7zXZ\x00", b"YZ"
BZ2_LAST_BLOCK = 0x177245385090
# Fixed value: the largest zstd window a dump may use.
ZSTD_MAX_WINDOW = 2**31

_READ, _BEYOND = 1 << 18, 1 << 13
_CHUNK = 1 << 22


class Broken(Exception):
    """The file is damaged or ends too early; a file that cannot be reached is another error."""


def open_file(path: str, seekable: bool = False):
    """Open a local path or any URI the Arrow file systems know."""
    from pyarrow import fs

    local = re.sub("^file:/+", "/", path)
    if local.startswith("/"):
        system, inner = fs.LocalFileSystem(), unquote(local) if local != path else path
    else:
        system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner) if seekable else system.open_input_stream(inner, compression=None)


def extension(path: str) -> str:
    return path[path.rfind(".") :].lower()


def decoded(path: str, raw) -> Iterator[bytes]:
    """The content of a whole file in pieces. Raises ``Broken``."""
    kind = extension(path)
    if kind == ".zst":
        yield from (data for _, data in zst_frames(raw))
        return
    openers = {".xz": lzma.open, ".gz": gzip.open, ".bz2": bz2.open}
    if kind not in openers:
        raise ValueError(f"not a dump: {path}")
    counted = _Counted(raw)
    try:
        with openers[kind](counted) as stream:
            while data := stream.read(_CHUNK):
                yield data
    except EOFError:
        raise Broken("truncated") from None
    except (lzma.LZMAError, zlib.error, gzip.BadGzipFile) as error:
        raise Broken(f"damaged: {error}") from None
    except OSError as error:
        # bz2 reports bad data as an error without a system code.
        if error.errno is not None or kind != ".bz2":
            raise
        raise Broken(f"damaged: {error}") from None
    if not counted.n:
        raise Broken("truncated")


class _Counted:
    """A stream that knows how many bytes were read; gzip takes no bytes for an empty file."""

    def __init__(self, raw):
        self.raw, self.n = raw, 0

    def read(self, size: int = -1) -> bytes:
        data = self.raw.read() if size < 0 else self.raw.read(size)
        self.n += len(data)
        return data


def zst_frames(raw, at: int = 0, step: int = _READ) -> Iterator[tuple[int, bytes]]:
    """Content of the frames from offset ``at`` on, each piece with the offset of its frame; ``step`` bytes are read at a time."""
    import zstandard

    engine = zstandard.ZstdDecompressor(max_window_size=ZSTD_MAX_WINDOW)
    frame, start, read = None, at, at
    while data := raw.read(step):
        read += len(data)
        while data:
            if frame is None:
                frame, start = engine.decompressobj(), read - len(data)
            try:
                out = frame.decompress(data)
            except zstandard.ZstdError as error:
                raise Broken(f"damaged: {error}") from None
            if out:
                yield start, out
            data = b""
            if frame.eof:
                data, frame = frame.unused_data, None
    if frame is not None or read == 0:
        raise Broken("truncated")


def xz_blocks(raw, blocks: list[tuple[int, int, int, bytes]], at: int) -> Iterator[tuple[int, bytes]]:
    """Content of the blocks from offset ``at`` on, each piece with the offset of its block."""
    for offset, size, content, header in blocks[bisect_left(blocks, (at,)) :]:
        raw.seek(offset)
        # A block between a stream's header and an index of its own is a whole stream.
        stream = lzma.LZMADecompressor(lzma.FORMAT_XZ)
        data = header + raw.read(-(-size // 4) * 4) + _xz_end(size, content, header[6:8])
        try:
            while not stream.eof:
                out = stream.decompress(data, _CHUNK)
                data = b""
                if out:
                    yield offset, out
                elif stream.needs_input:
                    raise Broken("truncated")
        except lzma.LZMAError as error:
            raise Broken(f"damaged: {error}") from None


def _number(n: int) -> bytes:
    """A number as the xz index writes it: seven bits a byte, lowest first."""
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes((*out, n))


def _numbers(data: bytes, at: int) -> Iterator[int]:
    value = shift = 0
    for byte in data[at:]:
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            yield value
            value = shift = 0


def _xz_end(size: int, content: int, flags: bytes) -> bytes:
    index = b"\x00\x01" + _number(size) + _number(content)
    index += bytes(-len(index) % 4)
    index += struct.pack("<I", zlib.crc32(index))
    tail = struct.pack("<I", len(index) // 4 - 1) + flags
    return index + struct.pack("<I", zlib.crc32(tail)) + tail + XZ_END


def xz_index(raw, size: int) -> list[tuple[int, int, int, bytes]]:
    """``offset, size, content size, stream header`` of every block, from the indexes of all streams. Empty if unreadable."""
    found: list[tuple[int, int, int, bytes]] = []
    end = size
    while end > 0:
        raw.seek(max(end - 4, 0))
        if raw.read(4) == bytes(4):
            end -= 4
            continue
        if end < 32:
            return []
        raw.seek(end - 12)
        footer = raw.read(12)
        if footer[10:] != XZ_END:
            return []
        length = (struct.unpack("<I", footer[4:8])[0] + 1) * 4
        if length > end - 24:
            return []
        raw.seek(end - 12 - length)
        index = raw.read(length)
        if index[:1] != b"\x00" or zlib.crc32(index[:-4]) != struct.unpack("<I", index[-4:])[0]:
            return []
        numbers = _numbers(index, 1)
        records = [(next(numbers), next(numbers)) for _ in range(next(numbers))]
        start = end - 12 - length - sum(-(-unpadded // 4) * 4 for unpadded, _ in records)
        if start < 12:
            return []
        raw.seek(start - 12)
        header = raw.read(12)
        if header[:6] != XZ_MAGIC:
            return []
        own = []
        for unpadded, content in records:
            own.append((start, unpadded, content, header))
            start += -(-unpadded // 4) * 4
        found = own + found
        end = own[0][0] - 12 if own else end - 24 - length
    return found


class _Skipper:
    """Small reads that move forward through a file, in large ones."""

    def __init__(self, raw):
        self.raw, self.base, self.held = raw, 0, b""

    def take(self, at: int, n: int) -> bytes:
        if not self.base <= at <= at + n <= self.base + len(self.held):
            self.raw.seek(at)
            self.base, self.held = at, self.raw.read(1 << 16)
        return self.held[at - self.base : at - self.base + n]


def zst_index(raw, size: int) -> list[int]:
    """Offsets of the frames, from headers only; those before the first that cannot be followed."""
    look, at, found = _Skipper(raw), 0, []
    while at + 8 <= size:
        magic = struct.unpack("<I", look.take(at, 4))[0]
        if magic & ~0xF == ZST_SKIPPED:
            at += 8 + struct.unpack("<I", look.take(at + 4, 4))[0]
            continue
        if magic != ZST_FRAME:
            break
        found.append(at)
        flags = look.take(at + 4, 1)[0]
        single = flags >> 5 & 1
        at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = 0
        while not last:
            if at + 3 > size:
                return found
            head = int.from_bytes(look.take(at, 3), "little")
            last = head & 1
            at += 3 + (1 if head >> 1 & 3 == ZST_RLE else head >> 3)
        at += 4 * (flags >> 2 & 1)
    return found


def parts_of(path: str, size: int, least: int) -> list[tuple[int, int]]:
    """Cuts of a zst or xz file into parts of at least ``least`` compressed bytes: offsets, the last one open (-1)."""
    if extension(path) not in (".zst", ".xz") or size < 2 * least:
        return [(0, -1)]
    with open_file(path, seekable=True) as raw:
        starts = zst_index(raw, size) if extension(path) == ".zst" else [b[0] for b in xz_index(raw, size)]
    cuts = [0]
    for start in starts[1:]:
        if start - cuts[-1] >= least:
            cuts.append(start)
    return list(zip(cuts, [*cuts[1:], -1], strict=True))


def fewer_parts(parts: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Neighbouring parts joined, so that at most ``most`` are left."""
    step = -(-len(parts) // most)
    return [(parts[i][0], parts[min(i + step, len(parts)) - 1][1]) for i in range(0, len(parts), step)]


def part_content(path: str, start: int, end: int) -> Iterator[bytes]:
    """Content of the part ``[start, end)``, in whole lines: from the first line that begins after its start
    to the end of the line that its last byte, or the line break there, leads into."""
    with open_file(path, seekable=True) as raw:
        if extension(path) == ".zst":
            raw.seek(start)
            # A short part does not read far beyond its end.
            units = zst_frames(raw, start, _READ if end < 0 else min(_READ, end - start + _BEYOND))
        else:
            units = xz_blocks(raw, xz_index(raw, raw.size()), start)
        inside = start == 0
        for offset, data in units:
            over = 0 <= end <= offset
            if over and not inside:
                return
            if not inside:
                cut = data.find(b"\n")
                if cut < 0:
                    continue
                inside, data = True, data[cut + 1 :]
            if over:
                cut = data.find(b"\n")
                if cut >= 0:
                    yield data[: cut + 1]
                    return
            if data:
                yield data


def ends_whole(path: str) -> str | None:
    """What is wrong with the first or last bytes of a gz or bz2 file, which a decoder may take for a short file; else None."""
    with open_file(path, seekable=True) as raw:
        size = raw.size()
        head = raw.read(4)
        raw.seek(max(size - 16, 0))
        tail = raw.read(16)
    if not size:
        return "truncated"
    if extension(path) == ".gz":
        return None if head[:2] == b"\x1f\x8b" else "damaged: no gzip header"
    if head[:3] != b"BZh":
        return "damaged: no bzip2 header"
    # The last block's mark stands before a checksum of 32 bits, at any bit.
    bits = int.from_bytes(tail, "big")
    return None if any(bits >> 32 + pad & (1 << 48) - 1 == BZ2_LAST_BLOCK for pad in range(8)) else "truncated"


def fault(path: str) -> str | None:
    """What is wrong with a file, found by decoding all of it; None if nothing is."""
    try:
        with open_file(path) as raw:
            for _ in decoded(path, raw):
                pass
    except Broken as error:
        return str(error)
    return None
