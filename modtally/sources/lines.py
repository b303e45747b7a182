"""Line source for dumps Spark's text reader cannot decode (xz, long-window zstd).

One partition per part of a file (see ``archives``): a file of one frame or block is one
part. Content is streamed, never held whole. Lines come out as bytes because a dump may not be
valid UTF-8. A file that is damaged or ends too early gives a row without a line that says so
in ``error``, beside whatever lines came before; the other files go on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .archives import Broken, decoded, open_file, part_content

_CHUNK = 1 << 23
_BATCH_LINES = 20_000
# Longer lines are taken as they are; a longer blank line is quarantined as malformed.
_BLANK_LENGTH = 64

_NAMES = ["value", "path", "name", "start", "line", "error"]


class FilePart(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _content(part: FilePart) -> Iterator[bytes]:
    if (part.start, part.end) != (0, -1):
        yield from part_content(part.path, part.start, part.end)
        return
    with open_file(part.path) as raw:
        yield from decoded(part.path, raw)


def _batches(content: Iterator[bytes]) -> Iterator[pa.Array]:
    """Lines of a stream, a few megabytes at a time; Arrow cuts them."""
    held: list[bytes] = []
    size = 0
    for piece in content:
        held.append(piece)
        size += len(piece)
        if size < _CHUNK or b"\n" not in piece:
            continue
        block = b"".join(held)
        end = block.rfind(b"\n")
        held = [block[end + 1 :]]
        size = len(held[0])
        yield pc.split_pattern(pa.array([block[:end]], pa.large_binary()), b"\n").flatten()
    block = b"".join(held)
    if block:
        yield pc.split_pattern(pa.array([block], pa.large_binary()), b"\n").flatten()


def _not_blank(lines: pa.Array) -> np.ndarray:
    """Which lines hold more than white space."""
    lengths = np.diff(np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1])
    full = lengths > 0
    # Lines of a dump are objects; only very short ones can be blank.
    for i in np.flatnonzero(full & (lengths < _BLANK_LENGTH)):
        full[i] = bool(lines[int(i)].as_py().strip())
    return full


class DumpLinesReader(DataSourceReader):
    def __init__(self, parts: list[tuple[str, int, int]], max_lines: int):
        self.parts = parts
        self.max_lines = max_lines

    def partitions(self) -> list[FilePart]:
        return [FilePart(*p) for p in self.parts]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        path, name = partition.path, partition.path.rsplit("/", 1)[-1]
        start = max(partition.start, 0)

        def rows(values, numbers, error=None) -> pa.RecordBatch:
            own = lambda x, kind: pa.array([x] * len(values), kind)
            columns = [values, own(path, pa.string()), own(name, pa.string()), own(start, pa.int64()), numbers, own(error, pa.string())]
            return pa.RecordBatch.from_arrays(columns, _NAMES)

        seen = kept = 0
        try:
            for lines in _batches(_content(partition)):
                full = _not_blank(lines)
                numbers = pa.array(np.arange(seen, seen + len(lines)), pa.int64())
                seen += len(lines)
                if self.max_lines:
                    first = np.flatnonzero(full)[: self.max_lines - kept]
                    full = np.zeros(len(lines), bool)
                    full[first] = True
                kept += int(full.sum())
                mask = pa.array(full)
                values, numbers = lines.filter(mask), numbers.filter(mask)
                for low in range(0, len(values), _BATCH_LINES):
                    yield rows(values.slice(low, _BATCH_LINES).cast(pa.binary()), numbers.slice(low, _BATCH_LINES))
                if self.max_lines and kept >= self.max_lines:
                    break
        except Broken as error:
            yield rows(pa.array([None], pa.binary()), pa.array([seen], pa.int64()), str(error))


class DumpLines(DataSource):
    """``spark.read.format("dump_lines").option("parts", json_list).load()``; a part is ``path, start, end``."""

    @classmethod
    def name(cls) -> str:
        return "dump_lines"

    def schema(self) -> str:
        return "value binary, path string, name string, start bigint, line bigint, error string"

    def reader(self, schema) -> DumpLinesReader:
        return DumpLinesReader([tuple(p) for p in json.loads(self.options["parts"])], int(self.options.get("max_lines", "0")))
