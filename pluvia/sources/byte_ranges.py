"""Ranges of bytes of large station files, each with the head of its file: parts that read like small files.

A range holds the lines that begin in it, whole.  What describes them, the metadata lines and the header, stands at the
begin of the file; a task reads that again for each of its files, some kilobytes against megabytes, and puts it before the
range's lines.  So every byte below the head is read once, no line is numbered and nothing is joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..schemas import METADATA_LINES
from .archives import filesystem_of

RANGE_BYTES = 8 << 20
#: Read at a time in search of a line's end or of a header.
BLOCK = 64 << 10

_BREAK = re.compile(rb"\r\n|\r|\n")
_BLANKS = b" \t\r\n\x0b\x0c\xa0"
_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")


def readable(path: str) -> bool:
    """Whether tasks can open files of the (qualified) path by themselves."""
    return path.partition(":")[0] in _SCHEMES


def line_start(file: pa.NativeFile, at: int, size: int) -> int:
    """Where the first line begins that begins at ``at`` or later."""
    if at <= 0:
        return 0
    here = at - 1
    while here < size:
        # One byte more than is searched, for a break of two characters.
        block = file.read_at(BLOCK + 1, here)
        found = _BREAK.search(block)
        if found and found.start() < BLOCK:
            return here + found.end()
        here += BLOCK
    return size


def read_head(file: pa.NativeFile, size: int) -> tuple[list[bytes], int]:
    """The metadata lines and the header, if there are any, and where the lines below begin."""
    width = BLOCK
    while True:
        data = file.read_at(width, 0)
        head, start = [], 0
        for end in _BREAK.finditer(data):
            if end.end() == len(data) < size:
                break  # the other half of the break may follow
            line, start = data[start : end.start()], end.end()
            if len(head) < METADATA_LINES:
                head.append(line)
            elif line.strip(_BLANKS):
                return [*head, line], start
        if len(data) >= size:
            rest = data[start:]
            return head + [rest] * (len(head) < METADATA_LINES or bool(rest.strip(_BLANKS))), size
        width *= 2


def read_range(file: pa.NativeFile, size: int, offset: int, length: int, head: list[bytes], body: int) -> bytes | None:
    """The head and the lines that begin in the range; None for a range without any, unless it is the first."""
    begin = line_start(file, offset, size) if offset > body else body
    stop = line_start(file, offset + length, size) if offset + length < size else size
    if stop <= begin and offset:
        return None
    return b"\n".join([*head, file.read_at(max(0, stop - begin), begin)])


def read_ranges(ranges: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, ano, length, offset)`` -> ``(file, ano, base, content)``, a row per range that holds lines."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = file = head = None
        # Small ranges go together, up to the bytes of a whole one.
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != path:
                    path = row["file"]
                    filesystem, inner = filesystem_of(path)
                    file = filesystem.open_input_file(inner)
                    head = read_head(file, row["length"])
                content = read_range(file, row["length"], row["offset"], range_bytes, *head)
                if content is not None:
                    rows.append({"file": path, "ano": row["ano"], "base": row["offset"], "content": content})
                    held += len(content)
                if held >= range_bytes:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return ranges.mapInArrow(read, "file string, ano int, base long, content binary")


_SCHEMA = pa.schema([("file", pa.string()), ("ano", pa.int32()), ("base", pa.int64()), ("content", pa.binary())])
