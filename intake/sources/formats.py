"""File formats that tasks read themselves, by name.

A work item names the format its file is read with.  A format here is a class
with ``batches(stream, part, schema, options)``: Arrow batches of the records of one
file, or of the part of it that begins in ``[start, end)``.  What it raises makes
the file a rejected one; the other files are read on.  ``register_format`` adds
formats under their names.

Formats of whole records are ``framed`` (a container of its own, see
:class:`Framed`) and ``parquet``.  ``csv``, ``json`` and ``text`` give lines, which
Spark's own ``from_csv`` / ``from_json`` turn into records afterwards.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa

ROWS = 4096                     # records a batch holds


@dataclass(frozen=True)
class Part:
    """What to read of a file: records that begin in ``[start, end)``."""

    start: int = 0
    end: int | None = None      # None: to the end


class FileFormat:
    """A format by name; ``splits``: whether parts of a file can be read on their own, but
    for files whose names end with one of ``packed``."""

    name = ""
    splits = False
    packed: tuple[str, ...] = ()

    def batches(self, stream, part: Part, schema: pa.Schema, options: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


class Framed(FileFormat):
    """``FRM1``, then a frame per record: length and crc32 (little-endian unsigned 32-bit) of its
    payload, and the payload, a JSON object in UTF-8.  The end mark is a frame of length 2**32 - 1
    with the number of records in place of the crc, so a file cut off between two frames is told too."""

    name = "framed"
    MAGIC, HEAD, END = b"FRM1", struct.Struct("<II"), 2 ** 32 - 1

    @classmethod
    def frame(cls, payload: bytes) -> bytes:
        return cls.HEAD.pack(len(payload), zlib.crc32(payload)) + payload

    def batches(self, stream, part, schema, options):
        stream = io.BufferedReader(stream, 1 << 20) if isinstance(stream, io.RawIOBase) else stream
        if stream.read(4) != self.MAGIC:
            raise ValueError("no FRM1 file")
        rows, count, at = [], 0, 4
        while True:
            head = stream.read(8)
            problem = None
            if len(head) < 8:
                problem = f"cut off at byte {at}"
            else:
                size, check = self.HEAD.unpack(head)
                if size == self.END:
                    if check != count & 0xFFFFFFFF:
                        problem = f"{count} records, {check} expected"
                    elif stream.read(1):
                        problem = "bytes behind the end mark"
                    else:
                        break
                else:
                    payload = stream.read(size)
                    if len(payload) < size:
                        problem = f"cut off at byte {at}"
                    elif zlib.crc32(payload) != check:
                        problem = f"wrong checksum at byte {at}"
            if problem:
                if rows:                         # what came before is whole
                    yield _from_rows(rows, schema)
                raise ValueError(problem)
            rows.append(json.loads(payload))
            count, at = count + 1, at + 8 + size
            if len(rows) >= ROWS:
                yield _from_rows(rows, schema)
                rows = []
        if rows:
            yield _from_rows(rows, schema)


def _from_rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    """JSON values as columns; timestamps and decimals are texts there."""
    arrays = []
    for f in schema:
        values = [r.get(f.name) for r in rows]
        if pa.types.is_timestamp(f.type) or pa.types.is_date(f.type) or pa.types.is_decimal(f.type):
            arrays.append(pa.array([None if v is None else str(v) for v in values], pa.string()).cast(f.type))
        else:
            arrays.append(pa.array(values, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Lines(FileFormat):
    """A line per record (ended by ``\\n``, ``\\r`` or both), in a column ``value``; with blank and
    comment lines left out and the header line dropped where the options say so."""

    splits, packed = True, (".gz",)

    def __init__(self, name: str):
        self.name = name

    def batches(self, stream, part, schema, options):
        encoding = options.get("encoding", options.get("charset", "UTF-8"))
        keep_blank, comment = self.name == "text", options.get("comment") if self.name == "csv" else None
        if part.start:                           # a line belongs to the part it begins in
            stream.seek(part.start - 1)
            stream.readline()
        elif self.name == "csv" and options.get("header", "false").lower() == "true":
            stream.readline()
        rows, first = [], part.start == 0
        while part.end is None or stream.tell() < part.end:
            line = stream.readline()
            if not line:
                break
            text = line.decode(encoding).rstrip("\n").removesuffix("\r")
            if first:
                text, first = text.removeprefix("﻿"), False
            # a lone carriage return ends a line too
            for one in text.split("\r") if "\r" in text else (text,):
                if keep_blank or (one.strip() and not (comment and one.startswith(comment))):
                    rows.append(one)
            if len(rows) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], schema=schema)


class Parquet(FileFormat):
    """Columns by name, missing ones null, widened to the schema asked for; parts are row groups."""

    name, splits = "parquet", True

    def batches(self, stream, part, schema, options):
        import pyarrow.parquet as pq

        f = pq.ParquetFile(stream)
        groups = []
        for k in range(f.metadata.num_row_groups):
            column = f.metadata.row_group(k).column(0)
            at = min(x for x in (column.dictionary_page_offset, column.data_page_offset) if x)
            if part.start <= at and (part.end is None or at < part.end):
                groups.append(k)
        names = {n.lower(): n for n in f.schema_arrow.names}
        have = [names.get(c.lower()) for c in schema.names]
        if groups:
            for batch in f.iter_batches(ROWS, row_groups=groups, columns=[c for c in have if c]):
                # no column asked for is in the file: nulls, as many as rows
                columns = {c: batch.column(c).cast(t.type) for c, t in zip(have, schema) if c}
                yield pa.RecordBatch.from_arrays(
                    [columns[c] if c else pa.nulls(batch.num_rows, t.type) for c, t in zip(have, schema)], schema=schema)


FORMATS: dict[str, FileFormat] = {}


def register_format(fmt: FileFormat) -> FileFormat:
    """Make a format known by its name to work items and type registries."""
    FORMATS[fmt.name] = fmt
    return fmt


for _f in (Framed(), Lines("csv"), Lines("json"), Lines("text"), Parquet()):
    register_format(_f)
