"""Compressed text in parts: block-gzip by byte ranges, zip archives by member.

A block-gzip file (BGZF) is a chain of gzip members of at most 64 KiB, each with the
same sixteen header bytes before its size.  Spark's text source can cut a file at any
byte string, at any file system and in as many byte ranges as it likes; here it cuts at
that header, so every row is one block and a file is read by many tasks.  A task
inflates its blocks in order and gives the lines that lie within its byte range.  A line
across the border of two ranges comes in fragments, one or two for each range, which
are put together by a window over the few fragments of each file.

A file whose name says blocks but which holds one plain gzip stream has no such header:
it arrives as one row, is told by its first bytes and inflated in one task.
"""

from __future__ import annotations

import gzip
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the format: the header of a block up to its size field, and the empty block that ends a file.
HEADER = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"
EMPTY_BLOCK = HEADER + b"\x1b\x00\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
BLOCK_BYTES = 65_280
LINES_PER_BATCH = 10_000

WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3  # of a line: all, up to the first break of a range, after the last, a range without one
_LINES = pa.schema([("FILE", pa.string()), ("AT", pa.int64()), ("ROW", pa.int64()), ("PART", pa.int32()), ("BYTES", pa.binary())])


def inflate_block(rest: bytes) -> bytes:
    """Text of a block, given what follows the sixteen bytes; size and checksum are verified."""
    if len(rest) < 12 or struct.unpack("<H", rest[:2])[0] + 1 != len(rest) + len(HEADER):
        raise ValueError("damaged block-gzip file: a block has another size than it states")
    data = zlib.decompress(rest[2:-8], -15)
    if struct.unpack("<II", rest[-8:]) != (zlib.crc32(data), len(data)):
        raise ValueError("damaged block-gzip file: a block fails its checksum")
    return data


def deflate_block(data: bytes) -> bytes:
    """One whole block of at most ``BLOCK_BYTES`` of text."""
    engine = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = engine.compress(data) + engine.flush()
    return HEADER + struct.pack("<H", len(HEADER) + len(packed) + 9) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def _texts(piece: bytes, at: int) -> Iterator[bytes]:
    """Text of what the source gave for one row."""
    if at == 0 and piece[:2] == b"\x1f\x8b":
        with gzip.open(io.BytesIO(piece)) as stream:
            while data := stream.read(1 << 20):
                yield data
    elif piece:  # nothing stands before the first block of a file
        yield inflate_block(piece)


class _Range:
    """Lines of one byte range of one file."""

    def __init__(self, file: str, at: int):
        self.file, self.at, self.row, self.held, self.broken = file, at, 0, b"", False

    def _next(self, part: int, line: bytes) -> tuple:
        self.row += 1
        return self.file, self.at, self.row, part, line

    def feed(self, data: bytes) -> Iterator[tuple]:
        *lines, self.held = (self.held + data).split(b"\n")
        for line in lines:
            yield self._next(WHOLE if self.broken else HEAD, line)
            self.broken = True

    def close(self) -> tuple:
        return self._next(TAIL if self.broken else MIDDLE, self.held)


def _inflated(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(block, FILE, AT) in the order of the file to (FILE, AT, text)."""
    for batch in batches:
        for i in range(batch.num_rows):
            file, at = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
            yield file, at, b""
            for data in _texts(batch.column(0)[i].as_py(), at):
                yield file, at, data


def _whole_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that lie within one byte range; line 1 of a range ends at its first break."""
    here, held, next_row, lines = None, b"", 1, []

    def told() -> pa.RecordBatch:
        n, (file, at) = len(lines), here
        rows = np.arange(next_row - n, next_row, dtype=np.int64)
        columns = [pa.repeat(pa.scalar(file, pa.string()), n), pa.repeat(pa.scalar(at, pa.int64()), n), pa.array(rows), pa.array(lines, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["FILE", "AT", "ROW", "BYTES"])

    for file, at, data in _inflated(batches):
        if here != (file, at):
            if lines:
                yield told()
            here, held, next_row, lines = (file, at), b"", 1, []
        *more, held = (held + data).split(b"\n")
        if more and next_row == 1:
            more, next_row = more[1:], 2
        next_row += len(more)
        lines += more
        if len(lines) >= LINES_PER_BATCH:
            yield told()
            lines = []
    if lines:
        yield told()


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fragments at both ends of every byte range; what lies between is only counted."""
    here, parts, n_lines, rows = None, [], 0, []

    def close() -> tuple:
        return (*here, n_lines + 1, TAIL if n_lines else MIDDLE, b"".join(parts))

    for file, at, data in _inflated(batches):
        if here != (file, at):
            if here is not None:
                rows.append(close())
            here, parts, n_lines = (file, at), [], 0
        breaks = data.count(b"\n")
        if breaks and not n_lines:
            rows.append((file, at, 1, HEAD, b"".join(parts) + data[: data.index(b"\n")]))
        if breaks:
            parts = []
            data = data[data.rindex(b"\n") + 1 :]
        parts.append(data)
        n_lines += breaks
    if here is not None:
        rows.append(close())
    yield _lines(rows)


def _openings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(FILE, HEAD) of first ranges: the first whole line that is neither blank nor ``##``, null without one; blocks after it stay packed."""
    here, held, head, rows = None, b"", None, []
    for batch in batches:
        for i in range(batch.num_rows):
            file = batch.column(1)[i].as_py()
            if file != here:
                if here is not None:
                    rows.append((here, head))
                here, held, head = file, b"", None
            if head is None:
                for data in _texts(batch.column(0)[i].as_py(), 0):
                    *lines, held = (held + data).split(b"\n")
                    head = next((line for line in lines if line.strip(b" \r") and not line.startswith(b"##")), None)
                    if head is not None:
                        break
    if here is not None:
        rows.append((here, head))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["FILE", "HEAD"])


def bgzf_openings(spark: SparkSession, path: str) -> DataFrame:
    """(FILE, HEAD): the header line of every file, as far as its first byte range holds it."""
    return _blocks(spark, path).filter("AT = 0").mapInArrow(_openings, "FILE string, HEAD binary").select("FILE", _text("HEAD").alias("HEAD"))


def _lines(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_LINES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LINES)], schema=_LINES)


def _text(data: Column | str) -> Column:
    """Bytes of a line as text, without a carriage return at the end."""
    value = F.col(data) if isinstance(data, str) else data
    return F.regexp_replace(F.make_valid_utf8(value.cast("string")), "\r$", "")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("encoding", "ISO-8859-1").option("lineSep", HEADER.decode("latin-1")).text(path)
    return raw.select(F.col("value").cast("binary").alias("block"), F.col("_metadata.file_path").alias("FILE"), F.col("_metadata.file_block_start").alias("AT"))


def read_bgzf(spark: SparkSession, path: str) -> DataFrame:
    """(value, FILE, AT, ROW): lines of block-gzip files; AT and ROW put the lines of a file in order."""
    blocks = _blocks(spark, path)
    whole = blocks.mapInArrow(_whole_lines, "FILE string, AT bigint, ROW bigint, BYTES binary").select(_text("BYTES").alias("value"), "FILE", "AT", "ROW")
    # The files are read twice, but only one of the two reads makes rows of lines.
    fragments = blocks.mapInArrow(_borders, "FILE string, AT bigint, ROW bigint, PART int, BYTES binary")
    # A head ends a line; what lies between two heads is one line.
    ended = F.sum((F.col("PART") == HEAD).cast("int")).over(Window.partitionBy("FILE").orderBy("AT", "ROW").rowsBetween(Window.unboundedPreceding, -1))
    pieces = fragments.withColumn("LINE", F.coalesce(ended, F.lit(0)))
    joined = pieces.groupBy("FILE", "LINE").agg(F.sort_array(F.collect_list(F.struct("AT", "ROW", "PART", "BYTES"))).alias("P"))
    data = F.aggregate("P", F.lit(b""), lambda all_, p: F.concat(all_, p["BYTES"]))
    # After the last break of a file there is a line only if there is text.
    border = joined.filter(F.exists("P", lambda p: (p["PART"] == HEAD) | (F.octet_length(p["BYTES"]) > 0)))
    return whole.unionByName(border.select(_text(data).alias("value"), "FILE", F.get("P", F.lit(0))["AT"].alias("AT"), F.get("P", F.lit(0))["ROW"].alias("ROW")))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = b""
    for batch in batches:
        if not batch.num_rows:
            continue
        held += "\n".join([*batch.column(0).fill_null("").to_pylist(), ""]).encode()
        whole = len(held) // BLOCK_BYTES * BLOCK_BYTES
        blocks = [deflate_block(held[at : at + BLOCK_BYTES]) for at in range(0, whole, BLOCK_BYTES)]
        held = held[whole:]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([deflate_block(held)], pa.binary())], ["block"])


def write_bgzf(lines: DataFrame, path: str, value: str = "value") -> None:
    """Write a text column as block-gzip files, one for each partition.

    Every block is a row of Spark's text sink; the empty block, which the format allows
    anywhere, is the separator, so each file also ends as the format asks.
    """
    blocks = lines.select(value).mapInArrow(_pack, "block binary")
    writer = blocks.select(F.col("block").cast("string").alias("value")).write
    writer.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_BLOCK.decode("latin-1")).text(path)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed bytes of every member of an archive, taken out without inflating."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            content = content.as_buffer()
            with zipfile.ZipFile(pa.BufferReader(content)) as archive:
                for info in archive.infolist():
                    if info.is_dir():
                        continue
                    if info.compress_type in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                        names = struct.unpack("<HH", content[info.header_offset + 26 : info.header_offset + 30])
                        start = info.header_offset + 30 + sum(names)
                        packed, deflated = content[start : start + info.compress_size], info.compress_type == zipfile.ZIP_DEFLATED
                    else:
                        packed, deflated = archive.read(info), False
                    columns = [[f"{path.as_py()}!{info.filename}"], [deflated], [bytes(packed)]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.binary()))], ["FILE", "deflated", "packed"])


def _member_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of every member, in bounded batches."""
    for batch in batches:
        for i in range(batch.num_rows):
            packed, here, rows = batch.column(2)[i].as_py(), _Range(batch.column(0)[i].as_py(), 0), []
            engine = zlib.decompressobj(-15) if batch.column(1)[i].as_py() else None
            for start in range(0, len(packed), 1 << 20):
                data = packed[start : start + (1 << 20)]
                rows.extend(here.feed(engine.decompress(data) if engine else data))
                while len(rows) >= LINES_PER_BATCH:
                    yield _lines(rows[:LINES_PER_BATCH])
                    del rows[:LINES_PER_BATCH]
            if engine and not engine.eof:
                raise ValueError(f"damaged archive member {here.file}")
            if here.held:
                rows.append(here.close())
            yield _lines(rows)


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """(value, FILE, AT, ROW): lines of the members of zip archives; a member is a file of its own and a task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    members = files.mapInArrow(_members, "FILE string, deflated boolean, packed binary").repartition("FILE")
    lines = members.mapInArrow(_member_lines, "FILE string, AT bigint, ROW bigint, PART int, BYTES binary")
    return lines.select(_text("BYTES").alias("value"), "FILE", "AT", "ROW")
