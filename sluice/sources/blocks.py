"""Objects → blocks of lines, in bounded memory.

An object is inflated as a stream and cut, at line ends, into blocks of about ``BLOCK_BYTES`` of
text.  A block carries what its lines need to be parsed away from the rest of the file: the
number of lines before it (R6) and the file's first lines, among which the header is looked for
(P1).  No row holds a whole file, so a small gzip that inflates to many gigabytes is a matter of
more blocks, which tasks after the read share.

Whether a gzip is sound is known at its end only.  An object that inflates beyond one block is
therefore inflated twice: once to find its last complete member, once to emit the blocks.  The state of
both passes is one block and one slice of input.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import JS_WS_TEXT, js_trim, strip_bom
from sluice.functions.tokenize import split_lines

# Workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 4 << 20
# A line is a cell of a row: longer ones make the object an error.
LINE_BYTES = 256 << 20
HEAD_LINES = 8
_INPUT = 1 << 18
_BATCH_BYTES = 8 << 20
MAGIC = b"\x1f\x8b"

BLOCK_COLUMNS = ("is_gzip boolean, read_error string, block int, first_line long, whole boolean, head array<string>, lines array<string>")


def _inflated(data: memoryview, most: int) -> Iterator[tuple[bytes, int]]:
    """(piece of text, 0) for pieces of at most ``most`` bytes, and (b"", end) after each complete gzip
    member, with the place in ``data`` where it ends.  Stops at what is no complete member."""
    at = 0
    while bytes(data[at:at + 2]) == MAGIC:
        member = zlib.decompressobj(31)
        try:
            while not member.eof and at < len(data):
                given = bytes(data[at:at + _INPUT])
                at += len(given)
                piece = member.decompress(given, most)
                while True:
                    if piece:
                        yield piece, 0
                    if member.eof or not member.unconsumed_tail:
                        break
                    piece = member.decompress(member.unconsumed_tail, most)
        except zlib.error:
            return
        if not member.eof:
            return
        at -= len(member.unused_data)
        yield b"", at


def _sound_end(data: memoryview, most: int) -> int:
    """End of the last complete member before the first broken one; 0 if there is none."""
    end = 0
    for _, e in _inflated(data, most):
        end = e or end
    return end


def _pieces(data: memoryview, most: int) -> Iterator[bytes]:
    """Text of an object, piece by piece: its complete members, or, without any, its bytes."""
    end = 0
    if bytes(data[:2]) == MAGIC:
        kept, size = [], 0
        for piece, e in _inflated(data, most):
            kept.append(piece)
            size += len(piece)
            if e:
                end, sound = e, len(kept)
            if size > most:
                kept = None
                break
        if kept is not None and end:
            yield b"".join(kept[:sound])
            return
        end = end if kept is not None else _sound_end(data, most)
    if not end:
        for at in range(0, len(data), most):
            yield bytes(data[at:at + most])
        return
    for piece, _ in _inflated(data[:end], most):
        if piece:
            yield piece


def _cut(data: memoryview, most: int, line_bytes: int) -> Iterator[tuple[bytes, bool]]:
    """Texts of at least one line and, but for a longer line, at most twice ``most`` bytes, each cut after
    a line end; and whether it is the last."""
    held = bytearray()
    for piece in _pieces(data, most):
        held += piece
        if len(held) <= most:
            continue
        end = held.rfind(b"\n") + 1
        if end:
            yield bytes(held[:end]), False
            del held[:end]
        elif len(held) > line_bytes:
            raise ValueError(f"a line is longer than {line_bytes} bytes")
    if len(held) > line_bytes and b"\n" not in held:
        raise ValueError(f"a line is longer than {line_bytes} bytes")
    yield bytes(held), True


def blocks_of(data: bytes, block_bytes: int = BLOCK_BYTES, line_bytes: int = LINE_BYTES) -> Iterator[dict]:
    """Blocks of one object: the number of the block, of its first line (from 0, over non-blank lines),
    whether it is the whole object, the object's first lines, and its lines."""
    head, first, number, lines, start = [], 0, 0, [], True
    for raw, last in _cut(memoryview(data), block_bytes, line_bytes):
        # A line end is never inside a character: blocks decode one by one as the whole would.
        text = raw.decode("utf-8", "replace")
        if start and text.startswith("\ufeff"):
            text = text[1:]
        start = False
        lines += [x for x in text.replace("\r\n", "\n").split("\n") if x.strip(JS_WS_TEXT)]
        if not number:
            # The first block waits until it holds the first lines of the object.
            if len(lines) < HEAD_LINES and not last:
                continue
            head = lines[:HEAD_LINES]
        if lines or not number:
            yield {"block": number, "first_line": first, "whole": last and not number, "head": head, "lines": lines}
            number += 1
        first, lines = first + len(lines), []


def _blocks(names: list[str], block_bytes: int, line_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            kept = [batch.schema.field(n) for n in names]
            schema = schema or pa.schema([*kept, ("is_gzip", pa.bool_()), ("read_error", pa.string()), ("block", pa.int32()), ("first_line", pa.int64()),
                                          ("whole", pa.bool_()), ("head", pa.list_(pa.string())), ("lines", pa.list_(pa.string()))])
            rows, size = [], 0
            for k in range(batch.num_rows):
                data = batch.column("content")[k]
                same = {n: batch.column(n)[k].as_py() for n in names}
                raw = data.as_buffer() if data.is_valid else b""
                same["is_gzip"] = bytes(memoryview(raw)[:2]) == MAGIC
                try:
                    for b in blocks_of(raw, block_bytes, line_bytes):
                        rows.append({**same, "read_error": None, **b})
                        size += sum(map(len, b["lines"])) + 64 * len(b["lines"]) + 1024
                        if size >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                except (ValueError, MemoryError, zlib.error) as e:
                    # Blocks given out before are void: see drop_failed.
                    rows.append({**same, "read_error": str(e) or type(e).__name__, "block": -1, "first_line": 0, "whole": False, "head": [], "lines": []})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def line_blocks(objects: DataFrame, block_bytes: int = BLOCK_BYTES, line_bytes: int = LINE_BYTES) -> DataFrame:
    """One row per block of ``objects`` (any columns and ``content`` binary): these columns without the
    content, is_gzip, read_error, block, first_line, whole, head and lines.

    An object that is empty, null or blank has one block without lines.  An object with a line that is
    too long has a row with ``read_error`` and block -1 beside the blocks found before it."""
    names = [f.name for f in objects.schema.fields if f.name != "content"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in objects.schema.fields if f.name != "content")
    return objects.mapInArrow(_blocks(names, block_bytes, line_bytes), f"{types}, {BLOCK_COLUMNS}")


def text_blocks(files: DataFrame) -> DataFrame:
    """The same columns for files that are one row with their ``text``: a block each."""
    lines = F.filter(split_lines(strip_bom(F.col("text"))), lambda x: js_trim(x) != "")
    return (files.withColumn("lines", lines).withColumn("head", F.slice("lines", 1, HEAD_LINES))
            .withColumns({"block": F.lit(0), "first_line": F.lit(0).cast("long"), "whole": F.lit(True)}).drop("text"))
