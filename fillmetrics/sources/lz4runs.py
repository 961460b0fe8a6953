"""Large LZ4 files read by several tasks.

An LZ4 frame is a chain of blocks, each with its size before it. Where the frame says that its blocks are independent (as the
command-line tool writes them), any run of blocks can be decoded on its own; a frame of dependent blocks is one run, but the frames
of a file that holds several are independent. One pass reads the sizes only and lists the runs; the runs are dealt out; each is
decoded as a frame of its own. A line belongs to the run it begins in: a run drops what comes before its first line feed, and
reads on behind its end up to the next one.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the frame format: magic numbers, flags, and the header's check byte by flags (version, independent blocks, checksum
# of blocks) and largest block.
MAGIC, SKIPPABLE = 0x184D2204, range(0x184D2A50, 0x184D2A60)
INDEPENDENT, BLOCK_SUM, SIZED, CONTENT_SUM, DICTIONARY = 0x20, 0x10, 0x08, 0x04, 0x01
STORED = 0x80000000
HEADER_CHECK = {
    (0x40, 0x40): 192, (0x40, 0x50): 119, (0x40, 0x60): 150, (0x40, 0x70): 223,
    (0x50, 0x40): 192, (0x50, 0x50): 43, (0x50, 0x60): 104, (0x50, 0x70): 129,
    (0x60, 0x40): 130, (0x60, 0x50): 251, (0x60, 0x60): 81, (0x60, 0x70): 115,
    (0x70, 0x40): 173, (0x70, 0x50): 132, (0x70, 0x60): 51, (0x70, 0x70): 114,
}

RUN_BYTES = 32 << 20


@dataclass(frozen=True)
class Run:
    """Blocks from ``start`` to ``end`` of a file, and the flags of their frame."""

    start: int
    end: int
    flags: int
    largest: int


def _frame(source: pa.NativeFile, at: int) -> tuple[int, int, int] | int | None:
    """(first block, flags, largest block) of the frame at a place; where to go on behind a skippable one; None at the end."""
    source.seek(at)
    head = source.read(7)
    if len(head) < 7:
        return None
    magic, flags, largest = struct.unpack("<IBB", head[:6])
    if magic in SKIPPABLE:
        return at + 8 + struct.unpack("<I", head[4:7] + source.read(1))[0]
    if magic != MAGIC or flags >> 6 != 1 or flags & DICTIONARY:
        raise ValueError(f"no readable LZ4 frame at byte {at}")
    return at + 7 + (8 if flags & SIZED else 0), flags, largest & 0x70


def _block(source: pa.NativeFile, at: int, flags: int) -> int:
    """Where the block at a place ends; the place itself if the frame ends there."""
    source.seek(at)
    size = struct.unpack("<I", source.read(4))[0]
    return at + 4 + (size & ~STORED) + (4 if flags & BLOCK_SUM else 0) if size else at


def _behind(at: int, flags: int) -> int:
    """The place behind the end mark at a place."""
    return at + 4 + (4 if flags & CONTENT_SUM else 0)


def runs_of(source: pa.NativeFile, run_bytes: int = RUN_BYTES, at: int = 0) -> Iterator[Run]:
    """All runs from a place on, in order, of at least ``run_bytes`` where blocks are independent and the frame is as long."""
    while (frame := _frame(source, at)) is not None:
        if isinstance(frame, int):
            at = frame
            continue
        start, flags, largest = frame
        place = start
        while (end := _block(source, place, flags)) != place:
            place = end
            if flags & INDEPENDENT and place - start >= run_bytes:
                yield Run(start, place, flags, largest)
                start = place
        if place > start:
            yield Run(start, place, flags, largest)
        at = _behind(place, flags)


class _Slice:
    """The blocks of a run as a frame that a decoder can read."""

    def __init__(self, source: pa.NativeFile, run: Run):
        flags = 0x40 | run.flags & (INDEPENDENT | BLOCK_SUM)
        self.before = struct.pack("<IBBB", MAGIC, flags, run.largest, HEADER_CHECK[flags, run.largest])
        self.source, self.at, self.end, self.after = source, run.start, run.end, b"\0\0\0\0"
        self.closed = False

    def read(self, size: int = -1) -> bytes:
        if self.before:
            found, self.before = self.before, b""
        elif self.at < self.end:
            self.source.seek(self.at)
            found = self.source.read(min(self.end - self.at, size if size >= 0 else 1 << 20))
            if not found:
                raise EOFError("the file ends within a block")
            self.at += len(found)
        else:
            found, self.after = self.after, b""
        return found

    def readable(self) -> bool:
        return True

    def writable(self) -> bool:
        return False

    def seekable(self) -> bool:
        return False

    def close(self) -> None:
        self.closed = True


def decoded(source: pa.NativeFile, run: Run, block_bytes: int) -> Iterator[bytes]:
    with pa.CompressedInputStream(pa.PythonFile(_Slice(source, run), mode="r"), "lz4") as stream:
        while block := stream.read(block_bytes):
            yield block


def _following(source: pa.NativeFile, run: Run, block_bytes: int) -> Iterator[bytes]:
    """What comes behind a run, block by block where blocks are independent."""
    at = run.end
    if run.flags & INDEPENDENT:
        while (end := _block(source, at, run.flags)) != at:
            yield from decoded(source, Run(at, end, run.flags, run.largest), block_bytes)
            at = end
    for after in runs_of(source, 1, _behind(at, run.flags)):
        yield from decoded(source, after, block_bytes)


def run_texts(source: pa.NativeFile, run: Run, first: bool, block_bytes: int) -> Iterator[bytes]:
    """Whole lines that begin in a run, some at a time; ``first`` is the run that the file begins with."""
    pending: list[bytes] = []
    inside = first
    for block in decoded(source, run, block_bytes):
        if not inside:
            cut = block.find(b"\n")
            if cut < 0:
                continue
            inside, block = True, block[cut + 1 :]
        cut = block.rfind(b"\n")
        if cut < 0:
            pending.append(block)
            continue
        yield b"".join([*pending, block[:cut]])
        pending = [block[cut + 1 :]]
    if not inside:
        return  # all of it belongs to a line that began before
    for block in _following(source, run, block_bytes):
        cut = block.find(b"\n")
        pending.append(block if cut < 0 else block[:cut])
        if cut >= 0:
            break
    rest = b"".join(pending)
    if rest:
        yield rest
