"""Framing of WARC records: plain or gzipped (one member or many), streamed from any binary file object."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

#: A header block that is longer than this isn't taken for one.
MAX_HEADER = 1 << 20


@dataclass
class WarcRecord:
    offset: int
    version: str
    headers: list[tuple[str, str]] = field(default_factory=list)
    block: bytes = b""
    truncated: bool = False

    def header(self, name: str) -> str | None:
        """The first value of a header, whatever its case."""
        name = name.lower()
        return next((v for k, v in self.headers if k.lower() == name), None)


class Members(io.RawIOBase):
    """What gzip members hold, one after the other. Damaged data ends the stream, with what is wrong in ``error``."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.engine, self.fed, self.left, self.error = stream, zlib.decompressobj(31), b"", b"", None

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.left and self.error is None:
            if self.engine.eof:  # zeros may follow a member
                self.fed = self.engine.unused_data.lstrip(b"\0") or self.fed
                self.engine = zlib.decompressobj(31)
            self.fed = self.fed or self.stream.read(1 << 16)
            if not self.fed:
                self.error = "EOFError: the archive is cut off" if self.begun else None
                return 0
            try:
                self.left, self.begun = self.engine.decompress(self.fed, 1 << 20), True
                self.fed = self.engine.unconsumed_tail
            except zlib.error as e:
                self.error = f"zlib.error: {e}"
            if self.engine.eof:
                self.begun = False
        n = min(len(into), len(self.left))
        into[:n], self.left = self.left[:n], self.left[n:]
        return n

    begun = False


def plain(stream: BinaryIO) -> io.BufferedReader:
    """The stream with buffered lines, or what its gzip members hold; a damaged one ends early, with ``raw.error`` set."""
    head = stream.read(2)
    stream.seek(0)
    return io.BufferedReader(Members(stream) if head == b"\x1f\x8b" else stream, 1 << 17)


def _headers(lines: list[bytes]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in b" \t" and out:  # a folded value
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip().decode('utf-8', 'replace')}")
        elif b":" in line:
            k, v = line.split(b":", 1)
            out.append((k.strip().decode("utf-8", "replace"), v.strip().decode("utf-8", "replace")))
    return out


def records(stream: BinaryIO) -> Iterator[WarcRecord]:
    """The records of a decompressed stream. Offsets count decompressed bytes; bytes that begin no record are passed over."""
    at = 0
    while line := stream.readline(MAX_HEADER):
        begin, at = at, at + len(line)
        if not line.startswith(b"WARC/"):
            continue
        lines: list[bytes] = []
        while more := stream.readline(MAX_HEADER):
            at += len(more)
            if not (more := more.rstrip(b"\r\n")):
                break
            lines.append(more)
        record = WarcRecord(begin, line.strip().decode("ascii", "replace"), _headers(lines))
        length = record.header("Content-Length") or ""
        size = int(length) if length.isascii() and length.isdigit() else 0
        record.block = stream.read(size)
        at += len(record.block)
        record.truncated = len(record.block) < size
        yield record


@dataclass
class HttpMessage:
    status: str | None
    headers: list[tuple[str, str]]
    body: bytes

    def header(self, name: str) -> str | None:
        name = name.lower()
        return next((v for k, v in self.headers if k.lower() == name), None)


def http(block: bytes) -> HttpMessage:
    """Status, headers and body of an HTTP response; without a status line all of it is body."""
    if not block.startswith(b"HTTP"):
        return HttpMessage(None, [], block)
    ends = [(block.find(sep), len(sep)) for sep in (b"\r\n\r\n", b"\n\n")]
    end, width = min(((e, w) for e, w in ends if e >= 0), default=(len(block), 0))
    first, *lines = block[:end].replace(b"\r\n", b"\n").split(b"\n")
    words = first.split()
    return HttpMessage(words[1].decode("latin-1") if len(words) > 1 else None, _headers(lines), block[end + width :])


def arc_records(stream: BinaryIO) -> Iterator[WarcRecord]:
    """Records of the older format: a line of url, address, date, type and length, then the block."""
    at = 0
    while line := stream.readline(MAX_HEADER):
        begin, at = at, at + len(line)
        words = line.decode("utf-8", "replace").split()
        if len(words) < 5 or not words[-1].isdigit():
            continue
        block = stream.read(int(words[-1]))
        at += len(block)
        headers = [("WARC-Type", "arc"), ("WARC-Target-URI", " ".join(words[:-4])), ("WARC-IP-Address", words[-4]), ("WARC-Date", words[-3]), ("Content-Type", words[-2]), ("Content-Length", words[-1])]
        if not words[0].startswith("filedesc:"):
            yield WarcRecord(begin, "ARC", headers, block, len(block) < int(words[-1]))


def all_records(stream: BinaryIO, name: str) -> Iterator[WarcRecord]:
    """Records of either format, told apart by the file's name."""
    return arc_records(stream) if name.lower().removesuffix(".gz").endswith(".arc") else records(stream)
