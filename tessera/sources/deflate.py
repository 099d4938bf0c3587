"""Entering a gzip file in the middle.

A deflate block can begin at any bit and refers to the 32 KB of text before it.
An access point is therefore a byte, the number of unused bits in the byte before
it, and that window. ``walk`` inflates a file from its start or from a point, over
all members of the file; with ``blocks`` it names the places between blocks. Python's
``zlib`` has no call to start within a byte, so the system's zlib is called through
``ctypes`` (``inflatePrime``, ``inflateSetDictionary``).
"""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

WINDOW = 32 * 1024
_IN, _OUT = 1 << 20, 1 << 18
# zlib's flush modes and return codes, gzip's header flags.
_NO_FLUSH, _BLOCK = 0, 5
_OK, _STREAM_END, _BUF_ERROR = 0, 1, -5
_FHCRC, _FEXTRA, _FNAME, _FCOMMENT = 2, 4, 8, 16


class Point(NamedTuple):
    """Where to enter: ``bits`` of the byte before ``in_byte`` are still unread."""
    in_byte: int
    bits: int
    member: bool                                             # the first block of a member


class _Stream(ctypes.Structure):
    _fields_ = [("next_in", ctypes.c_void_p), ("avail_in", ctypes.c_uint), ("total_in", ctypes.c_ulong),
                ("next_out", ctypes.c_void_p), ("avail_out", ctypes.c_uint), ("total_out", ctypes.c_ulong),
                ("msg", ctypes.c_char_p), ("state", ctypes.c_void_p),
                ("zalloc", ctypes.c_void_p), ("zfree", ctypes.c_void_p), ("opaque", ctypes.c_void_p),
                ("data_type", ctypes.c_int), ("adler", ctypes.c_ulong), ("reserved", ctypes.c_ulong)]


@functools.cache
def _lib() -> ctypes.CDLL:
    name = ctypes.util.find_library("z")
    try:
        lib = ctypes.CDLL(name or "libz.so.1")
    except OSError as e:
        raise RuntimeError("gzip ranges need the system's zlib; read such files with read_delimited") from e
    lib.zlibVersion.restype = ctypes.c_char_p
    return lib


class _Inflater:
    """One raw deflate stream."""

    def __init__(self, bits: int = 0, byte: int = 0, window: bytes = b""):
        self._z, self._out, self._data = _Stream(), ctypes.create_string_buffer(_OUT), b""
        lib = _lib()
        self._check(lib.inflateInit2_(ctypes.byref(self._z), -15, lib.zlibVersion(), ctypes.sizeof(_Stream)))
        if bits:
            self._check(lib.inflatePrime(ctypes.byref(self._z), bits, byte >> (8 - bits)))
        if window:
            self._check(lib.inflateSetDictionary(ctypes.byref(self._z), window, len(window)))

    def _check(self, code: int) -> None:
        if code != _OK:
            raise ValueError(f"damaged gzip data: {(self._z.msg or b'').decode() or code}")

    def feed(self, data: bytes) -> None:
        self._data = data                                    # keeps the buffer alive
        self._z.next_in = ctypes.cast(ctypes.c_char_p(data), ctypes.c_void_p).value
        self._z.avail_in = len(data)

    @property
    def left(self) -> int:
        return self._z.avail_in

    def step(self, blocks: bool) -> tuple[bytes, bool]:
        """Some text, and whether the stream ended with it."""
        self._z.next_out, self._z.avail_out = ctypes.addressof(self._out), _OUT
        code = _lib().inflate(ctypes.byref(self._z), _BLOCK if blocks else _NO_FLUSH)
        if code not in (_OK, _STREAM_END, _BUF_ERROR):
            self._check(code)
        return self._out.raw[:_OUT - self._z.avail_out] if self._z.avail_out < _OUT else b"", code == _STREAM_END

    @property
    def between_blocks(self) -> bool:
        return bool(self._z.data_type & 128) and not self._z.data_type & 64

    @property
    def bits(self) -> int:
        return self._z.data_type & 7

    @property
    def full(self) -> bool:
        return self._z.avail_out == 0

    def close(self) -> None:
        _lib().inflateEnd(ctypes.byref(self._z))


class _Input:
    def __init__(self, f: BinaryIO, at: int):
        f.seek(at)
        self._f, self._buf, self.pos = f, b"", at

    def peek(self, n: int) -> bytes:
        while len(self._buf) < n and (more := self._f.read(max(_IN, n - len(self._buf)))):
            self._buf += more
        return self._buf

    def skip(self, n: int) -> None:
        self._buf, self.pos = self._buf[n:], self.pos + n


def _read_header(src: _Input) -> bool:
    """Moves past a member's header; false at the end (zero padding allowed)."""
    while (head := src.peek(1)) and not head.strip(b"\0"):
        src.skip(len(head))
    if not head:
        return False
    src.skip(len(head) - len(head.lstrip(b"\0")))
    head = src.peek(10)
    if head[:3] != b"\x1f\x8b\x08" or len(head) < 10:
        raise ValueError(f"no gzip member at byte {src.pos}")
    flags = head[3]
    src.skip(10)
    if flags & _FEXTRA:
        (n,) = struct.unpack("<H", src.peek(2)[:2])
        src.skip(2 + n)
    for flag in (_FNAME, _FCOMMENT):
        if flags & flag:
            size = _IN
            while (end := src.peek(size).find(b"\0")) < 0:
                if len(src.peek(size)) < size:
                    raise ValueError("gzip header without an end")
                size *= 2
            src.skip(end + 1)
    if flags & _FHCRC:
        src.skip(2)
    return True


def walk(f: BinaryIO, point: Point | None = None, window: bytes = b"", blocks: bool = False
         ) -> Iterator[tuple[bytes, Point | None]]:
    """(text, point after that text or None) up to the file's end. Members that are
    read from their start are checked against their checksum and length; data that
    end early fail."""
    at = point or Point(0, 0, False)
    src = _Input(f, at.in_byte - (1 if at.bits else 0))
    inside = point is not None
    while True:
        if inside:
            first = 0
            if at.bits:
                first = src.peek(1)[0]
                src.skip(1)
            z, whole, inside = _Inflater(at.bits, first, window), at.member, False
        elif _read_header(src):
            z, whole = _Inflater(), True
            yield b"", Point(src.pos, 0, True)
        else:
            return
        try:
            crc = size = 0
            ended = False
            while not ended:
                data = src.peek(1)
                if not data:
                    raise ValueError("gzip data end early")
                z.feed(data)
                while not ended:
                    before = z.left
                    text, ended = z.step(blocks)
                    crc, size = zlib.crc32(text, crc), size + len(text)
                    between = blocks and not ended and z.between_blocks
                    if text or between:
                        yield text, Point(src.pos + len(data) - z.left, z.bits, False) if between else None
                    # Out of input: nothing left to read, and the text fitted the buffer.
                    if not ended and z.left == 0 and not z.full and (not between or before == 0):
                        break
                src.skip(len(data) - z.left)
        finally:
            z.close()
        tail = src.peek(8)[:8]
        if len(tail) < 8 or whole and struct.unpack("<II", tail) != (crc, size & 0xFFFFFFFF):
            raise ValueError("gzip member fails its checksum or ends early")
        src.skip(8)
