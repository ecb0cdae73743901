"""Reading ZIP archives by ranges: the directory first, then only what is asked for.

Works on any random-access file (``size``, ``read_at(offset, length)``) whose
members are stored, not deflated. Handles comments, ZIP64 end records and ZIP64
extra fields; sizes are always taken from the central directory.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

END, END64_LOCATOR, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


class BadArchive(ValueError):
    """Not a ZIP archive that can be read by ranges."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    size: int
    stored_size: int
    header_at: int


ReadAt = Callable[[int, int], bytes]


def _need(data: bytes, n: int, what: str) -> bytes:
    if len(data) < n:
        raise BadArchive(f"the archive ends within its {what}")
    return data


def _directory_place(size: int, read_at: ReadAt) -> tuple[int, int, int]:
    """(offset, size, entries) of the central directory."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read_at(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:  # the comment may hold the signature: the record must end the file
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise BadArchive("no end of central directory")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries == FULL16 or length == FULL32 or offset == FULL32:
        locator = read_at(tail_at + at - 20, 20) if tail_at + at >= 20 else b""
        if locator[:4] != END64_LOCATOR:
            raise BadArchive("no ZIP64 locator")
        end64 = _need(read_at(struct.unpack_from("<Q", locator, 8)[0], 56), 56, "ZIP64 end record")
        if end64[:4] != END64:
            raise BadArchive("no ZIP64 end of central directory")
        entries, length, offset = struct.unpack_from("<QQQ", end64, 32)
    return offset, length, entries


def _wide(extra: bytes, size: int, stored: int, at: int) -> tuple[int, int, int]:
    """Sizes and offset with those that are full in the entry taken from its ZIP64 field."""
    i = 0
    while i + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, i)
        if kind == 1:
            field, j, out = extra[i + 4:i + 4 + n], 0, []
            for v in (size, stored, at):
                if v == FULL32:
                    v = struct.unpack_from("<Q", _need(field[j:], 8, "ZIP64 field"))[0]
                    j += 8
                out.append(v)
            return tuple(out)
        i += 4 + n
    if FULL32 in (size, stored, at):
        raise BadArchive("no ZIP64 field")
    return size, stored, at


def members(size: int, read_at: ReadAt) -> list[Member]:
    """The entries of the central directory, in its order."""
    offset, length, entries = _directory_place(size, read_at)
    data, i, out = _need(read_at(offset, length), length, "central directory"), 0, []
    for _ in range(entries):
        _need(data[i:i + 46], 46, "central directory")
        if data[i:i + 4] != ENTRY:
            raise BadArchive("no entry where the central directory says")
        flags, method = struct.unpack_from("<HH", data, i + 8)
        stored, full, n, m, k = struct.unpack_from("<IIHHH", data, i + 20)
        at = struct.unpack_from("<I", data, i + 42)[0]
        name = data[i + 46:i + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        full, stored, at = _wide(data[i + 46 + n:i + 46 + n + m], full, stored, at)
        out.append(Member(name, method, flags, full, stored, at))
        i += 46 + n + m + k
    return out


def data_start(member: Member, read_at: ReadAt) -> int:
    """Where a stored member's bytes begin; the local header's own lengths count."""
    if member.method != 0 or member.flags & 1 or member.size != member.stored_size:
        raise BadArchive(f"{member.name} is not stored plainly")
    head = _need(read_at(member.header_at, 30), 30, "local header")
    if head[:4] != LOCAL:
        raise BadArchive(f"no local header for {member.name}")
    n, m = struct.unpack_from("<HH", head, 26)
    return member.header_at + 30 + n + m
