"""Stored members of ZIP packages by range reads, without extraction.

Only the end of the package and its central directory are read to know the members;
ZIP64 records are followed where a size or an offset does not fit 32 bits.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from typing import BinaryIO, Protocol

# Signatures and sizes of the ZIP format.
_END, _END64, _END64_AT = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_ENTRY, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_END_SIZE, _END64_AT_SIZE, _ENTRY_SIZE, _LOCAL_SIZE = 22, 20, 46, 30
_MAX_COMMENT = 0xFFFF
_NONE32, _NONE16 = 0xFFFFFFFF, 0xFFFF
_ZIP64_FIELD = 1
STORED = 0


class RandomAccess(Protocol):
    def size(self) -> int: ...
    def read_at(self, nbytes: int, offset: int) -> bytes: ...


class SeekableFile:
    """RandomAccess over a plain binary file object."""

    def __init__(self, file: BinaryIO) -> None:
        self._file = file

    def size(self) -> int:
        return self._file.seek(0, 2)

    def read_at(self, nbytes: int, offset: int) -> bytes:
        self._file.seek(offset)
        return self._file.read(nbytes)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    local_header: int


def _directory(file: RandomAccess) -> tuple[int, int, int]:
    """Offset, size and number of entries of the central directory."""
    total = file.size()
    tail_size = min(total, _END_SIZE + _MAX_COMMENT + _END64_AT_SIZE)
    tail = file.read_at(tail_size, total - tail_size)
    at = tail.rfind(_END)
    while at >= 0:  # the signature may stand in a comment: its length must fit
        if at + _END_SIZE <= len(tail):
            (comment,) = struct.unpack_from("<H", tail, at + 20)
            if at + _END_SIZE + comment == len(tail):
                break
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP package: no end record")
    entries, size, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries == _NONE16 or _NONE32 in (size, offset):
        locator = at - _END64_AT_SIZE
        if locator < 0 or tail[locator : locator + 4] != _END64_AT:
            raise ValueError("ZIP64 locator is missing")
        (end64,) = struct.unpack_from("<Q", tail, locator + 8)
        record = file.read_at(56, end64)
        if record[:4] != _END64:
            raise ValueError("ZIP64 end record is missing")
        entries, size, offset = struct.unpack_from("<QQQ", record, 32)
    return offset, size, entries


def _wide(extra: bytes, size: int, packed: int, offset: int) -> tuple[int, int]:
    """Size and offset with the 64-bit values of the extra field where they stand in."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == _ZIP64_FIELD:
            values = list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if size == _NONE32 and values:
                size = values.pop(0)
            if packed == _NONE32 and values:
                values.pop(0)
            if offset == _NONE32 and values:
                offset = values.pop(0)
        at += 4 + length
    return size, offset


def members(file: RandomAccess) -> list[Member]:
    """All members, from the central directory alone."""
    offset, size, entries = _directory(file)
    directory = file.read_at(size, offset)
    found, at = [], 0
    for _ in range(entries):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        name_at = at + _ENTRY_SIZE
        extra = directory[name_at + n_name : name_at + n_name + n_extra]
        full, local = _wide(extra, full, packed, local)
        name = directory[name_at : name_at + n_name].decode("utf-8", "replace")
        found.append(Member(name, method, full, local))
        at = name_at + n_name + n_extra + n_comment
    return found


def data_offset(file: RandomAccess, member: Member) -> int:
    """Where a stored member's bytes begin in the package."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed: ranges of it cannot be read")
    header = file.read_at(_LOCAL_SIZE, member.local_header)
    if header[:4] != _LOCAL:
        raise ValueError(f"{member.name}: no local header")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.local_header + _LOCAL_SIZE + n_name + n_extra
