"""WARC records as bytes: writing and parsing."""

from __future__ import annotations

import gzip
from dataclasses import dataclass

_NEW_LINE = b"\r\n"
_VERSION = b"WARC/1.1"


@dataclass(frozen=True)
class Record:
    """Named fields of the record, HTTP fields of its block, and the payload."""

    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @property
    def kind(self) -> str:
        return self.fields["warc-type"]


def _one_line(value: str) -> str:
    """Field values cannot hold line breaks; those and '%' are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _lines(fields: dict[str, str]) -> bytes:
    return b"".join(f"{k}: {_one_line(v)}\r\n".encode() for k, v in fields.items())


def write_record(fields: dict[str, str], payload_bytes: int, payload: bytes) -> bytes:
    """A record whose block is an HTTP response head and the payload (none: a revisit).

    The head carries the length of the full payload, also where the block has none.
    """
    head = b"HTTP/1.1 200 OK\r\n" + _lines(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(payload_bytes)}
    )
    block = head + _NEW_LINE + payload
    named = fields | {
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return _VERSION + _NEW_LINE + _lines(named) + _NEW_LINE + block + _NEW_LINE * 2


def _parsed(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = _plain(value.strip())
    return found


def parse_record(raw: bytes) -> Record:
    """The record that raw holds; raw may be one gzip member."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    head, found, rest = raw.partition(_NEW_LINE * 2)
    lines = head.split(_NEW_LINE)
    if not found or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _parsed(lines[1:])
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("the record is cut off")
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return Record(fields, {}, block)
    http_head, _, payload = block.partition(_NEW_LINE * 2)
    return Record(fields, _parsed(http_head.split(_NEW_LINE)[1:]), payload)
