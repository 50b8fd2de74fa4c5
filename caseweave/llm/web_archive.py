"""Web pages to ZIP-packaged WARC archives and back.

Writing: tasks write packages of bounded size with a stored archive/data.warc.gz, a
stored indexes/index.cdxj (lines of key, timestamp and JSON, sorted) and a
datapackage.json each. Equal payloads are stored once: the record with the largest
page_id is the response, the others revisit it. The packages that a finished task
reports are the manifest; what a lost or repeated attempt wrote is in no manifest.

Reading, also packages of others: the central directories and indexes, plain or in
gzip blocks, give a row per record, these are dealt out again, and each record is read by
its range of bytes. Archives and indexes have to be stored; a compressed one is an error
that says so. Other members are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseweave.llm import warc, zip_ranges
from caseweave.llm.common import materialise, parallelism, prepare, scratch_path

PACKAGE_BYTES = 32 << 20
LEAST_REVISIT_BYTES = 1000
RANGE_ROWS = 64
#: All records of one run carry the same date, so that reruns write equal records.
RECORD_DATE = "2024-01-01T00:00:00Z"

_WARC, _INDEX, _PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
_ARCHIVES, _INDEXES = "archive/", "indexes/"
_BLOCK = 1 << 20
_ID = "urn:caseweave:page:"
_MANIFEST = "package string, records long, bytes long"
_RANGES = "package string, offset long, length long"
_RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def record_roles(pages: DataFrame) -> DataFrame:
    """The pages (page_id, url, html) with digest, size and refers_to.

    Only ids and digests are grouped and joined by digest; pages are joined by id, so a
    payload that very many pages share moves no page text to one task. A page without
    id can neither revisit nor be revisited.
    """
    html = F.coalesce("html", F.lit(""))
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        html.alias("html"),
        F.octet_length(html).cast("long").alias("size"),
        F.sha1(F.encode(html, "UTF-8")).alias("digest"),
    )
    large = read.where(F.col("page_id").isNotNull() & (F.col("size") >= LEAST_REVISIT_BYTES))
    ids = large.select("page_id", "digest")
    latest = ids.groupBy("digest").agg(
        F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")
    )
    latest = latest.where(F.col("least") < F.col("refers_to")).drop("least")
    revisits = (
        ids.join(latest, "digest").where(F.col("page_id") < F.col("refers_to")).distinct()
    )
    return read.join(revisits, ["page_id", "digest"], "left")


def url_key(url: str | None) -> str:
    """The key of an address in an index: host from the right, then path and query."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.replace(" ", "%20").lower()
    if not host:
        return url.replace(" ", "%20").lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{key}){rest}".replace(" ", "%20").lower()


class _Package:
    """One package that is being written; its WARC member is streamed."""

    def __init__(self, folder: str) -> None:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        self._sink = system.open_output_stream(f"{path}/{self.uri.rpartition('/')[2]}")
        self._zip = zipfile.ZipFile(self._sink, "w", zipfile.ZIP_STORED)
        self._member = self._zip.open(_WARC, "w", force_zip64=True)
        self._index: list[str] = []
        self._sha = hashlib.sha256()
        self.size = 0

    def add(self, url: str | None, digest: str, record: bytes) -> None:
        """Each record is a gzip member of its own, so that ranges can be read alone."""
        record = gzip.compress(record, mtime=0)
        entry = {
            "url": url or "",
            "mime": "text/html",
            "status": "200",
            "digest": f"sha1:{digest}",
            "length": str(len(record)),
            "offset": str(self.size),
            "filename": _WARC.removeprefix(_ARCHIVES),
        }
        stamp = "".join(c for c in RECORD_DATE if c.isdigit())
        self._index.append(f"{url_key(url)} {stamp} {json.dumps(entry)}")
        self._member.write(record)
        self._sha.update(record)
        self.size += len(record)

    def close(self) -> tuple[str, int, int]:
        self._member.close()
        index = "".join(f"{line}\n" for line in sorted(self._index)).encode()
        self._zip.writestr(_INDEX, index)
        resources = [
            {"name": name.rpartition("/")[2], "path": name, "hash": f"sha256:{sha}", "bytes": size}
            for name, sha, size in (
                (_WARC, self._sha.hexdigest(), self.size),
                (_INDEX, hashlib.sha256(index).hexdigest(), len(index)),
            )
        ]
        package = {"profile": "data-package", "wacz_version": "1.1.1", "resources": resources}
        self._zip.writestr(_PACKAGE, json.dumps(package, indent=1))
        self._zip.close()
        self._sink.close()
        return self.uri, len(self._index), self.size


def _record(page_id: int | None, url: str | None, html: str, digest: str, refers: int | None) -> bytes:
    payload = html.encode("utf-8", "replace")
    fields = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<{_ID}{'' if page_id is None else page_id}>",
        "WARC-Date": RECORD_DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if url is not None:
        fields["WARC-Target-URI"] = url
    if refers is not None:
        fields["WARC-Refers-To"] = f"<{_ID}{refers}>"
        fields["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    return warc.write_record(fields, len(payload), payload if refers is None else b"")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page to packages below folder; the manifest, materialised."""
    schema = to_arrow_schema(StructType.fromDDL(_MANIFEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package: _Package | None = None

        def done() -> pa.RecordBatch:
            row = dict(zip(schema.names, package.close(), strict=True))
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                package = package or _Package(folder)
                record = _record(
                    row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"]
                )
                package.add(row["url"], row["digest"], record)
                if package.size >= PACKAGE_BYTES:
                    yield done()
                    package = None
        if package is not None:
            yield done()

    prepare(pages.sparkSession)
    rows = record_roles(pages).select("page_id", "url", "html", "digest", "refers_to")
    return materialise(rows.mapInArrow(run, _MANIFEST), "manifest")


def _opened(uri: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _index_lines(file: pa.NativeFile, start: int, size: int, zipped: bool) -> Iterator[bytes]:
    """Lines of an index member, read in blocks; gzip blocks may follow each other."""
    unzip = zlib.decompressobj(31) if zipped else None
    rest = b""
    for at in range(0, size, _BLOCK):
        raw = file.read_at(min(_BLOCK, size - at), start + at)
        if unzip is not None:
            plain = b""
            while raw:
                plain += unzip.decompress(raw)
                raw = unzip.unused_data
                if unzip.eof:
                    unzip = zlib.decompressobj(31)
                else:
                    break
            raw = plain
        *lines, rest = (rest + raw).split(b"\n")
        yield from lines
    yield rest


def _entries(file: pa.NativeFile) -> Iterator[tuple[int, int]]:
    """Offset in the package and length of every record of its indexes."""
    by_name = {m.name: m for m in zip_ranges.members(file)}
    starts: dict[str, int] = {}

    def start(name: str) -> int:
        if name not in starts:
            starts[name] = zip_ranges.data_offset(file, by_name[name])
        return starts[name]

    for name in sorted(by_name):
        plain, zipped = name.endswith((".cdxj", ".cdx")), name.endswith(".gz")
        if not name.startswith(_INDEXES) or not (plain or zipped):
            continue
        for line in _index_lines(file, start(name), by_name[name].size, zipped):
            at = line.find(b"{")
            if at < 0 or line.startswith(b"!"):  # no record: blank, or about the index
                continue
            entry = json.loads(line[at:])
            archive = str(entry["filename"])
            if archive not in by_name:
                archive = _ARCHIVES + archive
            if archive not in by_name:
                raise ValueError(f"{name} names {entry['filename']}, which the package lacks")
            yield start(archive) + int(entry["offset"]), int(entry["length"])


def record_ranges(packages: DataFrame) -> DataFrame:
    """package, offset, length of every record, from directories and indexes alone."""
    schema = to_arrow_schema(StructType.fromDDL(_RANGES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("package").to_pylist():
                with _opened(uri) as file:
                    rows = []
                    for offset, length in _entries(file):
                        rows.append({"package": uri, "offset": offset, "length": length})
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = parallelism(packages.sparkSession)
    return packages.select("package").repartition(n).mapInArrow(run, _RANGES)


def _hex_digest(written: str) -> str | None:
    """A SHA-1 as lower-case hex, which may be written in base 32; None for others."""
    kind, _, digest = written.partition(":")
    if kind.lower() != "sha1":
        return None
    return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()


def _fields_of(record: warc.Record) -> dict[str, object]:
    def page(name: str) -> int | None:
        number = record.fields.get(name, "").strip("<>")
        if not number.startswith(_ID):
            return None  # a record of others
        number = number.removeprefix(_ID)
        return int(number) if number else None

    revisit = record.kind == "revisit"
    digest = _hex_digest(record.fields.get("warc-payload-digest", ""))
    if not revisit:
        found = hashlib.sha1(record.payload).hexdigest()
        if record.fields.get("warc-record-id", "").startswith(f"<{_ID}") and found != digest:
            raise ValueError("payload and digest differ")
        digest = digest or found
    length = record.http.get("content-length", "")
    return {
        "page_id": page("warc-record-id"),
        "url": record.fields.get("warc-target-uri"),
        "payload_bytes": (int(length) if length.isdigit() else None) if revisit else len(record.payload),
        "payload_digest": digest,
        "record_type": record.kind,
        "refers_to": page("warc-refers-to"),
        "payload": None if revisit else record.payload,
    }


def read_records(packages: DataFrame) -> DataFrame:
    """A row per record of the packages; the payload of revisits is NULL, and so are the
    page ids of packages that were not written here."""
    schema = to_arrow_schema(StructType.fromDDL(_RECORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file = None, None
        for batch in batches:
            ranges = batch.to_pylist()
            for begin in range(0, len(ranges), RANGE_ROWS):
                rows = []
                for entry in ranges[begin : begin + RANGE_ROWS]:
                    if entry["package"] != uri:
                        if file is not None:
                            file.close()
                        uri, file = entry["package"], _opened(entry["package"])
                    raw = file.read_at(entry["length"], entry["offset"])
                    rows.append(_fields_of(warc.parse_record(raw)))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if file is not None:
            file.close()

    spark = prepare(packages.sparkSession)
    ranges = record_ranges(packages).repartition(parallelism(spark))
    ranges = ranges.sortWithinPartitions("package", "offset")
    return ranges.mapInArrow(run, _RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to per page, as read
    back from the archives. A NULL html is an empty payload; payloads below
    LEAST_REVISIT_BYTES are all responses; repeated rows are a record each."""
    spark = prepare(pages.sparkSession)
    folder = scratch_path(spark, "archives")
    manifest = write_archives(pages, folder)
    return read_records(manifest).drop("payload", "url")
