from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import random
import zlib
import zipfile

import pytest

from caseweave.llm import warc, web_archive, zip_ranges
from caseweave.llm.common import scratch_path
from caseweave.llm.fingerprints import common_pieces, edited, fingerprint, fingerprints, likeness, parse

from .conftest import LONG, ODD, prose


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


def test_common_pieces_match_the_table():
    draw = random.Random(1)
    for _ in range(300):
        a, b = (tuple(draw.choice("abcd") for _ in range(draw.randint(0, 70))) for _ in range(2))
        assert common_pieces(a, b) == slow_common(a, b)


def test_fingerprints_tell_edits_from_others():
    for i in range(40):
        text, other = prose(i, 300 + 20 * i, 5000), prose(1000 + i, 300, 5000)
        words = text.split()
        words[len(words) // 2] = "changed"
        own = fingerprint(text)
        assert parse(str(own)) == own
        assert likeness(own, fingerprint(" ".join(words))) > 0.85
        assert likeness(own, fingerprint(edited(text, other))) > 0.3
        assert likeness(own, fingerprint(other)) < 0.2
    assert likeness(fingerprint(""), fingerprint("")) == 1.0
    assert likeness(fingerprint(""), fingerprint("abc")) == 0.0
    assert likeness(fingerprint(LONG), fingerprint(LONG + " end")) > 0.9


def expected_rows(rows):
    ordered = sorted(
        ((i is not None, i or 0, t or ""), i, t or "") for i, t in rows
    )
    found = []
    for k, (_, doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][2]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other = fingerprint(text), fingerprint(changed)
        found.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), str(own), str(other),
                      likeness(own, other), likeness(own, fingerprint(following))))
    return found


@pytest.mark.parametrize("n", [0, 1, 2, 70])
def test_next_documents_match_brute_force(documents, n):
    draw = random.Random(n)
    rows = [(draw.randint(-(2**60), 2**60), prose(i, draw.randint(0, 60))) for i in range(n)]
    got = [tuple(r) for r in fingerprints(documents(rows)).collect()]
    assert sorted(got) == sorted(expected_rows(rows))


def test_odd_rows_have_fingerprints(documents):
    got = [tuple(r) for r in fingerprints(documents(ODD)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected_rows(ODD)))


def package(monkeypatch, wide):
    if wide:  # the writer then uses 64-bit fields for everything
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\x05\x06 in it, longer than an end record"
        z.writestr("first/ä.txt", b"x" * 100)
        with z.open("second.bin", "w", force_zip64=True) as member:
            member.write(b"0123456789" * 50)
        z.writestr("packed.txt", b"y" * 1000, zipfile.ZIP_DEFLATED)
    return zip_ranges.SeekableFile(out)


@pytest.mark.parametrize("wide", [False, True])
def test_members_by_ranges(monkeypatch, wide):
    file = package(monkeypatch, wide)
    found = {m.name: m for m in zip_ranges.members(file)}
    assert {n: m.size for n, m in found.items()} == {"first/ä.txt": 100, "second.bin": 500, "packed.txt": 1000}
    at = zip_ranges.data_offset(file, found["second.bin"])
    assert file.read_at(10, at + 490) == b"0123456789"
    with pytest.raises(ValueError):
        zip_ranges.data_offset(file, found["packed.txt"])
    with pytest.raises(ValueError):
        zip_ranges.members(zip_ranges.SeekableFile(io.BytesIO(b"nothing")))


def test_records_round_trip():
    fields = {"WARC-Type": "response", "WARC-Target-URI": "http://a/%41\r\nX: y"}
    payload = b"\r\n\r\n<html>\0\xff"
    record = warc.parse_record(warc.write_record(fields, len(payload), payload))
    assert (record.kind, record.payload) == ("response", payload)
    assert record.fields["warc-target-uri"] == "http://a/%41\r\nX: y"
    with pytest.raises(ValueError):
        warc.parse_record(warc.write_record(fields, 3, b"abc")[:-6])


PAGES = "page_id long, url string, html string, digest string, size long, offset long"


def page_rows():
    large, exact, less = "é" * 600, "a" * 1000, "a" * 999
    rows = [(i, f"http://h/{i}", large) for i in range(60)]
    rows += [(100, None, exact), (101, "", exact), (102, "u\nv", less), (103, "u", less)]
    rows += [(104, "u", None), (105, "u", ""), (None, "u", exact), (None, None, None)]
    rows += [(106, "u", "b" * 2000), (106, "u", "b" * 2000), (107, "u", prose(1, 30000))]
    return rows


def test_archives_give_every_page_back(spark, counted):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "clash", 5, 6) for r in rows], PAGES).repartition(5)
    latest = {}
    for page_id, _, html in rows:
        if page_id is not None:
            latest[html or ""] = max(page_id, latest.get(html or "", page_id))
    expected = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        to = latest.get(html or "") if page_id is not None and len(raw) >= 1000 else None
        to = to if to is not None and to > page_id else None
        row = (page_id, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to)
        expected[row] = expected.get(row, 0) + 1
    got = web_archive.archive_round_trip(pages)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert counted(got, *names) == expected


def test_packages_are_of_bounded_size_and_hold_payloads(spark, monkeypatch):
    monkeypatch.setattr(web_archive, "PACKAGE_BYTES", 20_000)
    rows = [(i, "u", prose(i, 300)) for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    manifest = web_archive.write_archives(pages, scratch_path(spark, "packages"))
    assert manifest.count() > 1
    found = {r.page_id: (r.url, r.payload.decode()) for r in web_archive.read_records(manifest).collect()}
    assert found == {i: (u, h) for i, u, h in rows}


def test_no_pages(spark):
    assert web_archive.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def plain_pieces(data, block):
    """Piece hashes by a loop over bytes, each rolling hash worked out on its own."""
    codes, begin = [], 0
    for end in range(1, len(data) + 1):
        h = sum((data[end - 1 - k] + 1) * pow(0x01000193, k, 1 << 32) for k in range(min(7, end)))
        h &= 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x2C1B3C6D & 0xFFFFFFFF
        h ^= h >> 12
        if h < (1 << 32) // block or end == len(data):
            codes.append(zlib.crc32(data[begin:end]) & 0xFFF)
            begin = end
    kept = [c for i, c in enumerate(codes) if i < 3 or codes[i - 3 : i] != [c] * 3]
    return kept


def test_fingerprint_matches_a_plain_loop():
    texts = [prose(i, n) for i, n in enumerate((1, 9, 60, 300, 900, 2500))]
    texts += ["one line again\n" * 120, "ab" * 900, "x", prose(3, 40) + "\n" * 700, "é日" * 300]
    for text in texts:
        data, found = text.encode(), fingerprint(text)
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
        for doubling, level in enumerate(found.levels):
            want = plain_pieces(data, found.block << doubling)
            assert [64 * letters.index(c[0]) + letters.index(c[1]) for c in level] == want
        assert len(found.levels[0]) <= 128  # all pieces, and not more than a fingerprint has
        if found.block > 4 and len(found.levels[0]) < 64:
            assert len(plain_pieces(data, found.block // 2)) > 128


def test_few_pieces_only_where_a_text_has_no_more():
    found = fingerprint(" ".join(f"{i} same words again and again" for i in range(400)))
    assert 32 <= len(found.levels[0]) <= 128


def foreign_record(n, kind="response", payload=b"<p>hello</p>", digest=True):
    sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:00000000-0000-0000-0000-{n:012}>",
        "WARC-Date": "2023-05-06T07:08:09Z",
        "WARC-Target-URI": f"https://www.example.com/{n}",
    }
    if digest:
        fields["WARC-Payload-Digest"] = f"sha1:{sha}"
    return gzip.compress(warc.write_record(fields, len(payload), payload if kind != "revisit" else b""))


def foreign_package(path, compressed=False):
    """Two archive members, an index in gzip blocks with key, timestamp and base names,
    numbers as texts and as numbers, ZIP64 headers, and a compressed list of pages."""
    names, lines = ("one.warc.gz", "two.warc.gz"), []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as package:
        package.writestr("pages/pages.jsonl", "{}\n" * 500, compress_type=zipfile.ZIP_DEFLATED)
        for k, name in enumerate(names):
            how = zipfile.ZIP_DEFLATED if compressed and k else zipfile.ZIP_STORED
            info = zipfile.ZipInfo(f"archive/{name}")
            info.compress_type = how
            with package.open(info, "w", force_zip64=True) as member:
                at = 0
                for n in range(10 * k, 10 * k + 10):
                    record = foreign_record(n, "revisit" if n % 4 == 3 else "response", digest=n % 5 > 0)
                    member.write(record)
                    number = str if n % 2 else int
                    entry = {"url": f"https://www.example.com/{n}", "offset": number(at),
                             "length": number(len(record)), "filename": name}
                    lines.append(f"com,example)/{n} 20230506070809 {json.dumps(entry)}\n")
                    at += len(record)
        lines.sort()
        blocks = ["!meta 0 {\"format\": \"cdxj-gzip-1.0\"}\n", *lines]
        zipped = b"".join(gzip.compress("".join(blocks[i : i + 6]).encode()) for i in range(0, len(blocks), 6))
        package.writestr("indexes/index.cdx.gz", zipped)
        package.writestr("indexes/index.idx", "com,example)/0 20230506 {\"offset\": 0}")
        package.writestr("datapackage.json", "{}", compress_type=zipfile.ZIP_DEFLATED)


def test_a_package_of_others_is_read(spark, tmp_path):
    foreign_package(tmp_path / "other.wacz")
    listed = spark.createDataFrame([(f"file://{tmp_path}/other.wacz",)], "package string")
    got = {r.url: r for r in web_archive.read_records(listed).collect()}
    assert sorted(got) == sorted(f"https://www.example.com/{n}" for n in range(20))
    for n in range(20):
        r = got[f"https://www.example.com/{n}"]
        revisit = n % 4 == 3
        assert (r.page_id, r.refers_to, r.record_type) == (None, None, "revisit" if revisit else "response")
        assert r.payload_bytes == 12 and (r.payload is None) == revisit
        if not revisit or n % 5:
            assert r.payload_digest == hashlib.sha1(b"<p>hello</p>").hexdigest()


def test_a_compressed_archive_is_an_error(spark, tmp_path):
    foreign_package(tmp_path / "packed.wacz", compressed=True)
    listed = spark.createDataFrame([(f"file://{tmp_path}/packed.wacz",)], "package string")
    with pytest.raises(Exception, match="is compressed"):
        web_archive.read_records(listed).collect()


def test_own_packages_have_a_plain_index(spark, tmp_path):
    rows = [(i, f"http://www.Example.org:8080/a b?q={i % 3}", f"page {i}") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = web_archive.write_archives(pages.coalesce(1), f"file://{tmp_path}/out").collect()
    assert len(manifest) == 1
    with zipfile.ZipFile(manifest[0].package.removeprefix("file://")) as package:
        lines = package.read("indexes/index.cdxj").decode().splitlines()
        described = json.loads(package.read("datapackage.json"))
        data = package.read("archive/data.warc.gz")
    assert lines == sorted(lines) and len(lines) == 9
    key, stamp, entry = lines[0].split(" ", 2)
    assert (key, stamp) == ("org,example:8080)/a%20b?q=0", "20240101000000")
    entry = json.loads(entry)
    begin, size = int(entry["offset"]), int(entry["length"])
    assert entry["filename"] == "data.warc.gz"
    assert warc.parse_record(data[begin : begin + size]).fields["warc-target-uri"] == entry["url"]
    assert {r["path"] for r in described["resources"]} == {"archive/data.warc.gz", "indexes/index.cdxj"}
    assert described["resources"][0]["hash"] == "sha256:" + hashlib.sha256(data).hexdigest()


def test_url_keys():
    key = web_archive.url_key
    assert key("https://www.example.com") == "com,example)/"
    assert key("http://a.b.Example.com/X/y?Z=1") == "com,example,b,a)/x/y?z=1"
    assert key(None) == key("") == "-"
    assert key("no address") == "no%20address"
    assert key("http://[broken/x y") == "http://[broken/x%20y"
