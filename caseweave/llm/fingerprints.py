"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over a few bytes marks where pieces end, so that an edit only changes
the pieces it touches. With block size b a piece ends where the rolling hash is among
the lowest 1/b of its range. The length gives a first b; it is doubled while there are
more than PIECES pieces, and halved while there are fewer than PIECES / 2 and twice as
fine a cut has no more than PIECES. So no piece is cut short and none is left out. A
fingerprint has the piece hashes at b, 2b and 4b; two of them are compared at the block
sizes that both have, by the edit distance (pieces put in or taken out) of their piece
sequences.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseweave.llm.common import BATCH_ROWS, parallelism, prepare, texts

WINDOW = 7
PIECES = 128
RUN = 3
LEAST_BLOCK = 4
LEVELS = 3

# Multiplier of the rolling hash and letters of a piece hash (12 bits).
_FACTOR = 0x01000193
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_CODES = [a + b for a in _LETTERS for b in _LETTERS]


@dataclass(frozen=True)
class Fingerprint:
    """Least block size and the piece codes at it and at each doubling."""

    block: int
    levels: tuple[tuple[str, ...], ...]

    def __str__(self) -> str:
        return ":".join([str(self.block), *("".join(codes) for codes in self.levels)])


def parse(written: str) -> Fingerprint:
    block, *levels = written.split(":")
    return Fingerprint(
        int(block),
        tuple(tuple(codes[i : i + 2] for i in range(0, len(codes), 2)) for codes in levels),
    )


def rolling_hashes(data: bytes) -> np.ndarray:
    """32-bit hash of the last WINDOW bytes at each place (fewer at the start)."""
    letters = np.frombuffer(data, dtype=np.uint8).astype(np.uint32) + np.uint32(1)
    hashes = letters.copy()
    factor = 1
    for back in range(1, min(WINDOW, len(letters))):
        factor = factor * _FACTOR & 0xFFFFFFFF
        hashes[back:] += letters[:-back] * np.uint32(factor)
    hashes ^= hashes >> np.uint32(15)
    hashes *= np.uint32(0x2C1B3C6D)
    hashes ^= hashes >> np.uint32(12)
    return hashes


def _ends(hashes: np.ndarray, block: int) -> np.ndarray:
    return np.flatnonzero(hashes < np.uint32((1 << 32) // block)) + 1


def _codes(data: bytes, ends: np.ndarray) -> tuple[str, ...]:
    """Piece codes. Of a run of equal pieces RUN are kept, so that one repeated line is
    not all of a fingerprint."""
    cuts = ends.tolist()
    if not cuts or cuts[-1] < len(data):
        cuts.append(len(data))
    codes: list[str] = []
    begin, run = 0, 0
    for end in cuts:
        code = _CODES[zlib.crc32(data[begin:end]) & 0xFFF]
        run = run + 1 if codes and codes[-1] == code else 1
        if run <= RUN:
            codes.append(code)
        begin = end
    return tuple(codes)


def fingerprint(text: str) -> Fingerprint:
    """The fingerprint of a whole text; an empty text has no pieces."""
    data = text.encode("utf-8", "replace")
    if not data:
        return Fingerprint(LEAST_BLOCK, ((),) * LEVELS)
    hashes = rolling_hashes(data)
    found: dict[int, tuple[str, ...]] = {}

    def pieces(block: int) -> tuple[str, ...]:
        if block not in found:
            found[block] = _codes(data, _ends(hashes, block))
        return found[block]

    block = LEAST_BLOCK
    while block * PIECES < len(data):
        block *= 2
    while len(pieces(block)) > PIECES:
        block *= 2
    while (
        block > LEAST_BLOCK
        and len(pieces(block)) < PIECES // 2
        and len(pieces(block // 2)) <= PIECES
    ):
        block //= 2
    return Fingerprint(block, tuple(pieces(block << doubling) for doubling in range(LEVELS)))


def common_pieces(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    places: dict[str, int] = {}
    for i, code in enumerate(a):
        places[code] = places.get(code, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for code in b:
        at = places.get(code)
        if at is not None:
            hit = row & at
            row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 less the share of pieces put in or taken out, at the block size of those that
    both have where it is least; 0 where block sizes are too far apart."""
    if a == b:
        return 1.0
    low, high = sorted((a, b), key=lambda f: f.block)
    level = (high.block // low.block).bit_length() - 1
    best = 0.0
    for one, two in zip(low.levels[level:], high.levels, strict=False):
        if one and two:
            best = max(best, 2 * common_pieces(one, two) / (len(one) + len(two)))
    return best


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_NO_ID = -(1 << 63)


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows with the number of their range of keys; ranges hold about as many rows."""
    shares = [i / buckets for i in range(1, buckets)]
    bounds = rows.select("key").approxQuantile("key", shares, 0.25 / buckets) if shares else []
    limits = np.array(sorted({int(b) for b in bounds}), dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, key.to_numpy(np.int64), side="right"))

    return rows.withColumn("bucket", bucket_of("key"))


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """The documents in ranges of doc_id, each range followed by the next one's first row.

    Rows have bucket, tail (1: a copy of the next range's first row), key, doc_id and
    text. Texts are moved once. There is one copy per range, so their number is fixed
    by the number of partitions, and no range is more than its share of the rows.
    """
    spark = prepare(docs.sparkSession)
    parts = parallelism(spark)
    rows = texts(docs).withColumn(
        "key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    )
    rows = _bucketed(rows, 4 * parts)
    # a few numbers per range
    firsts = sorted(rows.groupBy("bucket").agg(F.min("key").alias("first")).collect())
    after = firsts[1:] + firsts[:1]
    copies = [(b.bucket, b.first, a.bucket) for a, b in zip(firsts, after, strict=True)]
    table = spark.createDataFrame(copies, "bucket int, first long, to int")
    here = F.struct(F.col("bucket"), F.lit(0).alias("tail"))
    there = F.struct(F.col("to").alias("bucket"), F.lit(1).alias("tail"))
    placed = rows.join(F.broadcast(table), "bucket").select(
        "key",
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.explode(
            F.when(F.col("key") == F.col("first"), F.array(here, there)).otherwise(F.array(here))
        ).alias("at"),
    )
    return (
        placed.select("at.bucket", "at.tail", "key", "doc_id", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "tail", "key", "text")
    )


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is the one after in ascending doc_id (a NULL id comes first, equal
    ids follow each other by text), after the last the first; a single document is its
    own next one. A NULL text is empty. An empty table gives an empty one.
    """
    schema = to_arrow_schema(StructType.fromDDL(_RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        waiting: tuple[int, int | None, str, Fingerprint] | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "tail", "doc_id", "text")]
            for bucket, tail, doc_id, text in zip(*columns, strict=True):
                if tail and (waiting is None or waiting[0] != bucket):
                    continue
                own = fingerprint(text)
                if waiting is not None:
                    out.append(_row(*waiting[1:], text, own))
                waiting = None if tail else (bucket, doc_id, text, own)
                if len(out) >= BATCH_ROWS:
                    yield _batch(out, schema)
                    out = []
        yield _batch(out, schema)

    return in_order_with_next(docs).select("bucket", "tail", "doc_id", "text").mapInArrow(
        run, _RESULT
    )


def _row(
    doc_id: int | None, text: str, own: Fingerprint, following: str, of_next: Fingerprint
) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
        str(own),
        str(other),
        likeness(own, other),
        likeness(own, of_next),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip(schema.names, row, strict=True)) for row in rows], schema=schema
    )
