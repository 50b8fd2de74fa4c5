"""Spelling variants: words that differ by one letter, and the form they stand for.

1. Tasks count the words of whole texts and hand on sums, which are added up by word.
2. Two words with one edit between them agree in the first half or in the second half of
   either. So a word is stored under every half that a word near it can have, and asked
   for under its own two halves. Halves are dealt to shards by hash; a half that more
   words share than fit a shard is split, and is asked for in each of its shards.
3. A shard's words make a bidirectional FM-index. A query's half is matched exactly and
   extended across the other half with one edit (module fm_index). Stored words of a shard
   come first in its partition and queries are streamed past the index, so only one
   shard's index is in memory at a time.
4. A word's form is its most frequent near word, if that is five times as frequent. Forms
   are followed to the last by doubling: every round joins each word to the form of its
   form, so chains, which rise by a factor of five a step, end after few rounds.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseweave.llm.common import materialise, prepare, texts
from caseweave.llm.fm_index import WordIndex

MIN_LETTERS = 6
MIN_COUNT = 5
FORM_FACTOR = 5
# One run in so many loses a letter (a fixed value of the count).
TYPO_RATE = 199

# Letters (delimiters included) that one shard's index is meant to hold.
SHARD_SYMBOLS = 250_000
# Different words that a task counts before it hands on what it has.
_HELD_WORDS, _HELD_LETTERS = 300_000, 4_000_000
_QUERIES = 8192
_SHARDED = ("h", "part", "asks", "word", "n")

# Runs of fewer letters make no word: losing a letter only shortens them.
_RUNS = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


def counted_words(doc_id: int | None, text: str) -> Counter[str]:
    """Words of a text with their number, long enough or not."""
    lowered = text.encode("utf-8", "replace").lower().decode("utf-8")  # A-Z alone
    runs = Counter(_RUNS.findall(lowered))
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter[str] = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), begin)
        if h % TYPO_RATE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        words[run] += n
    return words


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: words of at least MIN_LETTERS letters and MIN_COUNT occurrences."""
    schema = "word string, n long"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        letters = 0

        def batch_of() -> pa.RecordBatch:
            rows = {"word": list(held), "n": list(held.values())}
            return pa.RecordBatch.from_pydict(rows, schema=target)

        for batch in batches:
            ids, bodies = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc_id, text in zip(ids, bodies, strict=True):
                for word, n in counted_words(doc_id, text).items():
                    if word not in held:
                        letters += len(word)
                    held[word] += n
                if len(held) > _HELD_WORDS or letters > _HELD_LETTERS:
                    yield batch_of()
                    held.clear()
                    letters = 0
        if held:
            yield batch_of()

    counts = texts(docs).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.length("word") >= MIN_LETTERS) & (F.col("n") >= MIN_COUNT))


def _halves(of_length: Column) -> tuple[Column, Column]:
    first = F.floor(of_length / 2).cast("int")
    return first, (of_length - first).cast("int")


def _key(side: str, half: Column) -> Column:
    return F.struct(F.lit(side).alias("side"), half.alias("half"))


def _stored_keys(word: Column) -> Column:
    """Halves under which a query of one letter less, as many or one more asks."""
    n = F.length(word)
    keys = []
    for length in (n - 1, n, n + 1):
        first, second = _halves(length)
        keys.append(_key("first", F.substring(word, F.lit(1), first)))
        keys.append(_key("second", F.substring(word, n - second + 1, second)))
    return F.array_distinct(F.array(*keys))


def _asked_keys(word: Column) -> Column:
    n = F.length(word)
    first, second = _halves(n)
    return F.array(
        _key("first", F.substring(word, F.lit(1), first)),
        _key("second", F.substring(word, first + 1, second)),
    )


def _sharded(words: DataFrame) -> tuple[DataFrame, int]:
    """h, part (the shard), asks, word, n: stored words (asks 0) and queries by their
    first half (1) and second half (2); the number of shards."""
    stored = words.select("word", "n", F.explode(_stored_keys(F.col("word"))).alias("key"))
    stored = stored.select("word", "n", "key.side", "key.half")
    asked = words.select("word", "n", F.explode(_asked_keys(F.col("word"))).alias("key"))
    asked = asked.select("word", "n", "key.side", "key.half")
    symbols = stored.groupBy("side", "half").agg(F.sum(F.length("word") + 1).alias("symbols"))
    symbols = materialise(symbols, "halves")
    total = symbols.agg(F.sum("symbols")).first()[0] or 0
    n_shards = max(1, -(-total // SHARD_SYMBOLS))
    full = symbols.where(F.col("symbols") > SHARD_SYMBOLS).select(
        F.col("side").alias("full_side"),
        F.col("half").alias("full_half"),
        F.ceil(F.col("symbols") / SHARD_SYMBOLS).cast("int").alias("parts"),
    )
    full = materialise(full, "full-halves")
    n_parts = full.agg(F.sum("parts")).first()[0] or 0
    here = (F.col("side") == F.col("full_side")) & (F.col("half") == F.col("full_half"))
    by_hash = F.pmod(F.xxhash64("side", "half"), F.lit(n_shards))
    own_part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    all_parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)

    def shard(part: Column) -> tuple[Column, Column]:
        # a full half has shards of its own, which are numbered from 0
        is_full = F.col("parts").isNotNull()
        h = F.when(is_full, F.xxhash64("side", "half")).otherwise(by_hash)
        return h.alias("h"), F.when(is_full, part).otherwise(-1).cast("int").alias("part")

    # a word that a shard holds under several halves is in it once
    kept = stored.join(full, here, "left").select(
        *shard(own_part), F.lit(0).alias("asks"), "word", "n"
    )
    queries = asked.join(full, here, "left").withColumn("at", F.explode(all_parts))
    asks = F.when(F.col("side") == "first", 1).otherwise(2).alias("asks")
    queries = queries.select(*shard(F.col("at")), asks, "word", "n")
    return kept.distinct().unionByName(queries), n_shards + n_parts


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: every ordered pair of words with one edit between them."""
    prepare(words.sparkSession)
    schema = "word string, n long, near string, near_n long"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def found(
        index: WordIndex, counts: dict[str, int], asked: list[tuple[str, int]], half: int
    ) -> pa.RecordBatch:
        of, at = index.near([word for word, _ in asked], by_first_half=half == 1)
        near = [index.words[i] for i in at.tolist()]
        rows = [asked[i] for i in of.tolist()]
        return pa.RecordBatch.from_pydict(
            {
                "word": [word for word, _ in rows],
                "n": [n for _, n in rows],
                "near": near,
                "near_n": [counts[x] for x in near],
            },
            schema=target,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in _SHARDED), strict=True)
        )
        for _, shard in groupby(rows, key=lambda row: row[:2]):
            counts: dict[str, int] = {}
            index: WordIndex | None = None
            for half, part in groupby(shard, key=lambda row: row[2]):
                if half == 0:
                    counts = {word: n for *_, word, n in part}
                elif counts:
                    index = index or WordIndex(list(counts))
                    asked = ((word, n) for *_, word, n in part)
                    while some := list(islice(asked, _QUERIES)):
                        yield found(index, counts, some, half)

    rows, n_shards = _sharded(words)
    rows = rows.repartition(n_shards, "h", "part").sortWithinPartitions("h", "part", "asks")
    return rows.mapInArrow(run, schema)


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last. Only words with a form are listed."""
    step = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = step.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")
        )
        moved = materialise(moved, "roots")
        step = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return step


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root: one row per word of the vocabulary.

    A word without near words has n_near 0; one without form has NULL as form and form_n
    and is its own root. NULL and empty texts have no words; for a NULL doc_id the hashed
    text begins with the colon. Repeated rows count each. An empty table, or one without
    frequent words, gives an empty one; further columns are ignored.
    """
    prepare(docs.sparkSession)
    words = materialise(word_counts(docs), "words")
    # ties of n: the smallest in code-point order, which is that of UTF-8 bytes
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words).groupBy("word").agg(
        F.first("n").alias("own"), F.count(F.lit(1)).alias("n_near"), best.alias("best")
    )
    big = -F.col("best.less") >= FORM_FACTOR * F.col("own")
    near = near.select(
        "word",
        "n_near",
        F.when(big, F.col("best.near")).alias("form"),
        F.when(big, -F.col("best.less")).alias("form_n"),
    )
    near = materialise(near, "near")
    roots = _roots(near.where(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("form_n").cast("long").alias("form_n"),
    )
