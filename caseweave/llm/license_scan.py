"""Licence phrases and notices in texts, with DataFrame functions only.

Notices are found by diagonal voting: the rolling hashes of GRAM words of every
text are joined to the positions of the same grams in the notices; a match votes
for its offset (word position less notice position). Around every offset with votes
the neighbouring ones (words added or left out) are merged to a span, which so is about
as long as the notice, whatever else of it stands nearby. A span is verified by its
words: each gram of the notice counts once, at its place nearest to the offset, and only
if it stands behind the grams before it. The best span of a notice is taken.

The notices are constants of the library, so their table has a fixed size and is
broadcast. Texts are not shuffled: only votes and per-document counts are.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.llm.common import prepare
from caseweave.llm.license_texts import NOTICES, PHRASES

GRAM = 3
DRIFT = 3
COVERAGE = 0.6

# Fixed value: everything in ASCII but digits and lower-case letters ends a word.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# The two other characters whose lower case holds an ASCII letter.
_KELVIN, _DOTTED_I = "\u212a", "\u0130"


def _normal(text: Column) -> Column:
    """Lower-cased words, joined by single spaces.

    lower() is many times faster than translate(). It also changes letters beyond
    ASCII, which are never part of a phrase or notice; the two that would turn into
    ASCII letters are replaced first, so the words found are those of A-Z alone.
    """
    known = F.coalesce(text, F.lit(""))
    for letter in (_KELVIN, _DOTTED_I):
        known = F.replace(known, F.lit(letter), F.lit("\u00e6"))
    return F.trim(F.regexp_replace(F.lower(known), _SEPARATORS, " "))


def _words(normal: Column) -> Column:
    return F.when(normal == "", F.array().cast("array<string>")).otherwise(F.split(normal, " "))


def _rolling(words: Column, width: int) -> Column:
    """Hashes of every `width` consecutive words, in order."""
    n = F.size(words) - (width - 1)
    hashes = F.transform(F.slice(words, 1, F.greatest(n, F.lit(0))), lambda w: F.xxhash64(w))
    for k in range(1, width):
        shifted = F.slice(words, k + 1, F.greatest(n, F.lit(0)))
        hashes = F.zip_with(hashes, shifted, lambda h, w: F.xxhash64(h, w))
    return hashes


def notice_grams(spark: SparkSession) -> DataFrame:
    """notice, label, n_grams, notice_words, at, gram: one row per gram of each notice."""
    rows = [(i, label, text) for i, (label, text) in enumerate(NOTICES)]
    notices = spark.createDataFrame(rows, "notice int, label string, text string")
    words = notices.select("notice", "label", _words(_normal(F.col("text"))).alias("words"))
    grams = words.select(
        "notice",
        "label",
        F.size("words").alias("notice_words"),
        _rolling(F.col("words"), GRAM).alias("grams"),
    )
    return grams.select(
        "notice",
        "label",
        "notice_words",
        F.size("grams").alias("n_grams"),
        F.posexplode("grams").alias("at", "gram"),
    )


def notice_spans(docs: DataFrame) -> DataFrame:
    """doc_id, print (hash of the text), label, first_word, n_span, coverage per notice found."""
    grams = docs.select(
        "doc_id",
        F.xxhash64("text").alias("print"),
        _words(_normal(F.col("text"))).alias("words"),
    ).select("doc_id", "print", F.posexplode(_rolling(F.col("words"), GRAM)).alias("pos", "gram"))
    votes = grams.join(F.broadcast(notice_grams(docs.sparkSession)), "gram").withColumn(
        "offset", F.col("pos") - F.col("at")
    )
    diagonals = votes.groupBy("doc_id", "print", "notice", "label", "n_grams", "offset").agg(
        F.collect_set("at").alias("places")
    )
    near = (
        Window.partitionBy("doc_id", "print", "notice")
        .orderBy("offset")
        .rangeBetween(-DRIFT, DRIFT)
    )
    enough = F.ceil(F.lit(COVERAGE) * F.col("n_grams") - 1e-9)
    spans = (
        diagonals.withColumn("n_votes", F.sum(F.size("places")).over(near))
        .withColumn("votes", F.collect_list(F.struct("offset", "places")).over(near))
        .where(F.col("n_votes") >= enough)
    )
    verified = spans.withColumn("found", _in_order(F.col("votes"), F.col("offset"))).where(
        F.col("found.n") >= enough
    )
    best = verified.groupBy("doc_id", "print", "notice", "label", "n_grams").agg(
        F.max(F.struct("found.n", (-F.col("offset")).alias("left"), "found.first", "found.last"))
        .alias("best")
    )
    return best.select(
        "doc_id",
        "print",
        "label",
        F.col("best.first").alias("first_word"),
        (F.col("best.last") + GRAM - F.col("best.first")).alias("n_span"),
        (F.col("best.n") / F.col("n_grams")).alias("coverage"),
    )


def _in_order(votes: Column, centre: Column) -> Column:
    """n, first, last: notice positions of a span that stand in order, and their places.

    Of several votes for a notice position the one nearest to the centre counts.
    """
    every = F.flatten(
        F.transform(
            votes,
            lambda v: F.transform(
                v["places"],
                lambda at: F.struct(
                    at.alias("at"),
                    F.abs(v["offset"] - centre).alias("far"),
                    v["offset"].alias("offset"),
                ),
            ),
        )
    )

    def kept(n: Column, at: Column, first: Column, last: Column) -> Column:
        return F.struct(n.alias("n"), at.alias("at"), first.alias("first"), last.alias("last"))

    def step(so_far: Column, vote: Column) -> Column:
        place = vote["offset"] + vote["at"]
        again = vote["at"] == so_far["at"]
        behind = (so_far["n"] > 0) & (place <= so_far["last"])
        first = F.when(so_far["n"] == 0, place).otherwise(so_far["first"])
        skipped = kept(so_far["n"], vote["at"], so_far["first"], so_far["last"])
        return F.when(again | behind, skipped).otherwise(
            kept(so_far["n"] + 1, vote["at"], first, place)
        )

    nothing = kept(*(F.lit(x) for x in (0, -1, 0, 0)))
    return F.aggregate(F.array_sort(every), nothing, step)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(padded: Column) -> dict[str, Column]:
    """Per phrase its number of places; the first and the last of all places."""
    counts, firsts, lasts = {}, [], []
    for phrase in PHRASES:
        first, _, rest = phrase.partition(" ")
        written = f" {phrase} "
        there = F.instr(padded, written)
        pattern = f" {re.escape(first)}(?= {re.escape(rest)} )"
        counts[phrase] = F.when(there > 0, F.regexp_count(padded, F.lit(pattern))).otherwise(0)
        firsts.append(F.when(there > 0, _spaces(F.substring(padded, F.lit(1), there)) - 1))
        behind = F.instr(F.reverse(padded), written[::-1])
        start = F.length(padded) - behind - len(written) + 2
        lasts.append(F.when(there > 0, _spaces(F.substring(padded, F.lit(1), start)) - 1))
    return counts | {"first": F.least(*firsts), "last": F.greatest(*lasts)}


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    A NULL text counts as empty: no words, NULL positions, empty label lists, score 0.
    The score is 1 with a base phrase, else the best share of a notice that was found.
    Repeated rows get equal answers, each its own row; a NULL doc_id is kept. An empty
    table gives an empty one; other columns are ignored.
    """
    prepare(docs.sparkSession)
    phrases = list(PHRASES)
    base = docs.select(
        "doc_id",
        F.xxhash64("text").alias("print"),
        _normal(F.col("text")).alias("normal"),
    ).select("doc_id", "print", "normal", F.concat(F.lit(" "), "normal", F.lit(" ")).alias("padded"))
    found = _places(F.col("padded"))
    base = base.select(
        "doc_id",
        "print",
        F.when(F.col("normal") == "", 0).otherwise(_spaces(F.col("normal")) + 1).alias("n_words"),
        *[found[p].alias(f"n{i}") for i, p in enumerate(phrases)],
        found["first"].alias("first_word"),
        found["last"].alias("last_word"),
    )
    by_doc = (
        notice_spans(docs)
        .groupBy("doc_id", "print")
        .agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"))
        .select(F.col("doc_id").alias("id"), F.col("print").alias("of"), "more", "coverage")
    )
    n_base = reduce(Column.__add__, (F.col(f"n{i}") for i in range(len(phrases))))
    base_labels = F.array_compact(
        F.array(*[F.when(F.col(f"n{i}") > 0, PHRASES[p]) for i, p in enumerate(phrases)])
    )
    no_labels = F.array().cast("array<string>")
    return (
        base.join(by_doc, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("of")), "left")
        .withColumn("base", base_labels)
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            n_base.cast("long").alias("n_base"),
            F.col("first_word").cast("long").alias("first_word"),
            F.col("last_word").cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.array_union("base", F.coalesce("more", no_labels))), ","
            ).alias("labels"),
            F.when(F.size("base") > 0, 1.0)
            .otherwise(F.coalesce("coverage", F.lit(0.0)))
            .alias("score"),
        )
    )
