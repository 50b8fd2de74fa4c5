"""Toxic passages by maximum-scoring segments.

Learning. Words and word beginnings are counted in a bounded sample of toxic and clean
documents. Their log-odds are smoothed by a Dirichlet prior in proportion to their
count in both classes together; significant ones are kept, all other words share the
log-odds of not being one of them, which is below zero.

Scoring. One linear scan finds all maximal-scoring segments of a document. Among n
words of clean text, K * n * exp(-lam * s) segments of score s or more are expected
(extreme-value law), with lam and K from clean documents. Segments that are expected
less than EXPECTED times are the toxic passages; what they exceed chance by is added
up and turned into a probability on a second, separate part of the sample.

The sample is bounded per class, so its classes do not have their true shares. These
are counted over all labels, and both classes weigh by them in the prior and in the
probability: scores and verdicts do not depend on how much of a class is sampled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import exp, log, log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import Columns, filter_texts, map_columns, materialise, prepare, texts
from caseweave.llm.memo import Memo
from caseweave.llm.samples import fold, labelled

# Bound of the fit: labelled documents per class.
SAMPLE_PER_CLASS = 8000

FOLDS, HELD_OUT_FOLD = 5, 0
PRIOR_WORDS, LEAST_PRIOR = 1000.0, 0.3
MIN_Z = 3.0
MIN_LOG_ODDS = 1.5
MIN_DOCUMENTS = 5
MIN_BACKING = 4
BEGINNINGS = range(3, 9)
EXPECTED = 0.1
PREDICT_AT = 0.5

_LETTERS = r"\p{L}+"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicModel:
    """Scores of words and beginnings ("abc*"), and the constants of the calibration."""

    scores: dict[str, float]
    other: float
    lam: float
    k: float
    offset: float
    slope: float

    def word_score(self, word: str) -> float:
        """The score of the word itself, else of its longest known beginning."""
        known = self.scores.get(word)
        if known is not None:
            return known
        for size in reversed(BEGINNINGS):
            if len(word) >= size:
                known = self.scores.get(word[:size] + "*")
                if known is not None:
                    return known
        return self.other

    def probability(self, evidence: float) -> float:
        odds = self.offset + self.slope * evidence
        return 1 / (1 + exp(-max(-700.0, min(700.0, odds))))


def maximal_segments(scores: Sequence[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of (position, score) runs: (first, last, score).

    Every positive run opens a candidate; it joins the nearest earlier one that began
    from a lower cumulative sum if its own end is higher than that one's end, and so
    on. Each candidate is opened and joined once, so the scan is linear.
    """
    total = 0.0
    found: list[list[float]] = []  # first, last, sum before, sum at the end, nearest lower
    for position, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        first, last = position, position
        lower = len(found) - 1
        while True:
            while lower >= 0 and found[lower][2] >= before:
                lower = int(found[lower][4])
            if lower < 0 or found[lower][3] >= total:
                break
            first, before = found[lower][0], found[lower][2]
            del found[lower:]
            lower = len(found) - 1
        found.append([first, last, before, total, lower])
    return [(int(f), int(l), end - start) for f, l, start, end, _ in found]


class ToxicScorer:
    """Applies a model to texts; the scores of frequent words are kept."""

    def __init__(self, model: ToxicModel) -> None:
        self.model = model
        self._known = Memo(300_000)

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words and the maximal segments by word positions."""
        model, get, put = self.model, self._known.get, self._known.put
        runs: list[tuple[int, float]] = []
        n, quiet = 0, 0
        for word in _WORD.findall(text.lower()):
            score = get(word)
            if score is None:
                score = model.word_score(word)
                put(word, score)
            if score > 0:
                if quiet:
                    runs.append((n - 1, quiet * model.other))
                    quiet = 0
                runs.append((n, score))
            else:
                quiet += 1
            n += 1
        return n, maximal_segments(runs) if runs else []

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], float]:
        """Significant passages and the document's evidence."""
        n, segments = self.segments(text)
        model = self.model
        found, evidence = [], 0.0
        for first, last, score in segments:
            beyond = model.lam * score - log(model.k * max(n, 1))
            if beyond > -log(EXPECTED):
                found.append((first, last, score))
                evidence += beyond
        return found, log1p(evidence)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT_FOLD, F.lit(False))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """feature, toxic, clean: documents of each class that hold it. Documents are counted,
    not places, so that a word which one document repeats weighs no more than another."""
    words = sample.select(
        "doc_id",
        "label",
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_LETTERS), F.lit(0))).alias("word"),
    )
    beginnings = F.array_compact(
        F.array(
            *[
                F.when(F.length("word") >= size, F.concat(F.substring("word", 1, size), F.lit("*")))
                for size in BEGINNINGS
            ]
        )
    )
    one = F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    words = words.distinct()
    by_word = words.groupBy(F.col("word").alias("feature")).agg(*one)
    by_beginning = (
        words.select("doc_id", "label", F.explode(beginnings).alias("feature"))
        .distinct()
        .groupBy("feature")
        .agg(*one)
    )
    # a beginning speaks for words that are not known, so several words must back it
    backed = (
        by_word.where("toxic > 0")
        .withColumnRenamed("feature", "word")
        .select(F.explode(beginnings).alias("feature"))
        .groupBy("feature")
        .count()
        .where(F.col("count") >= MIN_BACKING)
        .select("feature")
    )
    return by_word.unionByName(by_beginning.join(backed, "feature", "left_semi"))


def class_weights(docs: dict[int, float], sampled: dict[int, int]) -> dict[int, float]:
    """What one sampled text of each class weighs, so that the classes together have the
    shares of their documents; all texts together weigh as much as they are."""
    scale = sum(sampled.values()) / sum(docs.values())
    return {y: scale * docs[y] / sampled[y] for y in sampled}


def _log_odds(
    counts: DataFrame, n_toxic: int, n_clean: int, weights: dict[int, float]
) -> DataFrame:
    """feature, score, z of all significant features."""
    a, b = F.col("toxic"), F.col("clean")
    both = weights[1] * n_toxic + weights[0] * n_clean
    prior = LEAST_PRIOR + PRIOR_WORDS * (weights[1] * a + weights[0] * b) / both
    score = F.log((a + prior) / (n_toxic + PRIOR_WORDS - a - prior)) - F.log(
        (b + prior) / (n_clean + PRIOR_WORDS - b - prior)
    )
    z = score / F.sqrt(1 / (a + prior) + 1 / (b + prior))
    return (
        counts.where(a >= MIN_DOCUMENTS)
        .select("feature", score.alias("score"), z.alias("z"))
        .where((F.col("z") >= MIN_Z) & (F.col("score") >= MIN_LOG_ODDS))
    )


def _law(tokens: dict[float, int]) -> float:
    """lam > 0 with sum of p * exp(lam * score) = 1 over the words of clean text."""
    total = sum(tokens.values())

    def excess(lam: float) -> float:
        return sum(n * exp(min(lam * s, 700.0)) for s, n in tokens.items()) / total - 1

    low, high = 1e-3, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return (low + high) / 2


def logistic_line(points: Sequence[tuple[float, int, float]]) -> tuple[float, float]:
    """Offset and slope of P(label) over x by Newton steps; points: (x, label, weight).
    A weak prior keeps the slope finite where the classes are apart. A step is halved
    until the likelihood rises: whole steps can run away where classes are unequal."""

    def likelihood(offset: float, slope: float) -> float:
        total = -0.05 * (offset**2 + (slope - 1.0) ** 2)
        for x, label, weight in points:
            odds = offset + slope * x
            total += weight * (label * odds - max(odds, 0.0) - log1p(exp(-abs(odds))))
        return total

    offset, slope = 0.0, 1.0
    reached = likelihood(offset, slope)
    for _ in range(60):
        g0, g1, h00, h01, h11 = -0.1 * offset, -0.1 * (slope - 1.0), 0.1, 0.0, 0.1
        for x, label, weight in points:
            p = 1 / (1 + exp(-max(-60.0, min(60.0, offset + slope * x))))
            g0 += weight * (label - p)
            g1 += weight * (label - p) * x
            h00 += weight * p * (1 - p)
            h01 += weight * p * (1 - p) * x
            h11 += weight * p * (1 - p) * x * x
        determinant = h00 * h11 - h01 * h01
        d0 = (h11 * g0 - h01 * g1) / determinant
        d1 = (h00 * g1 - h01 * g0) / determinant
        rises = False
        for _ in range(40):
            found = likelihood(offset + d0, slope + d1)
            rises = found > reached
            if rises:
                break
            d0, d1 = d0 / 2, d1 / 2
        if not rises:
            break
        offset, slope, reached = offset + d0, slope + d1, found
        if abs(d0) + abs(d1) < 1e-9:
            break
    return offset, slope


def _scan(sample: DataFrame, model: ToxicModel) -> DataFrame:
    """label, n words, best segment, evidence of each document of a sample."""

    def start() -> Callable[[Columns], Columns]:
        scorer = ToxicScorer(model)

        def run(batch: Columns) -> Columns:
            seen = [scorer.segments(text) for text in batch["text"]]
            return {
                "label": batch["label"],
                "n": [n for n, _ in seen],
                "best": [max((s for _, _, s in found), default=0.0) for _, found in seen],
                "evidence": [scorer.passages(text)[1] for text in batch["text"]],
            }

        return run

    return map_columns(
        sample.select("label", "text"), start, "label int, n long, best double, evidence double"
    )


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel | None:
    """The model from labels outside the held-out fold; None without both classes.

    What reaches the driver is bounded by the sample of at most about
    2 * SAMPLE_PER_CLASS documents: its significant features and one row per document.
    """
    prepare(docs.sparkSession)
    known = ~held_out(F.col("doc_id"))
    # each text once, and in the same part whichever of its documents are sampled
    sample = (
        labelled(docs, labels, "toxic", SAMPLE_PER_CLASS, known)
        .groupBy("text")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.max("label").alias("label"),
            F.sum("stands_for").alias("stands_for"),
        )
    )
    sample = materialise(sample, "toxic-sample")
    part = F.pmod(F.xxhash64("text"), F.lit(2))
    learning, calibration = sample.where(part == 0), sample.where(part == 1)
    sampled = sample.groupBy("label").agg(
        F.sum("stands_for").alias("docs"),
        F.count(F.when(part == 0, 1)).alias("learning"),
        F.count(F.when(part == 1, 1)).alias("calibration"),
    )
    by_class = {r["label"]: r for r in sampled.collect()}
    if len(by_class) < 2 or not all(r["learning"] for r in by_class.values()):
        return None
    class_docs = {y: r["docs"] for y, r in by_class.items()}
    weights = class_weights(class_docs, {y: r["learning"] for y, r in by_class.items()})
    counts = materialise(_feature_counts(learning), "features")
    totals = counts.where(~F.col("feature").endswith("*")).agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    n_toxic, n_clean = totals.first()
    if not n_toxic or not n_clean:
        return None
    kept = {r["feature"]: r["score"] for r in _log_odds(counts, n_toxic, n_clean, weights).collect()}
    if not kept:
        return None
    model = ToxicModel(kept, -1.0, 1.0, 1.0, 0.0, 1.0)

    # share of words that are none of the features, in either class; their scores in clean text
    words = counts.where(~F.col("feature").endswith("*"))

    def start() -> Callable[[Columns], Columns]:
        def run(batch: Columns) -> Columns:
            return {
                "score": [model.word_score(w) for w in batch["feature"]],
                "toxic": batch["toxic"],
                "clean": batch["clean"],
            }

        return run

    by_score = (
        map_columns(words, start, "score double, toxic long, clean long")
        .groupBy("score")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .collect()
    )
    hit_toxic = sum(r["toxic"] for r in by_score if r["score"] > 0)
    hit_clean = sum(r["clean"] for r in by_score if r["score"] > 0)
    other = log((1 - hit_toxic / n_toxic) / (1 - hit_clean / n_clean)) if hit_toxic < n_toxic else -1.0
    other = min(other, -0.001)
    tokens = {(r["score"] if r["score"] > 0 else other): 0 for r in by_score}
    for r in by_score:
        tokens[r["score"] if r["score"] > 0 else other] += r["clean"]
    lam = min(_law(tokens), 1.0)
    model = ToxicModel(kept, other, lam, 1.0, 0.0, 1.0)
    law = _scan(learning.where("label = 0"), model).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.col("n") * F.exp(-lam * F.col("best"))).alias("sum"),
    )
    n_docs, expected = law.first()
    k = n_docs / expected if expected else 1.0
    model = ToxicModel(kept, other, lam, k, 0.0, 1.0)
    if not all(r["calibration"] for r in by_class.values()):
        return model
    weights = class_weights(class_docs, {y: r["calibration"] for y, r in by_class.items()})
    points = [
        (r["evidence"], r["label"], weights[r["label"]] * r["n"])
        for r in _scan(calibration, model).groupBy("evidence", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    ]
    offset, slope = logistic_line(points)
    return ToxicModel(kept, other, lam, k, offset, slope)


def score_toxicity(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages per row.

    A NULL or empty text has no passage and the score of no evidence; without a model
    (no labels of one class) every score is 0. Each row of repeated ids is scored.
    """

    def start() -> Callable[[Columns], Columns]:
        scorer = ToxicScorer(model) if model else None

        def run(batch: Columns) -> Columns:
            seen = [scorer.passages(t) if scorer else ([], 0.0) for t in batch["text"]]
            return {
                "doc_id": batch["doc_id"],
                "score": [model.probability(e) if model else 0.0 for _, e in seen],
                "n_passages": [len(passages) for passages, _ in seen],
            }

        return run

    scored = map_columns(texts(docs), start, "doc_id long, score double, n_passages long")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
        "n_passages",
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_passages."""
    return score_toxicity(docs, fit(docs, labels))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, whole and with their columns."""
    model = fit(docs, labels)

    def start() -> Callable[[str], bool]:
        if model is None:
            return lambda text: True
        scorer = ToxicScorer(model)
        return lambda text: model.probability(scorer.passages(text)[1]) < PREDICT_AT

    return filter_texts(docs, start)
