"""Text quality by positive-unlabelled learning.

Only trusted good documents and documents without a label are learned from. A logistic
model over shares of word shapes and a few measures of repetition minimises the
non-negative unbiased risk

    prior * E_good[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_good[loss(-)])

whose second part stands for the risk on bad documents, none of which is seen as such.
With the logistic loss this is the greater of two convex functions of the weights:
without the second part, and without the max, where it is linear in the good documents.
So it has one minimum, which Newton's method finds: that of the second function if its
second part is not negative there, else the point on the way between the two at which
the second part is zero.

Sums over unlabelled documents are Spark aggregates over all of them, for every step;
trusted good documents are a bounded sample. The prior, the share of good documents
among the unlabelled, is estimated from a first model that tells the two samples apart:
where only good documents are, the density ratio of good to unlabelled documents is
1 / prior.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseweave.llm.common import Columns, map_columns, materialise, prepare
from caseweave.llm.memo import Memo
from caseweave.llm.samples import fold, labelled

# Bound of the fit: trusted good documents.
POSITIVES = 8000

FOLDS, HELD_OUT_FOLD = 4, 2
PREDICT_AT = 0.7
SHAPES = 256
MEASURES = 12
# Weight decay of the model and of the one that estimates the prior. It does not depend on
# the number of documents, nor do verdicts, but for what the sample itself changes.
DECAY, DECAY_PRIOR = 0.15, 0.005
# A fit ends when no part of the gradient is larger than this.
GRADIENT = 1e-6
MOST_STEPS = 40
# Tolerance of the second part of the risk where it has to be zero, and halvings for it.
ZERO_RISK, HALVINGS = 1e-3, 12
PRIOR_RANGE = (0.05, 0.98)
# Tasks that add up what all tasks found; each adds one found table at a time.
ADDERS = 8

_RUN = re.compile(r"(.)\1+")


@dataclass(frozen=True)
class QualityModel:
    """Centre, spread and weights of the features; the last weight is the offset."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        scaled = (features - self.centre) / self.spread
        odds = np.clip(scaled @ self.weights[:-1] + self.weights[-1], -60, 60)
        return 1 / (1 + np.exp(-odds))


def _shape(word: str) -> int:
    """Bucket of a word's shape: letters, capitals and digits as classes, other signs
    as they are, runs of one class as one."""
    classes = "".join(
        ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c for c in word
    )
    return zlib.crc32(_RUN.sub(r"\1", classes).encode("utf-8", "replace")) % SHAPES


class FeatureReader:
    """Features of whole texts; shapes of frequent words are kept."""

    def __init__(self) -> None:
        self._known = Memo(200_000)

    def _bucket(self, word: str) -> int:
        bucket = self._known.get(word)
        if bucket is None:
            bucket = _shape(word)
            self._known.put(word, bucket)
        return bucket

    def read(self, text: str) -> np.ndarray:
        found = np.zeros(MEASURES + SHAPES, dtype=np.float32)
        words = text.split()
        if not words:
            return found
        n = len(words)
        counts = Counter(words)
        for word, times in counts.items():
            found[MEASURES + self._bucket(word)] += times
        found[MEASURES:] = np.sqrt(found[MEASURES:] / n)
        lines = [line for line in text.split("\n") if line and not line.isspace()]
        letters = sum(map(len, words))
        repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
        pairs = len(set(zip(words, words[1:], words[2:], strict=False)))
        raw = text.encode("utf-8", "replace")
        found[:MEASURES] = (
            1.0,
            np.log1p(n) / 8,
            len(counts) / n,
            np.log(len(counts)) / np.log(n) if n > 1 else 1.0,
            repeats / n,
            pairs / max(n - 2, 1),
            counts.most_common(1)[0][1] / n,
            letters / n / 10,
            1 - len(set(lines)) / len(lines),
            np.log1p(n / len(lines)) / 6,
            min(len(zlib.compress(raw, 1)) / len(raw), 1.0),
            min(n, 20) / 20,
        )
        return found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT_FOLD, F.lit(False))


FEATURES = MEASURES + SHAPES


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id, features per row, computed once in the shared folder."""

    def start() -> Callable[[Columns], Columns]:
        reader = FeatureReader()
        return lambda batch: {
            "doc_id": batch["doc_id"],
            "features": [reader.read(t) for t in batch["text"]],
        }

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialise(map_columns(rows, start, "doc_id long, features array<float>"), "features")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy().reshape(-1, FEATURES)


def _added(features: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part`` (an array of ``size`` numbers) over all batches of rows.

    Every task hands on one array; a few tasks add these one by one, and the driver adds
    their sums, so no place holds more than a few arrays at a time.
    """
    schema = to_arrow_schema(StructType.fromDDL("sums binary"))

    def row(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"sums": [total.tobytes()]}, schema=schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch))
        yield row(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column("sums").to_pylist():
                total += np.frombuffer(raw)
        yield row(total)

    found = features.select("features").mapInArrow(first, "sums binary")
    found = found.repartition(ADDERS).mapInArrow(again, "sums binary")
    return sum((np.frombuffer(r["sums"]) for r in found.collect()), np.zeros(size))


def _sigmoid(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def _with_one(rows: np.ndarray) -> np.ndarray:
    return np.hstack([rows, np.ones((len(rows), 1), dtype=rows.dtype)])


def soft_losses(rows: np.ndarray, weights: np.ndarray, sign: int) -> np.ndarray:
    """Sums of loss(-) (sign 1) or loss(+) (sign -1) of rows with their one, of its
    gradient and of its second derivatives, in one array."""
    odds = sign * (rows @ weights)
    yes = _sigmoid(odds)
    second = (rows.T * (yes * (1 - yes)).astype(rows.dtype)) @ rows
    return np.concatenate(
        ([np.logaddexp(0, odds).sum()], sign * (yes @ rows), second.ravel().astype(np.float64))
    )


# Means of the three over all unlabelled documents, at given weights.
Losses = Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]]


def _split(sums: np.ndarray, n: int) -> tuple[float, np.ndarray, np.ndarray]:
    size = int(np.sqrt(len(sums)))  # 1 + size + size ** 2 numbers
    return sums[0] / n, sums[1 : 1 + size] / n, sums[1 + size :].reshape(size, size) / n


def losses_of(rows: np.ndarray, sign: int = 1) -> Losses:
    """Means over rows that are at hand."""
    return lambda weights: _split(soft_losses(rows, weights, sign), len(rows))


def losses_over(features: DataFrame, n: int, centre: np.ndarray, spread: np.ndarray) -> Losses:
    """Means over a table of n rows."""

    def means(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def part(rows: np.ndarray) -> np.ndarray:
            scaled = _with_one(((rows - centre) / spread).astype(np.float32))
            return soft_losses(scaled, weights, 1)

        size = FEATURES + 1
        return _split(_added(features, part, 1 + size + size * size), n)

    return means


def minimise(
    terms: list[tuple[float, Losses]], linear: np.ndarray, decay: float, start: np.ndarray
) -> np.ndarray:
    """Weights at the minimum of a weighted sum of losses, a linear part and the decay.

    Newton steps, halved while they lead upwards. The last weight, the offset, decays
    hardly at all."""
    shrink = np.full(len(start), decay)
    shrink[-1] = 1e-6

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        value = linear @ weights + 0.5 * shrink @ weights**2
        slope, second = linear + shrink * weights, np.diag(shrink)
        for share, losses in terms:
            loss, gradient, curves = losses(weights)
            value += share * loss
            slope = slope + share * gradient
            second = second + share * curves
        return value, slope, second

    weights = start
    value, slope, second = at(weights)
    for _ in range(MOST_STEPS):
        if np.abs(slope).max() <= GRADIENT:
            break
        step = np.linalg.solve(second, slope)
        for _ in range(MOST_STEPS):
            found = at(weights - step)
            if found[0] <= value + 1e-9:
                break
            step = step / 2
        weights = weights - step
        value, slope, second = found
    return weights


def least_risk(good: np.ndarray, other: Losses, prior: float, decay: float = DECAY) -> np.ndarray:
    """Weights of the least non-negative risk; ``good`` are rows with their one."""
    towards = -prior * good.mean(axis=0)
    on_good, on_others = losses_of(good, -1), losses_of(good, 1)

    def between(share: float, start: np.ndarray) -> np.ndarray:
        """The minimum between the function without the second part (0) and with it (1)."""
        terms = [(share, other), ((1 - share) * prior, on_good)]
        return minimise(terms, share * towards, decay, start)

    def bad_part(weights: np.ndarray) -> float:
        return other(weights)[0] - prior * on_others(weights)[0]

    weights = between(1.0, np.zeros(good.shape[1]))
    if bad_part(weights) >= 0:
        return weights
    low, high = 1.0, 1.0
    for _ in range(HALVINGS):  # a share at which the part is not negative
        low = low / 8
        weights = between(low, weights)
        part = bad_part(weights)
        if part >= 0:
            break
        high = low
    for _ in range(HALVINGS):
        if abs(part) <= ZERO_RISK:
            break
        share = np.sqrt(low * high)
        weights = between(share, weights)
        part = bad_part(weights)
        low, high = (low, share) if part < 0 else (share, high)
    return weights


def _without(losses: Losses, n: int, rows: np.ndarray) -> Losses:
    """Means over n rows without some of them, which are at hand."""
    some = losses_of(rows)

    def means(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        pairs = zip(losses(weights), some(weights), strict=True)
        return tuple((n * a - len(rows) * b) / (n - len(rows)) for a, b in pairs)

    return means


def estimate_prior(good: np.ndarray, other: Losses, n: int) -> float:
    """Share of good documents among the n others, by the density ratio at good documents.

    Weights are fitted on one half of the good documents and read on the other half, which
    is left out of the others meanwhile: a model that saw it among them would know it.
    Rows have their one."""
    half = len(good) // 2
    if half < 10 or n <= len(good):
        return 0.5
    fitted, read = good[:half], good[half:]
    terms = [(1.0, losses_of(fitted, -1)), (1.0, _without(other, n, read))]
    nothing = np.zeros(good.shape[1])
    weights = minimise(terms, nothing, DECAY_PRIOR, nothing)
    ratio = float(np.median(np.exp(np.clip(read @ weights, -30, 30))))
    share = min(1 / max(ratio, 1e-9), 1.0)
    whole = (share * (n - len(read)) + len(read)) / n
    return float(np.clip(whole, *PRIOR_RANGE))


def fit(features: DataFrame, labels: DataFrame) -> QualityModel | None:
    """The model from rows outside the held-out fold; None without good or other documents.

    The driver holds the features of at most about POSITIVES documents. Labels of bad
    documents are not read.
    """
    seen = ~held_out(F.col("doc_id"))
    trusted = labelled(
        features, labels, "quality", POSITIVES, seen & (F.col("quality") == 1), content="features"
    )
    rows = trusted.orderBy("doc_id").select("features").toArrow()
    good = np.array(rows["features"].to_pylist(), dtype=np.float64).reshape(-1, FEATURES)
    others = features.where(seen)
    sums = _added(
        others,
        lambda x: np.concatenate(
            ([len(x)], x.sum(axis=0, dtype=np.float64), (x.astype(np.float64) ** 2).sum(axis=0))
        ),
        1 + 2 * FEATURES,
    )
    n = int(sums[0])
    if not len(good) or not n:
        return None
    centre = sums[1 : 1 + FEATURES] / n
    spread = np.sqrt(np.maximum(sums[1 + FEATURES :] / n - centre**2, 0)) + 0.05
    good = _with_one((good - centre) / spread)
    other = losses_over(others, n, centre, spread)
    prior = estimate_prior(good, other, n)
    return QualityModel(centre, spread, least_risk(good, other, prior), prior)


def _scored(features: DataFrame, model: QualityModel | None) -> DataFrame:
    schema = "doc_id long, score double"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            scores = np.zeros(n) if model is None else model.probabilities(_matrix(batch))
            columns = {"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns, schema=target)

    return features.mapInArrow(run, schema).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )


def score_quality(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id, held_out, score, predicted per row. A NULL text counts as empty; it has
    the score of a text without words. Without a model every score is 0."""
    prepare(docs.sparkSession)
    return _scored(feature_table(docs), model)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Texts are read once."""
    prepare(docs.sparkSession)
    features = feature_table(docs)
    return _scored(features, fit(features, labels))
