"""Quality rules under weak supervision, with DataFrame functions only.

Rules vote for a document (1), against it (-1) or abstain (0). How often each rule
votes either way on good and on bad documents is not given but estimated from all
documents by expectation-maximisation, and a document is kept by its posterior
probability of being good. Documents enter the estimate as counts of vote patterns:
there are at most 3 ** len(RULES) of them, whatever the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import WHITE_SPACE, WHITE_SPACE_CLASS, WORD, materialise, prepare

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.5
EM_ROUNDS = 200
EM_TOLERANCE = 1e-9

SYMBOLS = "[#*$%&|<>]"

# Start of the estimate: share of good documents; how often a rule votes against a
# good document, against one with the rule's own defect, and with another defect.
GOOD_SHARE = 0.85
HIT_GOOD, HIT_OWN, HIT_OTHER = 0.005, 0.9, 0.05
PRIOR_WEIGHT = 0.1


def _pairwise(hashes: str, shift: int) -> Column:
    """Hash of element i of a column with element i + shift, as long as both exist."""
    n = F.greatest(F.size(hashes) - shift, F.lit(0))
    return F.zip_with(
        F.slice(hashes, 1, n), F.slice(hashes, shift + 1, n), lambda a, b: F.xxhash64(a, b)
    )


def _matched(text: str, letters: str) -> Column:
    """Number of characters of a class; a scan that copies little where few match."""
    return (F.length(text) - F.length(F.regexp_replace(text, letters + "+", ""))).cast("long")


def _covered(ordered: Column) -> Column:
    """Words covered by windows that occur twice; ordered: sorted (hash, position)."""
    n = F.size(ordered)
    equal = F.zip_with(
        F.slice(ordered, 1, n - 1), F.slice(ordered, 2, n - 1), lambda a, b: a["h"] == b["h"]
    )
    no = F.array(F.lit(False))
    twice = F.zip_with(F.concat(no, equal), F.concat(equal, no), lambda a, b: a | b)
    return F.sort_array(
        F.array_compact(F.zip_with(ordered, twice, lambda x, t: F.when(t, x["i"])))
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def measures(docs: DataFrame) -> DataFrame:
    """The documents with what the rules look at: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and n_lines, n_capitals, n_marks, n_distinct.

    A NULL text has no words: all are 0. Every step that the next one uses more than
    once is a projection of its own, so that it is computed once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        text.alias("text"), F.btrim(text, F.lit(WHITE_SPACE)).alias("trimmed"), *_others(docs)
    )
    others = [c for c in read.columns if c.startswith(_KEPT)]
    split = F.split("trimmed", WHITE_SPACE_CLASS + "+")
    read = read.select(
        *others,
        F.when(F.col("trimmed") == "", F.array().cast("array<bigint>"))
        .otherwise(F.transform(split, lambda w: F.xxhash64(w)))
        .alias("words"),
        F.filter(
            F.split("text", "\n"), lambda line: line.rlike(WORD)
        ).alias("lines"),
        (F.length("text") - _matched("text", WHITE_SPACE_CLASS)).cast("long").alias("word_chars"),
        _matched("text", SYMBOLS).alias("n_symbols"),
        _matched("text", "[A-Z]").alias("n_capitals"),
        _matched("text", "[!?]").alias("n_marks"),
    )
    kept = [*others, "word_chars", "n_symbols", "n_capitals", "n_marks"]
    counted = read.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _pairwise("words", 1).alias("windows"),
    )
    kept += ["n_words", "n_distinct", "n_lines", "n_dup_lines"]
    windows = counted
    for width in (2, 4):  # doubles the window up to WINDOW_WORDS
        windows = windows.select(*kept, _pairwise("windows", width).alias("windows"))
    ordered = windows.select(
        *kept,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("ordered"),
    )
    at = ordered.select(
        *kept, F.when(F.col("ordered").isNotNull(), _covered(F.col("ordered"))).alias("at")
    )
    n = F.size("at")
    gaps = F.zip_with(
        F.slice("at", 1, n - 1),
        F.slice("at", 2, n - 1),
        lambda a, b: F.least(b - a, F.lit(WINDOW_WORDS)),
    )
    repeated = F.when(F.col("at").isNull(), 0).otherwise(_sum(gaps) + WINDOW_WORDS)
    return at.select(*kept, repeated.cast("long").alias("n_repeat_words"))


# Columns of the input are carried under this prefix, so that no name clashes.
_KEPT = "kept__"


def _others(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`").alias(_KEPT + c) for c in docs.columns]


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return few | repeats


def _vote(value: Column, good: Column, bad: Column) -> Column:
    """NULL values (nothing to measure) abstain."""
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def _ratio(part: str, whole: str, least: int = 1) -> Column:
    return F.when(F.col(whole) >= least, F.col(part) / F.col(whole))


def rules() -> dict[str, Column]:
    """Each rule's vote; limits are shares of words, letters or lines."""
    words = F.col("n_words")
    length = _ratio("word_chars", "n_words")
    symbols = _ratio("n_symbols", "n_words")
    repeats = _ratio("n_repeat_words", "n_words")
    lines = _ratio("n_dup_lines", "n_lines", 2)
    capitals = _ratio("n_capitals", "word_chars", 20)
    marks = _ratio("n_marks", "n_words")
    variety = _ratio("n_distinct", "n_words", 40)
    return {
        "enough_words": _vote(words, words >= 50, words < MIN_WORDS),
        "word_length": _vote(length, length.between(3, 9), (length < 2.5) | (length > 14)),
        "few_symbols": _vote(symbols, symbols < 0.1, symbols > 0.4),
        "few_repeats": _vote(repeats, repeats < 0.1, repeats > 0.3),
        "few_equal_lines": _vote(lines, lines < 0.1, lines > 0.5),
        "few_capitals": _vote(capitals, capitals < 0.2, capitals > 0.5),
        "few_marks": _vote(marks, marks < 0.1, marks > 0.4),
        "varied_words": _vote(variety, variety > 0.3, variety < 0.12),
    }


def pattern(votes: dict[str, Column]) -> Column:
    """All votes as one number, three values per rule."""
    code = F.lit(0)
    for vote in votes.values():
        code = code * 3 + vote + 1
    return code.cast("int")


def _votes(code: int, n_rules: int) -> list[int]:
    found = []
    for _ in range(n_rules):
        code, vote = divmod(code, 3)
        found.append(vote - 1)
    return found[::-1]


def _start(n_rules: int) -> tuple[list[float], list[list[float]]]:
    """Shares of the classes, and how often each rule votes against each class."""
    shares = [GOOD_SHARE] + [(1 - GOOD_SHARE) / n_rules] * n_rules
    own = [[HIT_OWN if i == j else HIT_OTHER for j in range(n_rules)] for i in range(n_rules)]
    return shares, [[HIT_GOOD] * n_rules, *own]


def estimate(counts: dict[int, int], n_rules: int) -> dict[int, float]:
    """Posterior probability of good per vote pattern, by expectation-maximisation.

    Documents are good or bad for one of n_rules reasons, the defect that one rule is
    made for; a bad document passes most of the other rules. Given the class, rules
    vote independently, and one that abstains tells nothing. What is estimated is the
    share of each class and the rate at which each rule votes against it, which is the
    rule's accuracy there. Rates and shares have priors at their start values that
    weigh PRIOR_WEIGHT of the corpus, so the classes keep their meaning at any size.
    """
    if not counts:
        return {}
    votes = {code: _votes(code, n_rules) for code in counts}
    shares, rates = _start(n_rules)
    first_rates = rates
    prior = [PRIOR_WEIGHT * sum(counts.values()) * share for share in shares]
    for _ in range(EM_ROUNDS):
        mass = prior[:]
        hits = [[p * r for r in row] for p, row in zip(prior, first_rates, strict=True)]
        cast = [[p] * n_rules for p in prior]
        for code, n in counts.items():
            for k, weight in enumerate(_posterior(votes[code], shares, rates)):
                mass[k] += n * weight
                for rule, vote in enumerate(votes[code]):
                    if vote:
                        cast[k][rule] += n * weight
                        hits[k][rule] += n * weight * (vote < 0)
        before = shares
        shares = [m / sum(mass) for m in mass]
        rates = [
            [h / c for h, c in zip(hs, cs, strict=True)] for hs, cs in zip(hits, cast, strict=True)
        ]
        if max(abs(a - b) for a, b in zip(before, shares, strict=True)) < EM_TOLERANCE:
            break
    return {code: _posterior(votes[code], shares, rates)[0] for code in counts}


def _posterior(votes: list[int], shares: list[float], rates: list[list[float]]) -> list[float]:
    weights = []
    for share, against in zip(shares, rates, strict=True):
        for vote, rate in zip(votes, against, strict=True):
            if vote:
                share *= rate if vote < 0 else 1 - rate
        weights.append(share)
    total = sum(weights)
    return [w / total for w in weights]


def _judged(measured: DataFrame, posterior: dict[int, float]) -> DataFrame:
    known = measured.sparkSession.createDataFrame(
        [(code, float(p)) for code, p in sorted(posterior.items())], "pattern int, quality double"
    )
    return (
        measured.withColumn("pattern", pattern(rules()))
        .join(F.broadcast(known), "pattern", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT))
    )


def learn(measured: DataFrame) -> dict[int, float]:
    """Posterior of good per vote pattern of all documents."""
    votes = rules()
    counts = measured.select(pattern(votes).alias("pattern")).groupBy("pattern").count()
    # at most 3 ** 8 rows, however many documents
    return estimate({r["pattern"]: r["count"] for r in counts.collect()}, len(votes))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document, repeated rows and NULL ids included: doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality
    (posterior of good). An empty table gives an empty one."""
    prepare(docs.sparkSession)
    measured = measures(docs.select("doc_id", "text")).drop(_KEPT + "text")
    measured = materialise(measured.withColumnRenamed(_KEPT + "doc_id", "doc_id"), "measures")
    return _judged(measured, learn(measured)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, whole and with their columns.

    They are written with their measures: the verdict needs all of them first, and a
    filter on a measure would otherwise be moved into the measuring itself."""
    prepare(docs.sparkSession)
    measured = materialise(measures(docs), "measured")
    return _judged(measured, learn(measured)).where("kept").select(
        *[F.col(f"`{_KEPT}{c}`").alias(c) for c in docs.columns]
    )
