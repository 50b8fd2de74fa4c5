from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from caseweave.llm import quality_classifier as qc
from caseweave.llm import toxicity as tx

from .conftest import ODD, prose


@pytest.fixture(scope="module")
def labelled_table(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")

    return make


def brute_segments(scores):
    """All maximal segments by definition: split at the best one, and again beside it."""

    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 1e-12 and (found is None or total > found[2] + 1e-9):
                    found = (a, b, total)
        return found

    def split(lo, hi):
        found = best(lo, hi)
        if found is None:
            return []
        a, b, total = found
        return [*split(lo, a), (a, b, total), *split(b + 1, hi)]

    return split(0, len(scores))


def test_segments_match_brute_force():
    draw = random.Random(1)
    for _ in range(400):
        scores = [draw.choice([-3.1, -2.3, -1.07, 0.9, 1.83, 2.61]) + draw.random() / 100 for _ in range(draw.randint(0, 14))]
        got = tx.maximal_segments(list(enumerate(scores)))
        expected = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in got], [s for *_, s in expected])


def test_segments_are_linear():
    runs = [(i, 1.0 if i % 2 else -0.9) for i in range(200_000)]
    assert len(tx.maximal_segments(runs)) == 1
    runs = [(i, 1.0 if i % 2 else -1.1) for i in range(200_000)]
    assert len(tx.maximal_segments(runs)) == 100_000


BAD = ["vilewort", "grubface", "mudbrain", "snotling"]


def toxic_corpus(n=400):
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(i, 80, 300).split()
        if toxic:
            for k in range(3):
                words[10 + 5 * k] = BAD[(i // 4 + k) % 4]
        rows.append((i, " ".join(words), 1, int(toxic)))
    return rows


def test_toxic_documents_are_found(documents, labelled_table):
    rows = toxic_corpus()
    labels = labelled_table([(i, q, t, "clash") for i, _, q, t in rows])
    docs = documents([(i, text) for i, text, *_ in rows] + ODD)
    got = tx.toxicity(docs, labels).collect()
    truth = {i: t for i, _, _, t in rows}
    assert len(got) == len(rows) + len(ODD)
    plain = [r for r in got if r.doc_id in truth and r.doc_id > 20]
    assert all(r.predicted == truth[r.doc_id] for r in plain)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held


def test_labels_of_the_held_out_fold_are_not_read(documents, labelled_table):
    rows = toxic_corpus(200)
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = documents([(i, text) for i, text, *_ in rows])
    scores = []
    for flip in (False, True):
        labels = labelled_table([(i, q, 1 - t if flip and i in held else t, None) for i, _, q, t in rows])
        scores.append({r.doc_id: r.score for r in tx.toxicity(docs, labels).collect()})
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)


def test_clean_documents_keep_their_columns(documents, labelled_table):
    rows = toxic_corpus(200)
    docs = documents([(i, text) for i, text, *_ in rows] + [(None, None), (900, "")])
    labels = labelled_table([(i, q, t, None) for i, _, q, t in rows])
    kept = tx.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert None in ids and 900 in ids
    assert {i for i in ids if i is not None and i < 900} == {i for i, _, _, t in rows if not t}


def test_toxicity_without_labels_or_documents(documents, labelled_table):
    none = labelled_table([])
    rows = tx.toxicity(documents(ODD), none).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.0}
    one = labelled_table([(1, None, None, None), (None, 1, 1, None)])
    assert tx.toxicity(documents([]), one).count() == 0
    assert tx.clean_documents(documents(ODD), none).count() == len(ODD)


def rare_toxic_corpus(n=6400):
    """A sixteenth is toxic; all of that and a ninth of the clean texts hold bad words."""
    draw, known, rows = random.Random(3), prose(1, 200).split(), []
    for i in range(n):
        toxic = i % 16 == 0
        words = draw.choices(known, k=30)
        if toxic or i % 9 == 4:
            words[10:13] = BAD[:3]
        rows.append((i, " ".join(words), 1, int(toxic)))
    return rows


def test_scores_do_not_depend_on_thinning(documents, labelled_table, monkeypatch):
    rows = rare_toxic_corpus()
    docs = documents([(i, text) for i, text, *_ in rows])
    labels = labelled_table([(i, q, t, None) for i, _, q, t in rows])
    found = []
    for limit in (8000, 600):  # 600: all toxic documents, about an eighth of the clean ones
        monkeypatch.setattr(tx, "SAMPLE_PER_CLASS", limit)
        found.append({r.doc_id: r for r in tx.toxicity(docs, labels).collect()})
    whole, thinned = found
    assert max(abs(whole[i].score - thinned[i].score) for i in whole) < 0.1
    assert all(whole[i].predicted == thinned[i].predicted for i in whole)


def test_all_significant_features_are_kept(spark):
    counts = spark.range(6000).selectExpr("concat('w', id) AS feature", "60L AS toxic", "id % 2 AS clean")
    counts = counts.unionAll(spark.createDataFrame([("plain", 60, 200)], counts.schema))
    kept = tx._log_odds(counts, 400_000, 1_200_000, {0: 1.8, 1: 0.2})
    assert {r.feature for r in kept.collect()} == {f"w{i}" for i in range(6000)}


def test_logistic_line_of_unequal_classes():
    for toxic, clean in ((1.0, 1.0), (0.1, 1.9), (0.01, 1.99)):
        points = [(0.0, 1, 30 * toxic), (0.0, 0, 7800 * clean), (2.5, 0, 130 * clean), (4.5, 1, 7900 * toxic)]
        offset, slope = tx.logistic_line(points)
        left = [w * (y - 1 / (1 + np.exp(-offset - slope * x))) for x, y, w in points]
        assert sum(left) == pytest.approx(0.1 * offset, abs=1e-4)
        assert np.dot(left, [x for x, *_ in points]) == pytest.approx(0.1 * (slope - 1), abs=1e-4)


def test_scores_do_not_depend_on_repetition(documents, labelled_table, monkeypatch):
    rows = toxic_corpus(120)
    many = [(1000 * k + i, text, q, t) for k in range(40) for i, text, q, t in rows]
    scores = []
    for table, limit in ((many[: 40 * 60], 8000), (many, 8000), (many, 1500)):
        monkeypatch.setattr(tx, "SAMPLE_PER_CLASS", limit)
        docs = documents([(i, text) for i, text, *_ in table])
        labels = labelled_table([(i, q, t, None) for i, _, q, t in table])
        model = tx.fit(docs, labels)
        got = tx.score_toxicity(documents([(i, text) for i, text, *_ in rows]), model)
        scores.append({r.doc_id: r.score for r in got.collect()})
    for other in scores[1:]:
        assert other == pytest.approx(scores[0], abs=0.01)


def test_passages_have_their_place():
    model = tx.ToxicModel({"grubface": 6.0, "mud*": 5.0}, -0.05, 1.0, 0.01, -3.0, 2.0)
    scorer = tx.ToxicScorer(model)
    text = " ".join(["word"] * 30 + ["Grubface", "you", "mudlark"] + ["word"] * 200 + ["mudder"])
    passages, evidence = scorer.passages(text)
    assert [(a, b) for a, b, _ in passages] == [(30, 32), (233, 233)]
    assert evidence > 0 and model.probability(evidence) > 0.5 > model.probability(0.0)
    assert scorer.passages("") == ([], 0.0)


def quality_corpus(n=600):
    rows = []
    for i in range(n):
        words = prose(i, 60 + i % 50, 3000).split()
        if i % 6 == 0:
            words = [w + "$$$" for w in words]
        elif i % 6 == 1:
            words = [w for w in words[:8] for _ in range(8)]
        rows.append((i, " ".join(words), int(i % 6 > 1)))
    return rows


def test_quality_from_good_and_unlabelled_alone(documents, labelled_table):
    rows = quality_corpus()
    docs = documents([(i, text) for i, text, _ in rows] + ODD)
    labels = labelled_table([(i, y, 0, "clash") for i, _, y in rows if i % 3])
    got = qc.quality(docs, labels).collect()
    assert len(got) == len(rows) + len(ODD)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id > 20]
    assert len(held) > 100
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_bad_and_held_out_labels_are_not_read(documents, labelled_table):
    rows = quality_corpus(200)
    docs = documents([(i, text) for i, text, _ in rows])
    seen = [(i, 1, 0, None) for i, _, y in rows if y and zlib.crc32(str(i).encode()) % 4 != 2]
    rest = [(i, y, 0, None) for i, _, y in rows if not y or zlib.crc32(str(i).encode()) % 4 == 2]
    scores = [{r.doc_id: r.score for r in qc.quality(docs, labelled_table(x)).collect()} for x in (seen, seen + rest)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)


def test_quality_without_labels_or_documents(documents, labelled_table):
    rows = qc.quality(documents(ODD), labelled_table([])).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.0}
    assert qc.quality(documents([]), labelled_table([(1, 1, 0, None)])).count() == 0


def with_one(rows):
    return np.hstack([rows, np.ones((len(rows), 1))])


def test_prior_is_estimated():
    draw = np.random.default_rng(2)
    for share in (0.5, 0.8):
        clean = with_one(draw.normal(0, 1, (int(8000 * share), 3)))
        bad = with_one(draw.normal(4, 1, (int(8000 * (1 - share)), 3)))
        other = np.vstack([clean, bad])
        # the trusted ones are some of all documents
        assert abs(qc.estimate_prior(clean[:1500], qc.losses_of(other), len(other)) - share) < 0.05


@pytest.mark.parametrize("prior", [0.5, 0.8, 0.97])
def test_risk_is_at_its_minimum(prior):
    """Against the risk by its definition: no way leads down from the weights found."""
    draw = np.random.default_rng(3)
    good = with_one(draw.normal(0, 1, (400, 4)))
    other = with_one(np.vstack([draw.normal(0, 1, (700, 4)), draw.normal(2, 1, (300, 4))]))

    def risk(w):
        plus, minus = np.logaddexp(0, -good @ w).mean(), np.logaddexp(0, good @ w).mean()
        part = np.logaddexp(0, other @ w).mean() - prior * minus
        return prior * plus + max(0, part) + 0.5 * 5e-4 * (w[:-1] ** 2).sum() + 5e-7 * w[-1] ** 2, part

    found = qc.least_risk(good, qc.losses_of(other), prior, decay=5e-4)
    least, part = risk(found)
    assert part > -5 * qc.ZERO_RISK and (prior < 0.9 or part < 5 * qc.ZERO_RISK)
    for _ in range(300):
        way = draw.normal(size=5)
        for size in (0.3, 0.03):
            assert risk(found + size * way / np.linalg.norm(way))[0] > least - 5 * qc.ZERO_RISK
    # a plain descent on the definition ends no lower
    w, best = np.zeros(5), np.inf
    for step in range(4000):
        eps = 1e-5
        slope = np.array([(risk(w + eps * e)[0] - risk(w - eps * e)[0]) / (2 * eps) for e in np.eye(5)])
        w = w - 0.5 / (1 + step / 200) * slope
        best = min(best, risk(w)[0])
    assert best > least - 5 * qc.ZERO_RISK


def test_gradient_and_second_derivatives():
    draw = np.random.default_rng(4)
    rows, w = with_one(draw.normal(size=(50, 3))), draw.normal(size=4)
    for sign in (1, -1):
        loss, slope, second = qc.losses_of(rows, sign)(w)
        assert loss == pytest.approx(np.log(1 + np.exp(sign * rows @ w)).mean())
        for k, e in enumerate(np.eye(4) * 1e-5):
            up, down = (qc.losses_of(rows, sign)(w + x) for x in (e, -e))
            assert slope[k] == pytest.approx((up[0] - down[0]) / 2e-5, abs=1e-6)
            assert second[k] == pytest.approx((up[1] - down[1]) / 2e-5, abs=1e-6)


def test_sums_over_a_table_equal_sums_at_hand(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, qc.FEATURES)).astype(np.float32)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "doc_id long, features array<float>")
    centre, spread = x.mean(0), x.std(0) + 0.05
    w = draw.normal(size=qc.FEATURES + 1) * 0.1
    over = qc.losses_over(table.repartition(11), 300, centre, spread)(w)
    at_hand = qc.losses_of(with_one((x - centre) / spread))(w)
    for a, b in zip(over, at_hand, strict=True):
        assert np.allclose(a, b, atol=1e-4)


def test_verdicts_do_not_depend_on_the_number_of_documents():
    """Features of sf0.1 documents: a part of the unlabelled gives the verdicts of all."""
    import duckdb

    found = duckdb.sql(
        "SELECT doc_id, coalesce(text, ''), quality FROM '/root/testdata/sf0.1/documents.parquet'"
        " LEFT JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) ORDER BY doc_id"
    ).fetchall()
    reader = qc.FeatureReader()
    x = np.stack([reader.read(text) for _, text, _ in found]).astype(np.float64)
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in found])
    quality = np.array([-1 if q is None else q for *_, q in found])
    verdicts = []
    for n in (2000, 5000, len(x)):
        others = np.flatnonzero(~held)
        others = np.random.default_rng(n).permutation(others)[:n]
        centre, spread = x[others].mean(0), x[others].std(0) + 0.05
        scaled = with_one((x - centre) / spread)
        trusted = (quality == 1) & ~held
        trusted[np.setdiff1d(np.arange(len(x)), others)] = False
        good, n_others = scaled[trusted], len(others)
        other = qc.losses_of(scaled[others])
        weights = qc.least_risk(good, other, qc.estimate_prior(good, other, n_others))
        verdicts.append(scaled @ weights >= np.log(qc.PREDICT_AT / (1 - qc.PREDICT_AT)))
    known = held & (quality >= 0)
    for v in verdicts:
        assert (v == verdicts[-1]).mean() >= 0.995
        assert (v[known] == (quality[known] == 1)).mean() >= 0.99
