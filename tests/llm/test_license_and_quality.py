from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from caseweave.llm.license_scan import notice_spans, scan_licenses
from caseweave.llm.license_texts import NOTICES, PHRASES
from caseweave.llm.quality_rules import estimate, kept_documents, quality_rules

from .conftest import ODD, prose


def license_row(doc_id, text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return (doc_id, len(words), len(places), *ends, ",".join(sorted(labels)))


BASE = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def test_base_places_match_brute_force(documents, counted):
    draw = random.Random(2)
    signs = ["cc", "by", "CC-BY", "general", "public", "License", "ALL", "rights", "reserved", "cc by",
             "K", "İ", "é", "É", ".", "\n", "x1", "cc by cc by", "byé"]
    rows = [(i, " ".join(draw.choice(signs) for _ in range(draw.randint(0, 30)))) for i in range(300)]
    rows += ODD
    assert counted(scan_licenses(documents(rows)), *BASE) == Counter(license_row(*r) for r in rows)


def test_notices_are_found_with_edits_and_left_alone_otherwise(documents):
    rows, expected = [], {}
    for i, (label, notice) in enumerate(NOTICES):
        words = notice.split()
        rows.append((i, f"{prose(i, 40)} {notice.upper()} {prose(i + 50, 30)}"))
        expected[i] = label
        if len(words) > 15:  # a word left out, one put in
            rows.append((100 + i, " ".join([*words[:6], *words[7:11], "extra", *words[11:]])))
            expected[100 + i] = label
    rows += [(500 + i, prose(i, 200)) for i in range(20)]
    rows.append((600, "Released under"))
    rows.append((601, " ".join(sorted(NOTICES[2][1].split()))))
    found = {r.doc_id: r for r in scan_licenses(documents(rows)).collect()}
    for doc_id, label in expected.items():
        assert label in found[doc_id].labels.split(","), (doc_id, label)
        assert 0.6 <= found[doc_id].score <= 1
    for doc_id in [*range(500, 520), 600, 601]:
        assert (found[doc_id].labels, found[doc_id].score) == ("", 0.0)


def test_spans_have_their_place(documents):
    spans = notice_spans(documents([(1, "one two three Released under the MIT License four")])).collect()
    best = max(spans, key=lambda s: s.coverage)
    assert {s.label for s in spans} == {"mit"}
    assert (best.first_word, best.n_span, best.coverage) == (3, 5, 1.0)


def labels_by_words(text):
    """Label: best share of a notice, comparing words around every place it may begin at."""
    words = re.findall("[0-9a-z]+", (text or "").lower())
    best = {}
    for label, notice in NOTICES:
        target = re.findall("[0-9a-z]+", notice.lower())
        grams = [target[k : k + 3] for k in range(len(target) - 2)]
        for offset in range(-len(target), len(words)):
            starts = ((at, offset + at) for at in range(len(grams)))
            if not any(i >= 0 and words[i : i + 3] == grams[at] for at, i in starts):
                continue  # spans lie around offsets at which something matches
            last = n = None
            for at, gram in enumerate(grams):
                nearby = sorted(range(-3, 4), key=lambda d: (abs(d), d))
                spots = [offset + at + d for d in nearby]
                spots = [i for i in spots if i >= 0 and words[i : i + 3] == gram]
                if spots and (last is None or spots[0] > last):
                    last, n = spots[0], (n or 0) + 1
            share = (n or 0) / len(grams)
            if share >= 0.6 - 1e-9:
                best[label] = max(best.get(label, 0), share)
    return best


def test_lost_and_doubled_notices(documents):
    rows = [
        (1, "Released under the MIT License" + " the mit license" * 14),
        (2, "the MIT License, the MIT License"),
        (3, "the MIT License, the MIT License, under the MIT License"),
        (4, " ".join(["the mit license"] * 9) + " Released under the MIT License"),
        (5, "License MIT the under Released " * 4),
        (6, "Licensed under the MIT License " * 5),
    ]
    found = {r.doc_id: (r.labels, r.score) for r in scan_licenses(documents(rows)).collect()}
    assert found[1] == found[4] == found[6] == ("mit", 1.0)
    assert found[2] == found[5] == ("", 0.0)
    assert found[3] == ("mit", pytest.approx(2 / 3))


def test_notices_match_comparison_of_words(documents):
    draw = random.Random(8)
    rows = []
    for i in range(250):
        words = []
        for _ in range(draw.randint(1, 3)):
            notice = re.findall("[0-9A-Za-z]+", draw.choice(NOTICES)[1])
            for _ in range(draw.randint(0, 6)):
                at = draw.randrange(len(notice))
                change = draw.choice(("drop", "add", "copy", "swap"))
                if change == "drop":
                    del notice[at : at + draw.randint(1, 2)]
                elif change == "add":
                    notice.insert(at, draw.choice(("new", "the", "License")))
                elif change == "copy":
                    notice[at:at] = notice[max(0, at - 4) : at] * draw.randint(1, 4)
                else:
                    notice[at:] = notice[at:][::-1] if draw.random() < 0.2 else notice[at:]
                notice = notice or ["the"]
            words += notice + prose(i, draw.randint(0, 5)).split()
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r for r in scan_licenses(documents(rows)).collect()}
    assert sum(bool(labels_by_words(text)) for _, text in rows) > 100
    for i, text in rows:
        want = labels_by_words(text)
        more = set(got[i].labels.split(",")) - set(got[i].base_labels.split(",")) - {""}
        assert more == set(want) - set(got[i].base_labels.split(",")), text
        score = 1.0 if got[i].base_labels else max(want.values(), default=0.0)
        assert got[i].score == pytest.approx(score), text


def test_repeated_rows_and_empty_table(documents):
    text = "Licensed under CC BY-NC 4.0"
    rows = scan_licenses(documents([(1, text), (1, text), (1, "plain")])).collect()
    assert sorted((r.labels, r.score) for r in rows) == [("", 0.0), ("cc-by,cc-by-nc", 1.0), ("cc-by,cc-by-nc", 1.0)]
    assert scan_licenses(documents([])).count() == 0


def quality_row(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)
    }
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


MEASURED = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_match_brute_force(documents, counted):
    draw = random.Random(5)
    rows = list(ODD)
    for i in range(200):
        n = draw.randint(0, 60)
        rows.append((100 + i, "".join(draw.choice(["a", "bb", "#", "|x", "C!"]) + draw.choice([" ", "\n", "\t ", " "]) for _ in range(n))))
    repeated = prose(9, 25)
    rows += [(900, f"{repeated}\n{prose(8, 90)}\n{repeated}"), (901, "a " * 9), (902, "a b " * 20)]
    got = quality_rules(documents(rows))
    assert counted(got, *MEASURED) == Counter(quality_row(*r) for r in rows)
    assert not any(r.kept for r in got.collect() if r.base_failed)
    assert quality_rules(documents([])).count() == 0


def corpus():
    rows = [(i, prose(i, 120, 2000)) for i in range(300)]
    rows += [(1000 + i, " ".join(w + "###" for w in prose(i, 100).split())) for i in range(15)]
    rows += [(1100 + i, " ".join(w.upper() + "!!" for w in prose(i, 100).split())) for i in range(15)]
    rows += [(1200 + i, " ".join([prose(i, 3)] * 60)) for i in range(15)]
    return rows


def test_bad_documents_go_and_good_ones_stay(documents):
    docs = documents(corpus())
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))


def test_verdicts_do_not_depend_on_the_size(documents):
    verdicts = {}
    for copies in (1, 3):
        rows = [(i + 10_000 * c, t) for c in range(copies) for i, t in corpus()]
        for r in quality_rules(documents(rows)).collect():
            verdicts.setdefault(r.doc_id % 10_000, set()).add(r.kept)
    assert all(len(v) == 1 for v in verdicts.values())


def test_estimate_is_a_probability():
    posterior = estimate({3**8 - 1: 900, 3**8 - 3: 30, 0: 5}, 8)
    assert all(0 <= p <= 1 for p in posterior.values())
    assert posterior[3**8 - 1] > 0.95 > 0.5 > posterior[0]
    assert estimate({}, 8) == {}


@pytest.mark.parametrize("scale", [1, 1000])
def test_estimate_scales(scale):
    a = estimate({3**8 - 1: 900, 3**8 - 3: 30, 0: 5}, 8)
    b = estimate({3**8 - 1: 900 * scale, 3**8 - 3: 30 * scale, 0: 5 * scale}, 8)
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)
