from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from caseweave.llm.components import connected_components
from caseweave.llm.near_dedup import band_keys, deduplicated, near_duplicates, signature
from caseweave.llm.shingles import shingle_sets

from .conftest import LONG, ODD, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component, kept) per row, over all pairs of rows."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    named = [i for i, (doc_id, _) in enumerate(rows) if doc_id is not None]
    for n, a in enumerate(named):
        for b in named[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(b)] = find(a)
    least = {}
    for i in named:
        least[find(i)] = min(rows[i][0], least.get(find(i), rows[i][0]))
    found = [least.get(find(i)) for i in range(len(rows))]
    return Counter(
        (row[0], len(s), c, row[0] is None or row[0] == c)
        for row, s, c in zip(rows, sets, found, strict=True)
    )


def changed(text, share, seed):
    draw = random.Random(seed)
    return " ".join(w if draw.random() > share else f"e{draw.random()}" for w in text.split())


def compare(documents, rows):
    got = near_duplicates(documents(rows)).collect()
    assert Counter(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("turned", [False, True])
def test_two_texts_under_one_id(documents, turned):
    a, b = prose(1, 60), prose(2, 60).split()[:13]
    rows = [(5, a), (5, " ".join(b)), (9, " ".join(b)), (10, " ".join([*b, "more"]))]
    rows += [(None, a), (None, a), (5, None), (3, a)]
    compare(documents, rows[::-1] if turned else rows)


def test_links_match_brute_force(documents):
    rows = [(i, prose(i, 120)) for i in range(25)]
    for base in range(6):
        for copy in range(12):  # near copies on both sides of the limit
            text = changed(rows[base][1], 0.002 * (copy + 1), 100 * base + copy)
            rows.append((1000 + 50 * base + copy, text))
    rows += [(5000 + i, rows[0][1].upper()) for i in range(40)]  # equal sets
    compare(documents, rows)


def test_small_sets_and_odd_rows(documents):
    rows = [*ODD, (20, "a b c d e f"), (21, "a b c d e f"), (22, "A  b C"), (23, "a b c"), (24, LONG + " end")]
    rows += [(30 + i, " ".join("abcdefghijklmnop"[: 5 + i])) for i in range(10)]
    compare(documents, rows)


def test_chain_is_one_component(documents):
    words = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(words[12 * i : 12 * i + 200])) for i in range(16)]
    compare(documents, rows)


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0


def test_one_of_each_group_stays_whole(documents):
    rows = [(3, "a b c d e f g"), (2, "a b c d e f g"), (4, None), (None, "a b c d e f g"), (5, "")]
    docs = documents(rows)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "a b c d e f g"), (2, "a b c d e f g"), (4, ""), (5, ""),
    ]


def test_signatures_agree_as_often_as_sets():
    draw = np.random.default_rng(1)
    for size, shared in ((8, 6), (60, 48), (3000, 2500)):
        pool = draw.integers(0, 1 << 63, 2 * size - shared, dtype=np.uint64) * np.uint64(2)
        a, b = np.sort(pool[:size]), np.sort(np.concatenate([pool[:shared], pool[size:]]))
        agree = np.mean(signature(a, 4000) == signature(b, 4000))
        assert abs(agree - shared / (2 * size - shared)) < 0.12
    assert (band_keys(signature(a)) == band_keys(signature(a.copy()))).all()


def test_shingle_sets_count_like_text():
    texts = [t for _, t in ODD if t is not None] + [prose(1, 50)]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    found = {r.id: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
