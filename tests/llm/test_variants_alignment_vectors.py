"""Spelling variants, tokenizer alignment and near-duplicate vectors against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caseweave.llm import e8, embedding_dedup, spelling_variants
from caseweave.llm.byte_pairs import byte_letters
from caseweave.llm.embedding_dedup import embedding_duplicates
from caseweave.llm.fm_index import WordIndex, suffix_ranks
from caseweave.llm.token_alignment import Fragment, align_tokenizers, composed, fragment, ranges

from .conftest import ODD, prose

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


# -- spelling variants ---------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("seed", range(40))
def test_index_finds_every_word_one_edit_away_once(seed):
    draw = random.Random(seed)
    letters = "ab" if seed % 3 else "abcé÷ÿ"

    def some(n, known):
        return list({"".join(draw.choices(known, k=draw.randint(2, 9))) for _ in range(n)})

    words = some(draw.randint(1, 60), letters)
    asked = words + some(20, letters + "z")
    index = WordIndex(words)
    found = [
        (asked[q], index.words[w])
        for half in (True, False)
        for q, w in zip(*(x.tolist() for x in index.near(asked, half)), strict=True)
    ]
    assert sorted(found) == sorted((q, w) for q in asked for w in words if one_edit(q, w))


def test_suffix_ranks_sort_suffixes():
    codes = np.random.default_rng(1).integers(0, 3, 500)
    order = suffix_ranks(codes).tolist()
    assert order == sorted(range(500), key=lambda i: codes[i:].tolist())


def variants_by_force(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [x for x in n if abs(len(w) - len(x)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


VARIANT_COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def chained_words():
    """A chain of forms, ties of n, words that share a half, and letters beyond ASCII."""
    words = {"abcdefg": 5, "abcdefgh": 26, "abcdefghi": 140, "abcdefghij": 800}
    words |= {"colour": 60, "color": 900, "colours": 60, "colouré": 7, "colóur": 6, "COLOUR": 9}
    draw = random.Random(3)
    for _ in range(150):
        words["prefix" + "".join(draw.choices("abc", k=3))] = draw.randint(1, 40)
        words["".join(draw.choices("abc", k=3)) + "suffix"] = draw.randint(1, 40)
    rows, doc_id = [], 0
    for word, times in words.items():
        while times:
            take = min(times, draw.randint(1, 90))
            rows.append((doc_id, " ".join([word] * take)))
            doc_id, times = doc_id + 1, times - take
    return rows


@pytest.mark.parametrize("symbols", [250_000, 300])
def test_variants_match_brute_force(documents, counted, monkeypatch, symbols):
    # with small shards nearly every half is split over several
    monkeypatch.setattr(spelling_variants, "SHARD_SYMBOLS", symbols)
    rows = chained_words() + ODD + [(i, prose(i % 7, 300)) for i in range(60)]
    got = counted(spelling_variants.spelling_variants(documents(rows)), *VARIANT_COLUMNS)
    assert set(got) == variants_by_force(rows) and max(got.values()) == 1
    assert any(form and root != form for _, form, root, *_ in got)


def test_variants_of_nothing(documents):
    found = spelling_variants.spelling_variants
    assert found(documents([])).count() == 0
    assert found(documents([(1, None), (2, ""), (3, "few words only")])).count() == 0


# -- alignment of two tokenizers -----------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def aligned_by_force(rows, libraries):
    a_tool, b_tool = libraries
    byte_of = {letter: byte for byte, letter in byte_letters().items()}

    def piece(i):
        name = b_tool.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b_tool.is_byte(i) else name.replace("▁", " ").encode()

    def spans(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True))

    texts, counts = [], Counter()
    for doc_id, text in rows:
        a = a_tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tool.encode(text) if text else []
        a_parts = [bytes(byte_of[c] for c in a_tool.id_to_token(i)) for i in a]
        b_parts = [piece(i) for i in b]
        raw = (" " + text).encode() if text else b""
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw or not raw:
            texts.append((doc_id, [], [], [], []))
            continue
        at, bt = spans(a_parts), spans(b_parts)
        cuts = sorted({e for _, e in at} & {e for _, e in bt})
        # tokens by the first cut at or behind their end
        sides = [
            [(int(np.searchsorted(cuts, e)), str(i)) for i, (_, e) in zip(ids, spots, strict=True)]
            for ids, spots in ((a, at), (b, bt))
        ]
        both = [defaultdict(list), defaultdict(list)]
        for side, placed in zip(both, sides, strict=True):
            for cut, i in placed:
                side[cut].append(i)
        groups = [
            ",".join(both[0][k]) + "|" + ",".join(both[1][k]) for k in range(len(cuts))
        ]
        links, low = [], 0
        for i, (s, e) in zip(a, at, strict=True):
            while bt[low][1] <= s:
                low += 1
            # a token of e - s bytes meets so many others at most
            links += [(i, b[j]) for j in range(low, min(low + e - s, len(b))) if bt[j][0] < e]
        counts.update(links)
        texts.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    found = Counter()
    for doc_id, a, b, groups, links in texts:
        best = sum(counts[x] == most[x[1]] for x in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        numbers = (len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links))
        found[(doc_id, *numbers, sha)] += 1
    return found


HARD = [
    (20, "\n\n  a\t b  "),
    (21, "x▁y z"),
    (22, "ab" * 700),
    (23, "word é　  日本語 <|endoftext|> <s> " * 60),
    (24, "日本語" * 300),
    (25, "a " * 300 + "▁"),
    (26, " " * 900),
    (27, "\x1c a \x85 b c"),
    (28, "🙂🙂 🙂" * 90),
    (29, "don't 123 45\r\n\r\n  zz 🙂"),
    (30, "a\rb;\r\n c\r"),
    (31, "a;\r b '" * 80),
    (32, " {\r\r\n　x "),
    (33, " "),
]
ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize(("size", "frequent"), [(16_384, 1 << 20), (37, 40)])
def test_alignment_matches_brute_force(documents, counted, libraries, size, frequent):
    # with ranges of 37 bytes nearly every text is composed of a tree of fragments
    odd = [(i, t[:3000] if t else t) for i, t in ODD]
    rows = odd + HARD + [(50 + i, prose(i, 120)) for i in range(12)]
    got = counted(align_tokenizers(documents(rows), A_FILE, B_FILE, frequent, size), *ALIGNED)
    assert got == aligned_by_force(rows, libraries)


def test_alignment_of_long_and_no_texts(documents, counted, libraries):
    rows = [(1, prose(5, 4000)), (2, "xyz" * 6000), (2, prose(6, 3500))]
    got = counted(align_tokenizers(documents(rows), A_FILE, B_FILE), *ALIGNED)
    assert got == aligned_by_force(rows, libraries)
    assert align_tokenizers(documents([]), A_FILE, B_FILE).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_composition_is_associative_and_keeps_every_byte(seed):
    draw = random.Random(seed)
    raw = "".join(draw.choices(["a", "é", " ", "\n", "\r", "日", "b c"], k=60)).encode()
    parts = list(ranges(raw, draw.randint(1, 9)))
    assert b"".join(parts) == raw
    made = [fragment(p, i) for i, p in enumerate(parts)]

    def fold(items):
        """The fragment and what was closed on the way, by place."""
        if len(items) == 1:
            whole, middle = items[0]
            return whole, {2 * whole.at: middle} if middle else {}
        cut = draw.randint(1, len(items) - 1)
        left, closed = fold(items[:cut])
        right, more = fold(items[cut:])
        whole, meeting = composed(left, right)
        closed = closed | more
        return whole, closed | ({2 * left.at + 1: meeting} if meeting else {})

    trees = [fold(made) for _ in range(5)]
    assert all(t == trees[0] for t in trees)
    whole, closed = trees[0]
    pieces = [closed[k] for k in sorted(closed)]
    assert whole.prefix + b"".join(pieces) + whole.suffix == raw
    assert isinstance(whole, Fragment)


# -- near-duplicate vectors ----------------------------------------------------------


def test_nearest_lattice_point():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, 8)) * 3
    point = e8.nearest(x)
    twice = np.rint(point * 2).astype(int)
    assert (np.abs(point * 2 - twice) < 1e-9).all()
    assert ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all()
    assert (twice.sum(1) % 4 == 0).all()
    shortest = e8.shortest_vectors()
    assert shortest.shape == (240, 8) and np.allclose((shortest**2).sum(1), 2)
    own = ((x - point) ** 2).sum(1)
    others = ((x[:, None] - (point[:, None] + shortest)) ** 2).sum(2)
    assert (own <= others.min(1) + 1e-9).all()
    assert np.allclose(((x - e8.neighbour(x, point)) ** 2).sum(1), others.min(1))


VECTORS = "vec_id long, embedding array<float>, label int, size int, node string, key long"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2) for r in rows], VECTORS)


def by_force(rows):
    """(n_links, component) per row."""
    unit = []
    for vec_id, x, label in rows:
        good = vec_id is not None and label is not None and x and None not in x
        x = np.array(x, dtype=np.float32).astype(float) if good else np.zeros(1)
        good = good and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if good else None)
    near = defaultdict(set)
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b >= 0.98:
                near[i].add(j)
                near[j].add(i)
    found = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low = row[0] if row[0] is None else min(rows[j][0] for j in seen)
        found.append((row[0], len(near[i]), low, row[0] is None or row[0] == low))
    return found


def clusters(seed, sizes, spread, dimensions=64, first=0):
    draw = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = draw.normal(size=dimensions)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            x = centre + draw.normal(size=dimensions) * spread / np.sqrt(dimensions)
            rows.append((first + len(rows), [float(v) for v in x * draw.uniform(0.1, 9)], 1))
    return rows


def test_vectors_match_brute_force(spark, counted):
    rows = clusters(1, [1] * 40 + [2, 3, 5, 30], 0.02)
    x = rows[-1][1]
    rows += [(1000 + i, x, 1) for i in range(5)]  # equal vectors
    rows += [(1010, x, 2), (1011, x, 2), (1012, [2 * v for v in x], 2)]  # another label
    rows += [(1020, None, 1), (1021, [], 1), (1022, [0.0] * 64, 1), (1023, x, None)]
    rows += [(1024, [float("nan"), *x[1:]], 1), (1025, [float("inf"), *x[1:]], 1)]
    rows += [(1026, [None, *x[1:]], 1), (None, x, 1), (1027, x[:8], 1), (1028, x[:8], 1)]
    rows += [(1029, [1e-40, *[0.0] * 7], 3), (1030, [-0.0, 1.0], 3), (1031, [0.0, 1.0], 3)]
    rows += [(7, x, 1), (1032, rows[7][1], 1)]  # two vectors under one id
    got = counted(embedding_duplicates(vectors(spark, rows)))
    assert got == Counter(by_force(rows))


@pytest.mark.parametrize("part_rows", [2000, 25])
def test_recall_at_the_limit(spark, monkeypatch, part_rows):
    # pairs around the limit, in groups that fill several parts of a cell
    monkeypatch.setattr(embedding_dedup, "PART_ROWS", part_rows)
    rows = clusters(2, [150, 90] + [2] * 150, 0.138)
    want = {r[0]: r[1] for r in by_force(rows)}
    got = {r.vec_id: r.n_links for r in embedding_duplicates(vectors(spark, rows)).collect()}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(want.values()) > 2000
    assert sum(got.values()) >= 0.97 * sum(want.values())


def test_no_vectors(spark):
    assert embedding_duplicates(vectors(spark, [])).count() == 0
