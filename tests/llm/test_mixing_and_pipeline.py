from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from caseweave.llm import mixing
from caseweave.llm.mixing import mix, mixed_documents, water_fill

from .conftest import ODD, prose


def filled(sizes, weights, epochs):
    """Targets by clamping one source after the other."""
    total, clamped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in clamped]
        if not free:
            return [epochs * s for s in sizes]
        rest = total - sum(epochs * sizes[i] for i in clamped)
        level = rest / sum(weights[i] for i in free)
        above = {i for i in free if weights[i] * level > epochs * sizes[i] + 1e-9}
        if not above:
            return [epochs * s if i in clamped else weights[i] * level for i, s in enumerate(sizes)]
        clamped |= above


@pytest.mark.parametrize("seed", range(4))
def test_water_filling(spark, seed):
    draw = random.Random(seed)
    sizes = [draw.choice([0, 1, 10, 500, 10_000, 400_000]) for _ in range(40)]
    weights = [1 + i % 3 for i in range(40)]
    rows = [(f"s{i}", s, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
    table = spark.createDataFrame(rows, "source string, source_size long, weight long")
    got = {r.source: r.target for r in water_fill(table).collect()}
    for i, target in enumerate(filled(sizes, weights, 3)):
        assert got[f"s{i}"] == pytest.approx(target, abs=1e-6)


def corpus(seed=0):
    draw = random.Random(seed)
    names = [None, "", "a", "B", "é", "zz", "src10", "src9", "hot"]
    rows = [(i, prose(i, draw.randint(0, 60)), draw.choice(names)) for i in range(900)]
    rows += [(1000 + i, prose(i, draw.randint(0, 60)), "hot") for i in range(900)]
    return rows + [(5000, None, "a"), (None, "x y", "zz"), (5001, "p q", "tiny"), (5001, "p q", "tiny")]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_reaches_its_targets(documents):
    rows = corpus()
    got = mix(documents(rows)).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += words(text)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    limits = dict(zip(order, filled([size[s] for s in order], [1 + i % 3 for i in range(len(order))], 3), strict=True))
    source_of = {(i, words(t)): s for i, t, s in rows}
    taken = defaultdict(int)
    for r in got:
        source = source_of[r.doc_id, r.size]
        assert (r.source_size, r.target) == (size[source], pytest.approx(limits[source]))
        assert r.taken == r.size * r.repetitions and 0 <= r.repetitions <= 3
        taken[source] += r.taken
    for source in order:
        assert abs(taken[source] - limits[source]) <= max(0.01 * limits[source], 2), source


def taken_by_force(rows):
    """Repetitions by (doc_id, size) as sorted lists: one document after the other."""
    size, entries = defaultdict(int), defaultdict(list)
    for doc_id, text, source in rows:
        size[source] += words(text)
        key = "mix-1:" + ("" if doc_id is None else str(doc_id))
        place = int(hashlib.md5(key.encode()).hexdigest()[:15], 16)
        entries[source].append(((place, doc_id is not None, doc_id or 0, words(text)), doc_id))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    limits = filled([size[s] for s in order], [1 + i % 3 for i in range(len(order))], 3)
    found = defaultdict(list)
    for source, target in zip(order, limits, strict=True):
        whole = min(3, int(target / size[source] + 1e-9)) if size[source] else 0
        gap = max(0.0, target - whole * size[source])
        documents_ = sorted(entries[source], key=lambda e: e[0])
        extra = [0] * len(documents_)
        for k, (at, _) in enumerate(documents_):
            if whole < 3 and 0 < at[3] <= gap:
                extra[k], gap = 1, gap - at[3]
        fits = [
            (abs(at[3] - gap), at, k) for k, (at, _) in enumerate(documents_)
            if whole < 3 and at[3] and not extra[k] and abs(at[3] - gap) < gap
        ]
        if fits:
            extra[min(fits)[2]] = 1
        for (at, doc_id), more in zip(documents_, extra, strict=True):
            found[doc_id, at[3]].append(whole + more)
    return {k: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("seed", [0, 3])
def test_mix_matches_one_document_after_the_other(documents, monkeypatch, seed):
    rows = corpus(seed)
    rows += [(7000, "ten words " * 5, "equal")] * 50 + [(7001 + i, "three small words", "equal") for i in range(3)]
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    got = defaultdict(list)
    for r in mix(documents(rows)).collect():
        got[r.doc_id, r.size].append(r.repetitions)
    assert {k: sorted(v) for k, v in got.items()} == taken_by_force(rows)


def test_equal_rows_end_near_the_target(documents):
    """50 equal rows of 10 words: as many are repeated as the target takes."""
    rows = [(1, "ten words " * 5, "b")] * 50 + [(10 + i, prose(i, 50), "a") for i in range(3)]
    docs = documents(rows)
    got = [r for r in mix(docs).collect() if r.doc_id == 1]
    assert len(got) == 50 and len({r.repetitions for r in got}) == 2
    assert abs(sum(r.taken for r in got) - got[0].target) <= 5
    times = sum(r.repetitions for r in got)
    for other in (docs, docs.repartition(7)):
        assert mixed_documents(other).where("doc_id = 1").count() == times


def test_reruns_and_partitions_agree(documents):
    docs = documents(corpus(1))
    one = sorted(map(str, mix(docs.repartition(7)).collect()))
    assert one == sorted(map(str, mix(docs.coalesce(1)).collect()))
    other = sorted(map(str, mix(docs, seed="another").collect()))
    assert one != other


def test_odd_rows_and_empty_tables(documents):
    got = mix(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert all(r.taken == 0 for r in got if not r.size)
    assert sum(r.taken for r in got) == sum(r.size for r in got)  # one source: its own size
    assert mix(documents([])).count() == 0
    empty = mix(documents([(1, None, "a"), (2, "", None)])).collect()
    assert {(r.target, r.taken) for r in empty} == {(0.0, 0)}


def test_mixed_documents_are_repeated_whole(documents):
    rows = [r for r in corpus(2) if r[0] != 5001]
    docs = documents(rows)
    plan = {(r.doc_id, r.size): r.repetitions for r in mix(docs).collect() if r.size}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = defaultdict(int)
    text_of = {i: t for i, t, _ in rows}
    for r in mixed.collect():
        assert r.text == text_of[r.doc_id]
        found[r.doc_id, words(r.text)] += 1
    assert dict(found) == {k: n for k, n in plan.items() if n}


def test_pipeline_stages_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, kept = start, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), start.schema)
        assert docs.columns == start.columns
        kept.append(docs.count())
    assert start.count() > kept[0] >= kept[1] >= kept[2] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.count() == kept[3]


def test_pipeline_matches_its_operators(spark):
    from caseweave.llm.near_dedup import near_duplicates
    from caseweave.llm.quality_rules import quality_rules
    from caseweave.llm.toxicity import toxicity

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdicts = [
        lambda d: {r.doc_id for r in quality_rules(d).collect() if r.kept},
        lambda d: {r.doc_id for r in toxicity(d, labels).collect() if not r.predicted},
        lambda d: {r.doc_id for r in near_duplicates(d).collect() if r.kept},
        lambda d: {r.doc_id for r in mix(d).collect() if r.repetitions and r.size},
    ]
    for verdict, (_, stage) in zip(verdicts, corpus_pipeline.STAGES, strict=False):
        after = stage(spark, docs, sf_dir)
        assert {r.doc_id for r in after.select("doc_id").collect()} == verdict(docs)
        docs = spark.createDataFrame(after.collect(), docs.schema)


def test_last_stages_match_brute_force(spark, documents):
    """Near-duplicates, mix and pieces, one after the other, against plain Python."""
    from .test_near_dedup import brute, changed

    rows = [(i, prose(i, 30 + i % 40), draw) for i, draw in enumerate("abcab" * 12)]
    rows += [(100 + i, rows[i][1], "c") for i in range(8)]  # exact copies
    rows += [(200 + i, changed(rows[i][1], 0.01, i), "a") for i in range(8)]  # near ones
    rows += [(300, "Ünïcode ▁ 日本語 😀 \n\t text", "b"), (301, None, "b"), (302, "one", None)]
    stages = {name: stage for name, stage in corpus_pipeline.STAGES}
    sf_dir = "/root/testdata/sf0.001"

    kept = stages["near-duplicates"](spark, documents(rows), sf_dir)
    wanted = {doc_id for doc_id, _, _, stays in brute([(i, t) for i, t, _ in rows]) if stays}
    stay = [r for r in rows if r[0] in wanted]
    assert sorted((r.doc_id, r.text, r.source) for r in kept.collect() if r.text) == sorted(
        (i, t, s) for i, t, s in stay if t
    )
    assert len(stay) < len(rows) - 8

    mixed = stages["mixing"](spark, documents(stay), sf_dir)
    times = Counter(r.doc_id for r in mixed.collect())
    force = taken_by_force(stay)
    assert times == Counter({i: n[0] for (i, size), n in force.items() if size and n[0]})
    assert max(times.values()) > 1

    taken = [r for r in stay for _ in range(times[r[0]])]
    tool = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    want = Counter()
    for doc_id, text, _ in taken:
        ids = tool.encode(text, add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want[doc_id, len(ids), hashlib.sha256(raw).hexdigest()] += 1
    found = stages["pieces"](spark, documents(taken), sf_dir).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in found) == want
