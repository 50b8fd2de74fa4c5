from __future__ import annotations

import hashlib
import random
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caseweave.llm.byte_pairs import PairCounter, token_counts
from caseweave.llm.common import clear_scratch, materialise, scratch_path
from caseweave.llm.memo import Memo
from caseweave.llm.piece_codec import PieceCodec, encode_decode

from .conftest import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = [
    "a", "b", "th", "the", " ", "  ", "\n", "\x1c", "▁", "é", "\0", "\x85", "\xa0", "日", "😀",
    "=", "----", "<s>", "<0x41>", "<|endoftext|>", "<|endof", "'s", "'LL", "́", "ing", "²", "12",
    "\t", "\r", "aaaa", "    ", "İ", "ẞ", "​",
]


def texts():
    draw = random.Random(3)
    made = ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    made += [s * n for s in (" ", "a", "=", "▁") for n in range(40)]
    any_sign = [chr(c) for c in (draw.randint(1, 0x2FFFF) for _ in range(4000)) if not 0xD800 <= c < 0xE000]
    return [*made, "thequick" * 3000, "".join(any_sign), *(t for _, t in ODD if t)]


def test_pieces_are_the_library_s():
    codec, library = PieceCodec(open(MODEL, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in texts():
        ids = list(codec.encode_whole(text))
        assert ids == library.encode(text, add_bos=True, add_eos=True)
        assert codec.decode(ids) == library.decode(ids)


def test_any_ids_decode_like_the_library():
    codec, library = PieceCodec(open(MODEL, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    draw = random.Random(4)
    for _ in range(3000):
        ids = [
            draw.choice([draw.randint(0, 31999), draw.randint(3, 258), draw.randint(200, 258), 0, 1, 2, 28705])
            for _ in range(draw.randint(0, 12))
        ]
        assert codec.decode(ids) == library.decode(ids)


def test_encode_decode_rows(documents, counted):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = {}
    for doc_id, text in ODD:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        row = (doc_id, len(ids), hashlib.sha256(raw).hexdigest(),
               hashlib.sha256(library.decode(ids).encode()).hexdigest())
        expected[row] = expected.get(row, 0) + 1
    assert counted(encode_decode(documents(ODD), MODEL)) == expected
    assert encode_decode(documents([]), MODEL).count() == 0


def test_encode_decode_gives_ids_and_text(documents):
    row = encode_decode(documents([(1, "The quick  brown\nfox")]), MODEL, with_text=True).first()
    assert (row.decoded, row.n_tokens) == ("The quick  brown\nfox", len(row.ids))


def test_counts_are_the_library_s():
    counter, library = PairCounter(open(JSON, "rb").read()), Tokenizer.from_file(JSON)
    for text in texts():
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_rows(documents, counted):
    library = Tokenizer.from_file(JSON)
    expected = {}
    for doc_id, text in ODD:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        row = (doc_id, len((text or "").encode()), n, n > 1024)
        expected[row] = expected.get(row, 0) + 1
    assert counted(token_counts(documents(ODD), JSON)) == expected
    assert token_counts(documents([]), JSON).count() == 0


def test_over_limit_is_above_it(documents):
    rows = token_counts(documents([(1, "a b c"), (2, "a b c d")]), JSON, limit=3).collect()
    assert {r.doc_id: r.over_limit for r in rows} == {1: False, 2: True}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        PairCounter(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())


def test_memo_is_bounded():
    memo = Memo(10)
    for i in range(1000):
        memo.put(i, i)
        memo.get(0) or memo.put(0, 5)
    assert len(memo._new) + len(memo._old) <= 20
    assert (memo.get(0), memo.get(999), memo.get(500)) == (5, 999, None)
    for key in ("x" * 65, ("x" * 40, "y" * 40)):
        memo.put(key, 1)
        assert memo.get(key) is None


def test_scratch_tables_are_removed(spark, documents):
    docs = materialise(documents([(1, "kept until cleared")]), "some")
    assert docs.count() == 1
    folder = Path(scratch_path(spark, "x")).parent
    assert list(folder.iterdir())
    clear_scratch(spark)
    assert not folder.exists()
