"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE (tokenizers file) over a space and the text, B a sentencepiece BPE
over the text, which adds that space itself. Offsets where tokens of both end cut them
into groups; two tokens are linked if their bytes overlap.

Both tokenizers always end a token between a character that is not white space and
white space (but a carriage return) that follows it, which is checked for a vocabulary
when it is loaded. So there is a cut, and tokens on one side do not depend on what is on
the other. A byte range of a
text is therefore a *fragment*: an open prefix of bytes up to its first such place,
closed groups up to its last one, and an open suffix. Fragments compose: the left one's
suffix and the right one's prefix are closed together, the outer ends stay open; a
fragment without such a place is open throughout and just adds its bytes. This is
associative, so ranges of a very long text are worked on by different tasks and composed
as a tree, FAN neighbours at a time. Closed groups leave the fragments at once; only the
open ends climb the tree.

Pairs of linked ids are counted over the corpus. The most frequent pairs, up to a fixed
number, go to all tasks; rarer ones are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseweave.llm.byte_pairs import PRE_TOKENS, byte_letters
from caseweave.llm.common import materialise, prepare, texts

# Bytes of a fragment of a long text, and fragments that one step of the tree composes.
RANGE_BYTES = 16_384
FAN = 8
# Pairs of ids that are sent to all tasks at most: 24 bytes each.
FREQUENT_PAIRS = 1 << 20
# Words whose tokens are kept for the next time, and the longest such word. What is held
# for them is some hundred bytes each.
KEPT_WORDS, KEPT_LETTERS = 500_000, 32
# Words from this length on are encoded alone.
LONG_LETTERS = 256
# Bytes of texts that are closed together, and of raw ranges that are sent on together.
BATCH_BYTES = 2 << 20

SPACE_SIGN = "▁"
# Fixed value: white space that a piece may join with what stands before it.
_JOINS = r"\r"
_SPACES = r"\p{White_Space}"
_BREAK = rf"[{_SPACES}--{_JOINS}]"
# Places where both tokenizers cut, looked for from the left and from the right.
_CUT = regex.compile(rf"(?V1)(?<=\P{{White_Space}})(?={_BREAK})")
_LAST_CUT = regex.compile(rf"(?V1)(?r)(?<=\P{{White_Space}})(?={_BREAK})")
# What stands between two cuts: a word with the white space before it, or white space at
# the end; over a carriage return a word goes on.
_WORDS = regex.compile(
    rf"{_SPACES}*\P{{White_Space}}+(?:{_JOINS}{_SPACES}*\P{{White_Space}}+)*"
    rf"(?:{_JOINS}{_SPACES}*\Z)?|{_SPACES}+"
)

@dataclass(frozen=True)
class Closed:
    """Several texts between cuts: numbers per text, groups as text, linked pairs of ids.

    Pairs of text i are ``a``, ``b``, ``times`` from offsets[i] to offsets[i + 1]."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    same_bytes: np.ndarray
    groups: list[str]
    offsets: np.ndarray
    a: np.ndarray
    b: np.ndarray
    times: np.ndarray


class _Words:
    """Tokens of words: numbers, groups as text, and codes of linked pairs, by word."""

    def __init__(self) -> None:
        self.words: list[str] = []
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 3), dtype=np.int64)  # n_a, n_b, n_groups
        self.same_bytes = np.zeros(0, dtype=bool)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.ends = np.zeros(0, dtype=np.int64)  # of each word's pairs
        self.uses = np.zeros(0, dtype=np.int64)

    def add(self, words: list[str], found: tuple) -> None:
        groups, numbers, same_bytes, pairs, ends = found
        start = len(self.words)
        self.place.update(zip(words, range(start, start + len(words)), strict=True))
        self.words += words
        self.groups += groups
        self.numbers = np.concatenate((self.numbers, numbers))
        self.same_bytes = np.concatenate((self.same_bytes, same_bytes))
        self.ends = np.concatenate((self.ends, ends + len(self.pairs)))
        self.pairs = np.concatenate((self.pairs, pairs))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), dtype=np.int64)))

    def drop_last(self, n: int) -> None:
        """Forget the n words that were added last."""
        for word in self.words[len(self.words) - n :]:
            del self.place[word]
        left = len(self.words) - n
        del self.words[left:], self.groups[left:]
        self.numbers, self.same_bytes = self.numbers[:left], self.same_bytes[:left]
        self.ends, self.uses = self.ends[:left], self.uses[:left]
        self.pairs = self.pairs[: int(self.ends[-1]) if left else 0]

    def picked(self, which: np.ndarray) -> _Words:
        """The words at the given places, with half of their uses, so that old ones fade."""
        out = _Words()
        out.words = [self.words[k] for k in which.tolist()]
        out.place = dict(zip(out.words, range(len(which)), strict=True))
        out.groups = [self.groups[k] for k in which.tolist()]
        out.numbers, out.same_bytes = self.numbers[which], self.same_bytes[which]
        n_pairs = np.diff(self.ends, prepend=0)[which]
        out.ends = np.cumsum(n_pairs)
        shift = np.repeat(self.ends[which] - out.ends, n_pairs)
        out.pairs = self.pairs[shift + np.arange(len(shift))]
        out.uses = self.uses[which] // 2
        return out

    def frequent(self, n: int) -> _Words:
        """The n words that were used most, of those that were used again."""
        again = np.flatnonzero(self.uses > 1)
        best = again[np.argsort(-self.uses[again], kind="stable")[:n]]
        return self.picked(np.sort(best))


class Aligner:
    """Tokens, groups and links of texts by two tokenizer files."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        import tokenizers

        spec = json.loads(a_file)
        before = spec["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("A has to be a byte-level tokenizer without normalizer")
        self._a_long = tokenizers.Tokenizer.from_str(a_file.decode("utf-8"))
        self._a_long.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self._a_bytes = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for entry, i in spec["model"]["vocab"].items():
            if all(c in byte_of for c in entry):
                self._a_bytes[i] = bytes(byte_of[c] for c in entry)
        # where ids rise with the ranks of merges, merging by least id is merging by rank,
        # which this library does several times as fast
        made = [
            spec["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))]
            for m in spec["model"]["merges"]
        ]
        if any(x >= y for x, y in zip(made, made[1:], strict=False)):
            raise ValueError("A's ids have to rise with its merges")
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {b: i for i, b in enumerate(self._a_bytes) if b and i not in special}
        self._a = tiktoken.Encoding(
            "A", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}
        )
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self._b_bytes = [self._piece_bytes(i) for i in range(self._b.get_piece_size())]
        self._space = self._b.piece_to_id(SPACE_SIGN)
        # pieces hold no breaking white space but spaces at their beginning
        inner = regex.compile(rf"(?V1)[^ ] |.[{_BREAK}-- ]|[{_BREAK}-- ].", regex.DOTALL)
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i).replace(SPACE_SIGN, " ")
            if inner.search(piece):
                raise ValueError(f"piece {i} of B reaches across the end of a word")
        self._a_size = np.array(list(map(len, self._a_bytes)))
        self._b_size = np.array(list(map(len, self._b_bytes)))
        # ids as text with what follows them: in a group, at its end, at the end of a word
        self._written = [f"{i}{end}" for end in ",|" for i in range(len(self._a_bytes))]
        self._written += [f"{i}{end}" for end in ",;\n" for i in range(len(self._b_bytes))]
        self._words = _Words()

    def _piece_bytes(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self._b.is_control(i) or self._b.is_unknown(i):
            return b""
        return piece.replace(SPACE_SIGN, " ").encode()

    def _b_ids(self, text: str) -> list[int]:
        """B's ids of a text with the white space before it. The library adds a space: where
        the text has none, it is a token of its own, as white space cuts, and is taken off."""
        if text == " ":
            return [self._space]
        if text[0] == " ":
            return self._b.encode(text[1:])
        ids = self._b.encode(text)
        if ids[0] != self._space:
            raise ValueError("B joins its own space with other white space")
        return ids[1:]

    def _a_ids(self, text: str) -> list[int]:
        if len(text) > LONG_LETTERS and not _CUT.search(text, 0, LONG_LETTERS):
            # one very long word, for which this library takes no quadratic time
            return self._a_long.encode(text, add_special_tokens=False).ids
        return self._a.encode_ordinary(text)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words by A and B, one after the other; None if their bytes are others.

        Words are encoded side by side, as both end a token where a word ends. White space
        would go on into the next word, and very long words are left to themselves."""
        runs: list[list[str]] = [[]]
        for word in words:
            if word[-1].isspace() or len(word) > LONG_LETTERS:
                runs += [[word], []]
            else:
                runs[-1].append(word)
        texts_ = ["".join(run) for run in runs if run]
        a = [i for text in texts_ for i in self._a_ids(text)]
        b = [i for text in texts_ for i in self._b_ids(text)]
        raw = "".join(words).encode("utf-8", "replace")
        if b"".join(map(self._a_bytes.__getitem__, a)) != raw:
            return None
        if b"".join(map(self._b_bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def _tokens(self, words: list[str]) -> tuple:
        """What ``_Words`` keeps of words, all aligned as one run of bytes."""
        # B writes its space sign as a space, so such a word is not given back
        same_bytes = np.array([SPACE_SIGN not in w for w in words], dtype=bool)
        found = self._ids([w for w, same in zip(words, same_bytes, strict=True) if same])
        if found is None:
            same_bytes &= np.array([self._ids([w]) is not None for w in words], dtype=bool)
            found = self._ids([w for w, same in zip(words, same_bytes, strict=True) if same])
        picked = np.flatnonzero(same_bytes)
        sizes = [len(words[k].encode("utf-8", "replace")) for k in picked.tolist()]
        ids_a, ids_b = found
        ends_a, ends_b = np.cumsum(self._a_size[ids_a]), np.cumsum(self._b_size[ids_b])
        word_ends = np.cumsum(sizes, dtype=np.int64)
        # each end closes one link, and the ends of both close a group
        ends, cuts = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        pairs = ids_a[np.searchsorted(ends_a, ends)] * len(self._b_bytes)
        pairs = pairs + ids_b[np.searchsorted(ends_b, ends)]

        def by_word(places: np.ndarray) -> np.ndarray:
            out = np.zeros(len(words), dtype=np.int64)
            out[picked] = np.diff(np.searchsorted(places, word_ends, side="right"), prepend=0)
            return out

        numbers = np.stack([by_word(ends_a), by_word(ends_b), by_word(cuts)], axis=1)
        # ids as text in the order of groups, A's before B's
        at_a, at_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        last_a = cuts[at_a] == ends_a if len(cuts) else np.zeros(0, dtype=bool)
        last_b = (cuts[at_b] == ends_b if len(cuts) else np.zeros(0, dtype=bool)).astype(np.int64)
        last_b[np.searchsorted(ends_b, word_ends)] += 1
        order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        n_a = np.searchsorted(at_a, np.arange(len(cuts)), side="right")  # up to each cut
        n_b = np.searchsorted(at_b, np.arange(len(cuts)), side="right")
        before_b = np.concatenate(([0], n_b))[at_a]
        order[np.arange(len(ids_a)) + before_b] = ids_a + len(self._a_bytes) * last_a
        order[np.arange(len(ids_b)) + n_a[at_b]] = (
            ids_b + 2 * len(self._a_bytes) + len(self._b_bytes) * last_b
        )
        written = "".join(map(self._written.__getitem__, order.tolist())).split("\n")
        groups = [""] * len(words)
        for k, text in zip(picked.tolist(), written, strict=False):
            groups[k] = text
        return groups, numbers, same_bytes, pairs, np.cumsum(by_word(ends))

    def close(self, units: list[str]) -> Closed:
        """All groups of texts that begin and end with a cut."""
        split = [_WORDS.findall(u) for u in units]
        flat = [w for words in split for w in words]
        kept = self._words
        place = kept.place
        missing = [w for w in set(flat) if w not in place]
        if len(place) + len(missing) > KEPT_WORDS:
            kept = self._words = kept.frequent(KEPT_WORDS // 2)
            place = kept.place
            missing = [w for w in set(flat) if w not in place]
        # long words come last: they are seldom met again and are let go after the batch
        missing.sort(key=lambda w: len(w) > KEPT_LETTERS)
        if missing:
            kept.add(missing, self._tokens(missing))
        at = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
        kept.uses += np.bincount(at, minlength=len(kept.uses))
        sizes = np.array([len(words) for words in split], dtype=np.int64)
        unit = np.repeat(np.arange(len(units)), sizes)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(unit, weights=values, minlength=len(units)).astype(np.int64)

        numbers = [summed(kept.numbers[at, k]) for k in range(3)]
        broken = summed(~kept.same_bytes[at]) > 0
        written, groups, begin = list(map(kept.groups.__getitem__, at.tolist())), [], 0
        for size in sizes.tolist():
            groups.append(";".join(written[begin : begin + size]))
            begin += size
        n_pairs = np.diff(kept.ends, prepend=0)[at]
        total = np.cumsum(n_pairs)
        shift = (kept.ends[at] - total) if len(at) else total
        pairs = kept.pairs[np.repeat(shift, n_pairs) + np.arange(total[-1] if len(at) else 0)]
        span = len(self._a_bytes) * len(self._b_bytes)
        keys, times = np.unique(np.repeat(unit, n_pairs) * span + pairs, return_counts=True)
        offsets = np.searchsorted(keys, np.arange(len(units) + 1) * span)
        codes = keys % span
        if missing and len(missing[-1]) > KEPT_LETTERS:
            kept.drop_last(sum(len(w) > KEPT_LETTERS for w in missing))
        return Closed(
            *numbers,
            ~broken,
            groups,
            offsets,
            codes // len(self._b_bytes),
            codes % len(self._b_bytes),
            times,
        )


@dataclass(frozen=True)
class Fragment:
    """Open bytes at either end; `at` is the last range with a cut, -1 if there is none,
    and then all bytes are the prefix."""

    prefix: bytes
    suffix: bytes
    at: int = -1


def fragment(raw: bytes, place: int) -> tuple[Fragment, bytes]:
    """The fragment of a byte range and the closed middle of it."""
    # a range begins and ends between characters
    text = raw.decode("utf-8")
    first = _CUT.search(text)
    if first is None:
        return Fragment(raw, b""), b""
    last = _LAST_CUT.search(text)
    lo, hi = first.start(), last.start()
    return Fragment(text[:lo].encode(), text[hi:].encode(), place), text[lo:hi].encode()


def composed(left: Fragment, right: Fragment) -> tuple[Fragment, bytes]:
    """Both as one, and the bytes that their meeting closes."""
    meeting = left.suffix + right.prefix
    if left.at < 0 and right.at < 0:
        return Fragment(left.prefix + right.prefix, b""), b""
    if left.at < 0:
        # a cut may lie where the two meet; it is found when the prefix is closed
        return Fragment(left.prefix + right.prefix, right.suffix, right.at), b""
    if right.at < 0:
        return Fragment(left.prefix, meeting, left.at), b""
    return Fragment(left.prefix, right.suffix, right.at), meeting


def ranges(raw: bytes, size: int) -> Iterator[bytes]:
    """The bytes in ranges of about `size`, which end between characters."""
    at = 0
    while at < len(raw):
        end = min(at + size, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        yield raw[at:end]
        at = end


_ALIGNERS: dict[bytes, Aligner] = {}


def _aligner(a_file: bytes, b_file: bytes) -> Aligner:
    """One per Python worker; the tokens it keeps serve later tasks, too."""
    key = hashlib.sha256(a_file + b_file).digest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(a_file, b_file)
    return _ALIGNERS[key]


_CLOSED = (
    "row long, doc_id long, place long, n_a long, n_b long, n_groups long, same_bytes boolean, "
    "groups string, a array<int>, b array<int>, times array<int>"
)
_OPEN = "prefix binary, suffix binary, at long"
Rows = Iterator[dict[str, Any]]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest() if text else ""


def _int_lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32), pa.int32())
    )


def _batch(target: pa.Schema, n: int, columns: dict[str, Any]) -> pa.RecordBatch:
    """A batch of n rows; columns that are not given are NULL."""
    arrays = []
    for field in target:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(n, field.type))
        elif isinstance(values, pa.Array):
            arrays.append(values)
        else:
            arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def _closed_batch(
    target: pa.Schema, aligner: Aligner, rows: list[tuple], units: list[str], more: dict[str, list]
) -> pa.RecordBatch:
    """Closed groups of units, whose (row, doc_id, place) are given; further columns."""
    found = aligner.close(units)
    named = dict(zip(("row", "doc_id", "place"), map(list, zip(*rows, strict=True)), strict=True))
    columns = named | {
        "n_a": found.n_a,
        "n_b": found.n_b,
        "n_groups": found.n_groups,
        "same_bytes": found.same_bytes,
        "groups": found.groups,
        "a": _int_lists(found.offsets, found.a),
        "b": _int_lists(found.offsets, found.b),
        "times": _int_lists(found.offsets, found.times),
    }
    return _batch(target, len(units), columns | more)


def _mapped(
    df: DataFrame, schema: str, start: Callable[[pa.Schema], Callable[[Rows], Iterator[pa.RecordBatch]]]
) -> DataFrame:
    """A generator of batches over the rows of a partition."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from start(target)(row for batch in batches for row in batch.to_pylist())

    return df.mapInArrow(run, schema)


def _some(rows: Rows, size_of: Callable[[dict[str, Any]], int]) -> Iterator[list[dict[str, Any]]]:
    """Rows in lists of about BATCH_BYTES, so that words are looked up for many at once."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row) + 64
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _first_pass(docs: DataFrame, files: Any, range_bytes: int) -> DataFrame:
    """Closed rows of texts of one range (place NULL: done, groups hashed), and the ranges
    of longer ones (raw, place), which other tasks take up."""

    def start(target: pa.Schema) -> Callable[[Rows], Iterator[pa.RecordBatch]]:
        aligner = _aligner(*files.value)
        partition = TaskContext.get().partitionId()

        def run(rows: Rows) -> Iterator[pa.RecordBatch]:
            number = partition << 33
            for some in _some(rows, lambda r: len(r["text"])):
                named, units = [], []
                for row in some:
                    number += 1
                    text = row["text"]
                    raw = (" " + text).encode("utf-8", "replace") if text else b""
                    if len(raw) <= range_bytes:
                        named.append((number, row["doc_id"], None))
                        units.append(raw.decode())
                        continue
                    # a long text's ranges are sent on in parts, not all at once
                    places = enumerate(ranges(raw, range_bytes))
                    while parts := [p for _, p in zip(range(64), places, strict=False)]:
                        columns = {
                            "row": [number] * len(parts),
                            "doc_id": [row["doc_id"]] * len(parts),
                            "place": [p for p, _ in parts],
                            "raw": [part for _, part in parts],
                        }
                        yield _batch(target, len(parts), columns)
                if not units:
                    continue
                done = _closed_batch(target, aligner, named, units, {})
                yield _finished(done)

        return run

    return _mapped(texts(docs), f"{_CLOSED}, raw binary", start)


def _finished(closed: pa.RecordBatch) -> pa.RecordBatch:
    """Whole texts: groups hashed; what does not give back its bytes has no tokens."""
    good = closed.column("same_bytes").to_pylist()
    groups = closed.column("groups").to_pylist()
    columns = {name: closed.column(name) for name in closed.schema.names}
    columns["groups"] = [_sha(g) if ok else "" for g, ok in zip(groups, good, strict=True)]
    if not all(good):
        for name in ("n_a", "n_b", "n_groups", "a", "b", "times"):
            nothing = [] if name in ("a", "b", "times") else 0
            values = closed.column(name).to_pylist()
            columns[name] = [v if ok else nothing for v, ok in zip(values, good, strict=True)]
    return _batch(closed.schema, closed.num_rows, columns)


def _fragments(ranged: DataFrame, files: Any) -> DataFrame:
    """Per range its fragment (prefix, suffix, at) with the closed groups of its middle."""

    def start(target: pa.Schema) -> Callable[[Rows], Iterator[pa.RecordBatch]]:
        aligner = _aligner(*files.value)

        def run(rows: Rows) -> Iterator[pa.RecordBatch]:
            for some in _some(rows, lambda r: len(r["raw"])):
                made = [fragment(r["raw"], r["place"]) for r in some]
                # closed groups stand at even places, what meetings close at odd ones
                named = [(r["row"], r["doc_id"], 2 * r["place"]) for r in some]
                more = {name: [getattr(f, name) for f, _ in made] for name in ("prefix", "suffix", "at")}
                units = [middle.decode() for _, middle in made]
                yield _closed_batch(target, aligner, named, units, more)

        return run

    return _mapped(ranged, f"{_CLOSED}, {_OPEN}", start)


def _composed_once(level: DataFrame, files: Any, last: bool) -> DataFrame:
    """Runs of FAN neighbouring fragments as one. A row with `suffix` is the fragment, the
    others hold what was closed; on the last level the outer ends are closed, too."""

    def start(target: pa.Schema) -> Callable[[Rows], Iterator[pa.RecordBatch]]:
        aligner = _aligner(*files.value)

        def composed_runs(rows: Rows) -> Iterator[tuple[dict[str, Any], int, bytes | Fragment]]:
            for _, run_ in groupby(rows, key=lambda r: (r["row"], r["place"] // FAN)):
                whole: Fragment | None = None
                for row in run_:
                    part = Fragment(row["prefix"], row["suffix"], row["at"])
                    if whole is None:
                        whole = part
                        continue
                    before = whole.at
                    whole, meeting = composed(whole, part)
                    yield row, 2 * before + 1, meeting
                if last:
                    yield row, -1, whole.prefix
                    yield row, 2 * whole.at + 1, whole.suffix
                else:
                    yield row, row["place"] // FAN, whole

        def run(rows: Rows) -> Iterator[pa.RecordBatch]:
            named, units, size = [], [], 0
            open_: dict[str, list] = {}

            def flushed() -> Iterator[pa.RecordBatch]:
                if units:
                    yield _closed_batch(target, aligner, named, units, {})
                if open_:
                    yield _batch(target, len(open_["row"]), open_)

            for row, place, found in composed_runs(rows):
                if isinstance(found, bytes):
                    if found:
                        named.append((row["row"], row["doc_id"], place))
                        units.append(found.decode())
                        size += len(found)
                else:
                    values = {"row": row["row"], "doc_id": row["doc_id"], "place": place} | vars(found)
                    for name, value in values.items():
                        open_.setdefault(name, []).append(value)
                    size += len(found.prefix) + len(found.suffix)
                if size >= BATCH_BYTES:
                    yield from flushed()
                    named, units, open_, size = [], [], {}, 0
            yield from flushed()

        return run

    rows = level.withColumn("run", F.floor(F.col("place") / FAN)).repartition("row", "run")
    rows = rows.sortWithinPartitions("row", "place").drop("run")
    return _mapped(rows, f"{_CLOSED}, {_OPEN}", start)


def _long_texts(ranged: DataFrame, files: Any) -> list[DataFrame]:
    """Tables of closed rows of the texts that are cut into ranges."""
    n_places = (ranged.agg(F.max("place")).first()[0] or 0) + 1
    fragments = materialise(_fragments(ranged.repartition("row", "place"), files), "fragments")
    names = [f.name for f in StructType.fromDDL(_CLOSED)]
    tables = [fragments.select(*names)]
    level = fragments.withColumn("place", F.floor(F.col("place") / 2)).select(
        "row", "doc_id", "place", "prefix", "suffix", "at"
    )
    while True:
        last = n_places <= FAN
        made = materialise(_composed_once(level, files, last), "composed")
        tables.append(made.where(F.col("suffix").isNull()).select(*names))
        if last:
            return tables
        level = made.where(F.col("suffix").isNotNull()).select(*level.columns)
        n_places = -(-n_places // FAN)


def _hashed_in_order(closed: DataFrame) -> DataFrame:
    """row, groups_sha256: groups of a text, as they follow each other, without joining them."""

    def start(target: pa.Schema) -> Callable[[Rows], Iterator[pa.RecordBatch]]:
        def run(rows: Rows) -> Iterator[pa.RecordBatch]:
            for row, parts in groupby(rows, key=lambda r: r["row"]):
                digest, begun = hashlib.sha256(), False
                for part in parts:
                    if part["groups"]:
                        digest.update((";" if begun else "").encode() + part["groups"].encode())
                        begun = True
                sha = digest.hexdigest() if begun else ""
                yield _batch(target, 1, {"row": [row], "groups_sha256": [sha]})

        return run

    rows = closed.select("row", "place", "groups").repartition("row")
    return _mapped(
        rows.sortWithinPartitions("row", "place"), "row long, groups_sha256 string", start
    )


def pair_counts(linked: DataFrame) -> DataFrame:
    """a, b, n (links over the corpus), best (no other a has more links with b)."""
    pairs = linked.select(F.inline(F.arrays_zip("a", "b", "times")))
    counts = materialise(pairs.groupBy("a", "b").agg(F.sum("times").alias("n")), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent_from(counts: DataFrame, limit: int) -> int:
    """Least power of two such that no more than `limit` pairs have as many links."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, start = 0, 63
    for row in sorted(sizes, key=lambda r: -r["power"]):  # 63 rows at most
        total += row["n"]
        if total > limit:
            break
        start = row["power"]
    return 1 << start if start < 63 else (1 << 63) - 1


def _link_sums(linked: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """row, n_links, n_best, count_sum."""
    spark = linked.sparkSession
    limit = _frequent_from(counts, frequent)
    common = counts.where(F.col("n") >= limit).toArrow()  # `frequent` rows at most
    key = (common["a"].to_numpy().astype(np.int64) << 32) | common["b"].to_numpy().astype(np.int64)
    order = np.argsort(key)
    sent = spark.sparkContext.broadcast(
        (key[order], common["n"].to_numpy()[order], common["best"].to_numpy()[order])
    )

    schema = (
        "row long, n_links long, n_best long, count_sum long, "
        "a array<int>, b array<int>, times array<int>"
    )
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ns, bests = sent.value
        for batch in batches:
            lists = [batch.column(c) for c in ("a", "b", "times")]
            a, b, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            sizes = np.diff(lists[0].offsets.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), sizes)
            asked = (a << 32) | b
            known = np.zeros(len(asked), dtype=bool)
            n, best = np.zeros(len(asked), dtype=np.int64), known
            if len(keys) and len(asked):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                known = keys[at] == asked
                n, best = np.where(known, ns[at], 0), known & bests[at]

            def summed(values: np.ndarray, of: np.ndarray = of, rows: int = batch.num_rows) -> np.ndarray:
                out = np.zeros(rows, dtype=np.int64)
                np.add.at(out, of, values)
                return out

            rest = np.flatnonzero(~known)
            offsets = np.searchsorted(of[rest], np.arange(batch.num_rows + 1))
            columns = {
                "row": batch.column("row"),
                "n_links": summed(times),
                "n_best": summed(times * best),
                "count_sum": summed(times * n),
                "a": _int_lists(offsets, a[rest]),
                "b": _int_lists(offsets, b[rest]),
                "times": _int_lists(offsets, times[rest]),
            }
            yield _batch(target, batch.num_rows, columns)

    sums = materialise(linked.select("row", "a", "b", "times").mapInArrow(run, schema), "sums")
    rest = sums.select("row", F.inline(F.arrays_zip("a", "b", "times")))
    rest = rest.join(counts.where(F.col("n") < limit), ["a", "b"]).select(
        "row",
        F.lit(0).cast("long").alias("n_links"),
        F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    return sums.drop("a", "b", "times").unionByName(rest).groupBy("row").agg(
        *[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")]
    )


def align_tokenizers(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    frequent: int = FREQUENT_PAIRS,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document.

    A NULL or empty text, and one that either tokenizer does not give back byte by byte
    (a text with B's space sign), has no tokens: numbers are 0, the hash is '' and it adds
    no links to the corpus. Repeated rows and rows with an equal or NULL doc_id are
    documents of their own. An empty table gives an empty one; further columns are
    ignored. The files are read on the driver and sent to the tasks.
    """
    spark = prepare(docs.sparkSession)
    with open(a_path, "rb") as a_file, open(b_path, "rb") as b_file:
        files = spark.sparkContext.broadcast((a_file.read(), b_file.read()))
    first = materialise(_first_pass(docs, files, range_bytes), "aligned")
    short = first.where(F.col("raw").isNull()).drop("raw")
    ranged = first.where(F.col("raw").isNotNull()).select("row", "doc_id", "place", "raw")
    closed = None
    if not ranged.isEmpty():
        for table in _long_texts(ranged, files):
            closed = table if closed is None else closed.unionByName(table)
    whole = short.select("row", "doc_id", "n_a", "n_b", "n_groups", F.col("groups").alias("groups_sha256"))
    linked = short.select("row", "a", "b", "times")
    if closed is not None:
        stats = materialise(
            closed.groupBy("row", "doc_id").agg(
                *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")],
                F.min(F.col("same_bytes")).alias("same_bytes"),
            ),
            "long-texts",
        )
        good = F.col("same_bytes")
        sound = closed.join(stats.where(good).select("row"), "row", "left_semi")
        linked = linked.unionByName(sound.select("row", "a", "b", "times"))
        numbers = [F.when(good, F.col(c)).otherwise(0).alias(c) for c in ("n_a", "n_b", "n_groups")]
        long_rows = stats.select("row", "doc_id", *numbers).join(
            _hashed_in_order(sound), "row", "left"
        )
        whole = whole.unionByName(
            long_rows.withColumn("groups_sha256", F.coalesce("groups_sha256", F.lit("")))
        )
    counts = materialise(pair_counts(linked), "pair-counts")
    sums = _link_sums(linked, counts, frequent)
    zero = F.lit(0).cast("long")
    return whole.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256",
    )
