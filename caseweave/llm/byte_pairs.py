"""Token counts of byte-level BPE vocabularies without emitting ids.

A text is cut at the special tokens and by the pre-tokenizer's pattern. A word's
tokens are its bytes less its merges: neighbouring pairs wait in a heap by merge
rank, symbols are a linked list, and the lowest rank is popped until none is left.
A word of n bytes takes n log n steps, so one word of any length is no problem.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame

from caseweave.llm.common import Columns, map_columns, texts
from caseweave.llm.memo import Memo

CONTEXT_TOKENS = 1024

# Fixed value: the pattern of byte-level pre-tokenizers. White space is the Unicode
# property, which leaves out the separators U+001C to U+001F.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[int, str]:
    """Letter that stands for each byte: itself where it is a printable Latin-1
    character, else the next code point from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class PairCounter:
    """Counts tokens by a tokenizer file (byte-level BPE, JSON)."""

    def __init__(self, tokenizer: bytes) -> None:
        spec = json.loads(tokenizer)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if (
            model["type"] != "BPE"
            or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or spec.get("normalizer")
            or model.get("dropout")
            or model.get("ignore_merges")
        ):
            raise ValueError("only plain byte-level BPE tokenizers are supported")
        vocabulary = model["vocab"]
        self._first = {b: vocabulary[letter] for b, letter in byte_letters().items()}
        self._merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self._merge[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._words = regex.compile(PRE_TOKENS)
        self._counts = Memo(400_000)

    def word_tokens(self, word: str) -> int:
        """Initial symbols less merges."""
        symbols = [self._first[b] for b in word.encode("utf-8", "replace")]
        merge = self._merge
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []
        for left in range(n - 1):
            found = merge.get((symbols[left], symbols[left + 1]))
            if found is not None:
                queue.append((found[0], left, symbols[left], symbols[left + 1], found[1]))
        heapq.heapify(queue)
        merges = 0
        while queue:
            _, left, a, b, joined = heapq.heappop(queue)
            right = after[left]
            # a pair that an earlier merge took a side of is out of date
            if right >= n or symbols[left] != a or symbols[right] != b:
                continue
            merges += 1
            symbols[left], symbols[right] = joined, -1
            follower = after[left] = after[right]
            after[right] = n
            if follower < n:
                before[follower] = left
                found = merge.get((joined, symbols[follower]))
                if found is not None:
                    heapq.heappush(
                        queue, (found[0], left, joined, symbols[follower], found[1])
                    )
            leader = before[left]
            if leader >= 0:
                found = merge.get((symbols[leader], joined))
                if found is not None:
                    heapq.heappush(queue, (found[0], leader, symbols[leader], joined, found[1]))
        return n - merges

    def count(self, text: str) -> int:
        """Tokens of the whole text; a special string in it is one token."""
        total = 0
        get, put = self._counts.get, self._counts.put
        parts = [text]
        if self._special is not None and self._special.search(text):
            parts = self._special.split(text)
            total = len(parts) - 1
        for part in parts:
            for word in self._words.findall(part):
                found = get(word)
                if found is None:
                    found = self.word_tokens(word)
                    put(word, found)
                total += found
        return total


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = CONTEXT_TOKENS
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens) per document.

    A NULL or empty text has no tokens. Repeated rows are counted each. The file is
    read on the driver and sent to the tasks.
    """
    with open(tokenizer_path, "rb") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())

    def start() -> Callable[[Columns], Columns]:
        counter = _counter(tokenizer.value)

        def run(batch: Columns) -> Columns:
            counts = [counter.count(text) for text in batch["text"]]
            return {
                "doc_id": batch["doc_id"],
                "n_bytes": [len(t.encode("utf-8", "replace")) for t in batch["text"]],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

        return run

    return map_columns(
        texts(docs), start, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


_COUNTERS: dict[bytes, PairCounter] = {}


def _counter(tokenizer: bytes) -> PairCounter:
    """One counter per Python worker; what it keeps serves later tasks, too."""
    key = hashlib.sha256(tokenizer).digest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PairCounter(tokenizer)
    return _COUNTERS[key]
