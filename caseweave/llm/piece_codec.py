"""Piece encoding and decoding as the sentencepiece library does it for BPE models.

A text is cut where no piece of the vocabulary can reach across. For every part,
`last[i]` is the only token that can end an encoding of its first i characters:
among the pieces that end there (found by one automaton pass) it is the one that is
compatible with `last[i - length]`, that is, the two encode to themselves when
written side by side. Ids are then read off backwards from the end. This takes a
number of steps linear in the part's length, however long it is.

Compatibility of two tokens is decided by merging their joined characters, and kept.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from caseweave.llm.common import Columns, map_columns, texts
from caseweave.llm.memo import Memo

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class PieceCodec:
    """Encoder and decoder over the bytes of a model file (BPE with byte fallback)."""

    def __init__(self, model: bytes) -> None:
        proto = model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if (
            proto.trainer_spec.model_type != 2
            or not proto.trainer_spec.byte_fallback
            or spec.precompiled_charsmap
            or spec.remove_extra_whitespaces
            or not spec.add_dummy_prefix
            or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError("only BPE models with byte fallback and plain text are supported")
        self.begin = next(i for i, p in enumerate(proto.pieces) if p.piece == "<s>")
        self.end = next(i for i, p in enumerate(proto.pieces) if p.piece == "</s>")
        normal = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == _NORMAL]
        self._id = {piece: i for i, piece, _ in normal}
        self._score = {piece: score for _, piece, score in normal}
        self._byte_id = {
            int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE
        }
        # what decoding writes: text of normal pieces, one byte of byte pieces, else nothing
        self._surface: list[bytes] = [b""] * len(proto.pieces)
        self._is_byte = bytearray(len(proto.pieces))
        self._leads = bytearray(len(proto.pieces))  # pieces that begin with a space sign
        for i, p in enumerate(proto.pieces):
            if p.type == _NORMAL:
                self._surface[i] = p.piece.replace(SPACE, " ").encode()
                self._leads[i] = p.piece[0] == SPACE
            elif p.type == _BYTE:
                self._surface[i] = bytes([int(p.piece[3:5], 16)])
                self._is_byte[i] = 1
            elif p.type == _UNKNOWN:
                self._surface[i] = proto.trainer_spec.unk_surface.encode()
        self._automaton = ahocorasick.Automaton()
        for piece in self._id:
            self._automaton.add_word(piece, piece)
        self._automaton.make_automaton()
        self._parts = self._splitter()
        self._fits = Memo(400_000)
        self._encoded = Memo(250_000)

    def _splitter(self) -> re.Pattern[str]:
        """Parts that no piece reaches across: characters that occur in no longer piece
        stand alone, and a space sign after another character begins a new part."""
        glue = {c for piece in self._id if len(piece) > 1 for c in piece} - {SPACE}
        if any(SPACE in piece.lstrip(SPACE) for piece in self._id):
            raise ValueError("a piece holds a space sign behind other characters")
        inner = "".join(re.escape(c) for c in sorted(glue))
        return re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|.", re.DOTALL)

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best-scored neighbours, leftmost first."""
        symbols: list[str | None] = list(text)
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right >= 0:
                joined = symbols[left] + symbols[right]
                score = self._score.get(joined)
                if score is not None:
                    heapq.heappush(queue, (-score, left, right, joined))

        for left in range(len(symbols) - 1):
            offer(left)
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            if symbols[left] is None or after[left] != right:
                continue
            if symbols[left] + symbols[right] != joined:
                continue
            symbols[left], symbols[right] = joined, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [s for s in symbols if s is not None]

    def _compatible(self, left: str, right: str) -> bool:
        fits = self._fits.get((left, right))
        if fits is None:
            fits = self._merged(left + right) == [left, right]
            self._fits.put((left, right), fits)
        return fits

    def _part_pieces(self, part: str) -> list[str]:
        """Pieces of one part by the table of last tokens."""
        if part in self._id and self._merged(part) == [part]:
            return [part]
        last: list[str | None] = [None] * (len(part) + 1)
        ends: list[list[str]] = [[] for _ in part]
        for end, piece in self._automaton.iter(part):
            ends[end].append(piece)
        for end, found in enumerate(ends):
            for piece in found:
                begin = end + 1 - len(piece)
                if begin == 0:
                    fits = len(piece) == 1 or self._merged_to_one(piece)
                else:
                    fits = last[begin] is not None and self._compatible(last[begin], piece)
                if fits:
                    last[end + 1] = piece
                    break
            else:
                last[end + 1] = part[end]  # a character without a piece: falls back to bytes
        pieces, end = [], len(part)
        while end:
            pieces.append(last[end])
            end -= len(last[end])
        return pieces[::-1]

    def _merged_to_one(self, piece: str) -> bool:
        fits = self._fits.get(piece)
        if fits is None:
            fits = self._merged(piece) == [piece]
            self._fits.put(piece, fits)
        return fits

    def _part_ids(self, part: str) -> array:
        ids = array("I")
        for piece in self._part_pieces(part):
            known = self._id.get(piece)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self._byte_id[b] for b in piece.encode("utf-8", "replace"))
        return ids

    def encode(self, text: str) -> array:
        """Ids of the whole text, without begin and end ids."""
        ids = array("I")
        if not text:
            return ids
        get, put = self._encoded.get, self._encoded.put
        for part in self._parts.findall(SPACE + text.replace(" ", SPACE)):
            found = get(part)
            if found is None:
                found = self._part_ids(part)
                put(part, found)
            ids += found
        return ids

    def encode_whole(self, text: str) -> array:
        """Ids of the whole text between the begin and the end id."""
        ids = array("I", [self.begin])
        ids += self.encode(text)
        ids.append(self.end)
        return ids

    def decode(self, ids: array | list[int]) -> str:
        """Text of any ids. The first space is the encoder's own; control ids write
        nothing; a byte that is no part of valid UTF-8 becomes U+FFFD."""
        inner = ids[1:-1]
        if self.begin in inner or self.end in inner:  # these end a run of bytes
            return self._decode_runs(ids)
        surface = self._surface
        raw = b"".join([surface[i] for i in ids])
        first = next((i for i in ids if surface[i]), None)
        if first is not None and self._leads[first]:
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_runs(ids)

    def _decode_runs(self, ids: array | list[int]) -> str:
        out: list[str] = []
        run = bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + size]).decode("utf-8"))
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        blank = True
        for i in ids:
            if self._is_byte[i]:
                run += self._surface[i]
                continue
            flush()
            text = self._surface[i].decode("utf-8")
            if self._leads[i] and blank and not any(out):
                text = text[1:]
                blank = False
            out.append(text)
        flush()
        return "".join(out)


def _little_endian(ids: array) -> bytes:
    if array("I", [1]).tobytes()[0] != 1 or array("I").itemsize != 4:
        return b"".join(i.to_bytes(4, "little") for i in ids)
    return ids.tobytes()


def encode_decode(docs: DataFrame, model_path: str, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document; ids and decoded on request.

    Ids have begin and end ids; a NULL or empty text has only these two and decodes to
    the empty text. Repeated rows are encoded each. The model is read once on the
    driver and sent to the tasks, so that executors need no copy of the file.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def start() -> Callable[[Columns], Columns]:
        codec = _codec(model.value)

        def run(batch: Columns) -> Columns:
            ids = [codec.encode_whole(text) for text in batch["text"]]
            decoded = [codec.decode(x) for x in ids]
            out = {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(_little_endian(x)).hexdigest() for x in ids],
                "decoded_sha256": [
                    hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in decoded
                ],
            }
            return out | {"ids": [x.tolist() for x in ids], "decoded": decoded} if with_text else out

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_text:
        schema += ", ids array<long>, decoded string"
    return map_columns(texts(docs), start, schema)


_CODECS: dict[bytes, PieceCodec] = {}


def _codec(model: bytes) -> PieceCodec:
    """One codec per Python worker; it outlives the task, and so does what it keeps."""
    key = hashlib.sha256(model).digest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]
