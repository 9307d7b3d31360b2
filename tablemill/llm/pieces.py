"""SentencePiece encoding and decoding with a forward table shared by words of a common prefix.

The texts of a batch are cut into marked words (a run of word marks and what follows it), which no piece crosses. The
distinct ones not met before are sorted, which lays them out as a trie in depth-first order, and the forward table of a
word is that of the word before it up to their common prefix.

The table holds, for each prefix, the score of its encoding so far and its last piece. In a model of unigram type the
best score decides; of encodings with one score up to rounding the library may take another, as it adds over the
whole text. In a model of BPE type scores are ranks of merges and their sum decides nothing: there the last
piece is the one that BPE would leave beside the last piece of the prefix before it. There is exactly one, so the ids
are those of the SentencePiece library. The pieces that end a prefix come from an automaton over the beginnings of all
pieces (Aho and Corasick), so no others are tried.
"""

from __future__ import annotations

import functools
import heapq
import re
from array import array
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from tablemill.llm.common import binary_column, keyed

MARK = "▁"
MEMO_WORDS = 400_000
MEMO_PAIRS = 400_000
#: Steps of the automaton that are remembered.
MEMO_STEPS = 200_000
#: So many texts are taken together; their distinct words are sorted together.
BATCH_ROWS = 512

# Fixed values of the model file's format: kinds of piece and of model.
NORMAL, BYTE = 1, 6
UNIGRAM, BPE = 1, 2
# Fixed: how much worse than the worst piece a character is that no piece has.
UNKNOWN_PENALTY = 10.0

_LEAF = -1
_BREAK = -1  # stands for the last piece behind a character that no piece has


class PieceModel:
    """A model with byte fallback and without a normalizer, read from its file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind, spec = model.trainer_spec, model.normalizer_spec
        if kind.model_type not in (UNIGRAM, BPE) or not kind.byte_fallback:
            raise ValueError("a unigram or BPE model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("a model without text normalization is needed")
        self.prefix = spec.add_dummy_prefix
        self.by_rank = kind.model_type == BPE
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = [p.score for p in model.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.plain = [p.piece for p in model.pieces]
        self.unknown = min(p.score for p in model.pieces if p.type == NORMAL) - UNKNOWN_PENALTY
        self.output = [self._output(p) for p in model.pieces]
        self.memo: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.states = {"": 0}
        for piece in self.ids:
            for end in range(1, len(piece) + 1):
                self.states.setdefault(piece[:end], len(self.states))
        self.begun = list(self.states)
        self.steps: dict[tuple[int, str], int] = {}
        self.ends: list[tuple[tuple[int, int], ...] | None] = [None] * len(self.begun)

    @staticmethod
    def _output(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return piece.piece.replace(MARK, " ").encode() if piece.type == NORMAL else b""

    # Encoding

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._words(text) for text in texts]
        new = set().union(*cut).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = set().union(*cut)
        self._encode_sorted(sorted(new))
        return [b"".join(map(self.memo.__getitem__, words)) for words in cut]

    def _words(self, text: str) -> list[str]:
        """The marked words without their first mark."""
        if not text:
            return []
        if not self.prefix:
            raise NotImplementedError("models without a mark before the text")
        words = text.split(" ")
        if "" not in words and MARK not in text:
            return words
        return re.findall(f"{MARK}({MARK}*[^{MARK}]*)", MARK + text.replace(" ", MARK))

    def _encode_sorted(self, words: list[str]) -> None:
        """Depth-first over the trie of the words; ``table[i]`` is (score, last piece, its length, state of the automaton)
        of i characters."""
        before, table, last = "", [(0.0, _BREAK, 0, 0)], self._last
        for word in words:
            marked = MARK + word
            if self.by_rank and word.startswith(MARK):
                self.memo[word] = self._bytes(self._merged(marked))
                continue
            same, most = 0, min(len(marked), len(before))
            while same < most and marked[same] == before[same]:
                same += 1
            del table[same + 1 :]
            for end in range(len(table), len(marked) + 1):
                table.append(last(marked[end - 1], table))
            before = marked
            ids: list[int] = []
            end = len(marked)
            while end:
                _, piece, length, _ = table[end]
                ids.extend([piece] if piece != _BREAK else self._fallback(marked[end - 1])[::-1])
                end -= length
            self.memo[word] = array("I", ids[::-1]).tobytes()

    def _last(self, character: str, table: list) -> tuple[float, int, int, int]:
        """The table's next entry, for one character more."""
        scores, pairs, size = self.scores, self.pairs, len(table)
        key = table[-1][3], character
        state = self.steps.get(key)
        if state is None:
            state = self._step(key)
        ends = self.ends[state]
        if ends is None:
            ends = self._ends(state)
        best = None
        for piece, length in ends:
            score, left, _, _ = table[size - length]
            if self.by_rank:
                stands = pairs.get(left << 32 | piece)
                if stands or stands is None and self._stands(left, piece):
                    return score + scores[piece], piece, length, state
            elif best is None or score + scores[piece] > best[0]:
                best = score + scores[piece], piece, length, state
        if best is None or not self.by_rank and character not in self.ids:
            unknown = table[-1][0] + self.unknown
            if best is None or unknown > best[0]:
                best = unknown, _BREAK, 1, state
        return best

    def _step(self, key: tuple[int, str]) -> int:
        """The state behind one character more: the longest end of what was read that begins a piece."""
        text = self.begun[key[0]] + key[1]
        while text not in self.states:
            text = text[1:]
        if len(self.steps) >= MEMO_STEPS:
            self.steps.clear()
        state = self.steps[key] = self.states[text]
        return state

    def _ends(self, state: int) -> tuple[tuple[int, int], ...]:
        """The pieces that end what was read, longest first, with their lengths."""
        text, n = self.begun[state], len(self.begun[state])
        found = ((self.ids.get(text[start:]), n - start) for start in range(n))
        ends = self.ends[state] = tuple((piece, length) for piece, length in found if piece is not None)
        return ends

    def _fallback(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode("utf-8", "replace")]

    def _stands(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two pieces side by side, with nothing before them that matters."""
        found = self._split(right) is not None and (left == _BREAK or self._stands_unknown(left, right))
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        self.pairs[left << 32 | right] = found
        return found

    def _stands_unknown(self, left: int, right: int) -> bool:
        """Takes merges of both pieces back, the later ones first, and looks whether a merge across the border would
        have come before them. Of equal merges the leftmost comes first."""
        limit = None  # the border's merge has to come before this (score, side)
        while True:
            across = self.ids.get(self.plain[left] + self.plain[right])
            if across is not None and (limit is None or (-self.scores[across], 1) < limit):
                return False
            left_parts, right_parts = self._split(left), self._split(right)
            left_leaf, right_leaf = left_parts[0] == _LEAF, right_parts[0] == _LEAF
            if left_leaf and right_leaf:
                return True
            if right_leaf or not left_leaf and self.scores[left] < self.scores[right]:
                limit, left = (-self.scores[left], 0), left_parts[1]
            else:
                limit, right = (-self.scores[right], 2), right_parts[0]

    def _split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces that BPE merges last to make this one; leaves for one character; None if it never does."""
        if piece not in self.splits:
            text = self.plain[piece]
            found: tuple[int, int] | None = (_LEAF, _LEAF)
            if len(text) > 1:
                merged = self._merged(text, keep=2)
                found = (merged[0], merged[1]) if len(merged) == 2 and self._merged(text) == [piece] else None
            self.splits[piece] = found
        return self.splits[piece]

    def _merged(self, text: str, keep: int = 1) -> list[int]:
        """BPE by its definition: the best-scored pair is merged, the leftmost of equals, down to ``keep`` symbols.
        A heap has the pairs; one whose symbols have changed since is passed over."""
        symbols: list[str] = list(text)
        left, n = len(symbols), len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                both = symbols[i] + symbols[after[i]]
                piece = self.ids.get(both)
                if piece is not None:
                    heapq.heappush(heap, (-self.scores[piece], i, both))

        for i in range(n - 1):
            offer(i)
        while left > keep and heap:
            _, i, both = heapq.heappop(heap)
            gone = after[i]
            if gone >= n or not symbols[i] or symbols[i] + symbols[gone] != both:
                continue
            symbols[i], symbols[gone], after[i] = both, "", after[gone]
            if after[i] < n:
                before[after[i]] = i
            left -= 1
            offer(before[i])
            offer(i)
        out: list[int] = []
        for symbol in filter(None, symbols):
            out.extend([self.ids[symbol]] if symbol in self.ids else self._fallback(symbol))
        return out

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    # Decoding

    def decode(self, ids: bytes) -> str:
        """The text of ids. Bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.output.__getitem__, array("I", ids)))
        return raw.decode("utf-8", "replace").removeprefix(" " if self.prefix else "")


@functools.cache
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``text`` and ``ids`` (little-endian unsigned 32-bit integers) for every row; null texts are empty,
    empty texts have no ids. Map-only: words are remembered per worker, so nothing is shuffled. Very long texts and runs
    of blanks cost in proportion to their length (times its logarithm). Rows that repeat come out as often."""

    def run(batches):
        model = piece_model(model_path)
        for part in _slices(batches):
            ids = model.encode([t.decode("utf-8", "replace") for t in binary_column(part, "text")])
            yield pa.record_batch([*part.columns, pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"])

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string, ids binary")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """The rows of :func:`encode_pieces` and ``decoded``, the text that their ids give; null ids give null."""

    def run(batches):
        model = piece_model(model_path)
        for part in _slices(batches):
            texts = [None if ids is None else model.decode(ids) for ids in part.column("ids").to_pylist()]
            yield pa.record_batch(
                [*part.columns, pa.array(texts, pa.string())], names=["doc_id", "text", "ids", "decoded"]
            )

    rows = encoded.select("doc_id", "text", "ids")
    return rows.mapInArrow(run, "doc_id bigint, text string, ids binary, decoded string")
