"""Whole texts to token ids with the tokenizers library, each distinct word encoded once per worker.

Both encoders give the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` as little-endian unsigned 32-bit
integers. They cut texts only where the tokenizer's own pre-tokenizer always cuts, so words can be encoded alone and
remembered. Texts are cut and their words told apart by Arrow, ``CHUNK_BYTES`` of them at a time, so each different
word of a chunk is looked up once and ids are put together as arrays. A word of letters only that normalizing leaves as
it is goes to the tokenizer's model at once. Words of up to ``MEMO_BYTES`` are remembered: when ``MEMO_WORDS`` are new
since the last time, those not met since then go.
"""

from __future__ import annotations

import functools
import os
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_WORDS, MEMO_BYTES = 450_000, 64
CHUNK_BYTES = 2 << 20


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _id_bytes(encoding) -> bytes:
    return array("I", encoding.ids).tobytes()


#: Fixed: ASCII punctuation whose runs the tokenizers' pre-tokenizers part from a letter before them. An apostrophe may
#: begin a contraction, and the others left out a special token.
TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def _parted(word: str) -> tuple[str, str] | None:
    """The word and the punctuation at its end, if that is all it has behind a letter of a Latin alphabet. A letter that
    gets a mark of its own when lowered does not count, as the mark would go with the punctuation."""
    base = word.rstrip(TAIL)
    if len(base) == len(word) or not base or not (base[-1] < "\u0250" and base[-1].lower().isalpha()):
        return None
    return base, word[len(base) :]


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level models have for bytes: printable ones stand for themselves, the others for
    characters from U+0100 on in ascending order."""
    printable = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


_LETTER_OF = _byte_letters()


def _model_text(raw: bytes) -> str:
    return raw.decode() if raw.isalpha() else raw.decode("latin-1").translate(_LETTER_OF)


def _is_word(word: str) -> bool:
    """Letters of Latin alphabets only, which no pre-tokenizer cuts and no normalization but lowering changes."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class _Memo(dict):
    """Ids by word. ``encode`` is asked for words not met yet; words forgotten last are asked of the former memory."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.former: dict = {}

    def __missing__(self, word):
        ids = self.former.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.former = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _chunks(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of up to ``CHUNK_BYTES``, or of one longer text."""
    chunk, held = [], 0
    for text in texts:
        if chunk and held + len(text) > CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
        chunk.append(text)
        held += len(text)
    if chunk:
        yield chunk


def _word_ids(texts: list[bytes], memo: _Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts cut at blanks: all ids in order, how many of them end with each word, and where texts' words begin."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()), " ")
    words = lists.flatten().dictionary_encode()
    known = list(map(memo.__getitem__, words.dictionary.to_numpy(zero_copy_only=False).tolist()))
    sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
    starts, codes = np.cumsum(sizes, dtype=np.int32) - sizes, words.indices.to_numpy()
    n = sizes[codes]
    ends = np.cumsum(n, dtype=np.int32)  # fewer than 2 ** 31, as an Arrow text has fewer bytes
    index = np.repeat(starts[codes] - (ends - n), n) + np.arange(ends[-1], dtype=np.int32)
    return np.frombuffer(b"".join(known), "<u4")[index], ends, lists.offsets.to_numpy()


class WordEncoder:
    """For lower-case tokenizers that drop white space: the words between ASCII white space are independent."""

    #: Fixed: tab to carriage return part words as blanks do.
    BLANKS = bytes(32 if 9 <= c <= 13 else c for c in range(256))

    def __init__(self, path: str):
        self.tokenizer = _load(path)
        self.model = self.tokenizer.model
        self.memo = _Memo(self._word)

    def _word(self, raw: bytes) -> bytes:
        if not raw:
            return b""
        if raw.isalpha() and raw.islower():  # letters of ASCII
            return array("I", [token.id for token in self.model.tokenize(raw.decode())]).tobytes()
        word = raw.decode("utf-8", "replace")
        if _is_word(word) and word == word.lower():
            return array("I", [token.id for token in self.model.tokenize(_model_text(raw))]).tobytes()
        if parts := _parted(word):
            return self.memo[parts[0].encode()] + self.memo[parts[1].encode()]
        return _id_bytes(self.tokenizer.encode(word, add_special_tokens=False))

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        for chunk in _chunks(texts):
            # Special tokens are told by case, all else is not.
            plain = [(t if b"<|" in t else t.lower()).translate(self.BLANKS) for t in chunk]
            ids, ends, offsets = _word_ids(plain, self.memo)
            start = 0
            for end in ends[offsets[1:] - 1].tolist():
                yield ids[start:end].tobytes()
                start = end


class SpacedEncoder:
    """For byte-level tokenizers whose words carry the one blank before them.

    A text is cut before a blank that has a character other than white space on both sides. Other parts, such as
    those around several blanks, go to the tokenizer together with both neighbours.
    """

    def __init__(self, path: str):
        self.tokenizer = _load(path)
        self.model = self.tokenizer.model
        self.blank = _LETTER_OF[ord(" ")]
        self.memo = _Memo(self._part)
        self.alone = _Memo(self._alone)

    def _alone(self, raw: bytes) -> bytes:
        return self._ids(raw, b"", self.alone)

    def _part(self, raw: bytes) -> bytes:
        """The ids of a part with the blank before it; empty if the part has to go with its neighbours."""
        if raw.isalpha():  # letters of ASCII
            tokens = self.model.tokenize(self.blank + raw.decode())
            return array("I", [token.id for token in tokens]).tobytes()
        part = raw.decode("utf-8", "replace")
        if not part or part[0].isspace() or part[-1].isspace():
            return b""
        return self._ids(raw, b" ", self.memo)

    def _ids(self, raw: bytes, before: bytes, memo: _Memo) -> bytes:
        """``memo`` has parts with the same blank or nothing before them. Line feeds that stand alone between other
        characters are pieces of their own."""
        part = raw.decode("utf-8", "replace")
        if _is_word(part):
            text = (self.blank if before else "") + _model_text(raw)
            return array("I", [token.id for token in self.model.tokenize(text)]).tobytes()
        if parts := _parted(part):
            return memo[parts[0].encode()] + self.alone[parts[1].encode()]
        if "\n" in part and part != "\n":
            lines = part.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                rest = (self.alone[x.encode()] for x in lines[1:])
                return self.alone[b"\n"].join((memo[lines[0].encode()], *rest))
        return _id_bytes(self.tokenizer.encode((before + raw).decode("utf-8", "replace"), add_special_tokens=False))

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        for chunk in _chunks(texts):
            ids, ends, offsets = _word_ids(chunk, self.memo)
            bad = np.diff(ends, prepend=0) == 0
            bad[offsets[:-1]] = False  # the first words have no blank before them
            bad = np.add.reduceat(bad, offsets[:-1]) > 0
            rest = zip(ends[offsets[:-1]].tolist(), ends[offsets[1:] - 1].tolist(), bad.tolist())
            for raw, (start, end, gaps) in zip(chunk, rest):
                first = raw.partition(b" ")[0]
                if not raw:
                    yield b""
                elif gaps or not first or first.decode("utf-8", "replace")[-1].isspace():
                    yield self._with_gaps(raw.split(b" "))
                else:
                    yield self.alone[first] + ids[start:end].tobytes()

    def _with_gaps(self, parts: list[bytes]) -> bytes:
        """A cut is made between two parts that both have other characters than white space at the cut."""
        known = [self.memo[part] for part in parts]
        whole = [*map(bool, known)]
        whole[0] = parts[0] != b"" and not parts[0].decode("utf-8", "replace")[-1].isspace()
        cuts = [0, *(k for k in range(1, len(parts)) if whole[k] and whole[k - 1]), len(parts)]
        out = []
        for start, end in zip(cuts, cuts[1:]):
            if end - start == 1 and start and known[start]:
                out.append(known[start])
            else:
                out.append(self._alone((b"" if start == 0 else b" ") + b" ".join(parts[start:end])))
        return b"".join(out)


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@functools.cache
def spaced_encoder(path: str) -> SpacedEncoder:
    return SpacedEncoder(path)
