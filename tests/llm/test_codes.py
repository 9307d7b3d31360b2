"""Token blocks, piece coding and packing against the libraries and brute force."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablemill.llm import encoding, packing, pieces, simple8b
from tablemill.llm.encoding import spaced_encoder, word_encoder

TEXTS = ["A b.  C\n\n d", "", None, "same same", "same same", "é’s <|endoftext|> x", "word " * 9000, " lead", "tail "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string")


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 3), max_size=600))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint64)
    assert (simple8b.unpack(simple8b.pack(ids)) == ids).all()


def test_long_runs_take_few_words():
    assert len(simple8b.pack(np.zeros(24_000, np.uint64))) == 16 + 8 * 100


@pytest.mark.parametrize("make, name", [(spaced_encoder, "byte_bpe_50k.json"), (word_encoder, "word_bpe_49k.json")])
@given(text=st.text(alphabet=" \n\t a'sB1é—́　.,!?\x1c<|endofx>", max_size=40))
@settings(max_examples=150, deadline=None)
def test_encoders_equal_the_tokenizer(make, name, text):
    encoder = make(public_tokenizers.path(name))
    got = np.frombuffer(next(iter(encoder.encode([text.encode()]))), "<u4").tolist()
    assert got == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("make, name", [(spaced_encoder, "byte_bpe_50k.json"), (word_encoder, "word_bpe_49k.json")])
def test_words_of_letters_equal_the_tokenizer(make, name, monkeypatch):
    """Words that go to the model at once, of all letters below U+0250, with a memory that is full all the time."""
    monkeypatch.setattr(encoding, "MEMO_WORDS", 5)
    monkeypatch.setattr(encoding, "CHUNK_BYTES", 900)
    rng = np.random.default_rng(2)
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = [" ".join(letters), " ".join(f"x{c}y" for c in letters), "ab " * 50 + "z" * 500]
    for _ in range(300):
        words = ["".join(rng.choice(letters, int(rng.integers(1, 9)))) for _ in range(8)]
        ends = ["", "", ".", ",", "!?", "%%%", "_-", "'", "'s.", ".\n", "\n", "\n\n", " \n", "\t", "<|", "1."]
        texts.append("".join(w + str(rng.choice(ends)) + str(rng.choice([" ", " ", ""])) for w in words))
    encoder = type(make(public_tokenizers.path(name)))(public_tokenizers.path(name))
    for text, ids in zip(texts, encoder.encode(t.encode() for t in texts)):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_token_blocks(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = spaced_encoder(path).tokenizer
    got = sorted(simple8b.token_blocks(spark, docs, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 0, 1, 2, 4, 5, 6, 7, 8]
    start = 0
    for row in got:
        text = TEXTS[3 if row.doc_id is None else row.doc_id] or ""
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert (row.start, row.n_tokens, bytes(row.ids)) == (start, len(ids), ids.tobytes())
        start += len(ids)
    assert simple8b.token_blocks(spark, docs.limit(0), path).count() == 0


@given(st.lists(st.sampled_from(list(pieces.piece_model(public_tokenizers.path("piece_bpe_32k.model")).ids)[:3000] + [" ", "  ", "\n", "🙂", "é"]), max_size=9))
@settings(max_examples=200, deadline=None)
def test_pieces_equal_the_library(parts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = pieces.piece_model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    text = "".join(parts)
    ids = model.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
    assert model.decode(ids) == text.replace(pieces.MARK, " ")


def test_piece_round_trip(spark, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = pieces.decode_pieces(pieces.encode_pieces(docs, path), path).collect()
    assert len(got) == len(TEXTS) and all(r.decoded == r.text for r in got)


def test_packing(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack_documents(docs.coalesce(1), path, window=64, max_open=3).collect()
    tokenizer = word_encoder(path).tokenizer
    for i, text in enumerate(TEXTS):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        own = sorted((r for r in got if r.doc_id == (i if i != 3 else None)), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes()
        assert all(r.doc_tokens == len(ids) for r in own)
    windows: dict[int, list] = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or at & (at - 1) == 0
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_level_choice_is_least_squares():
    rng = np.random.default_rng(3)
    windows = packing.SumOfSquares(16)
    for _ in range(300):
        size, counts = int(rng.integers(1, 16)), windows.counts.copy()

        def squares(level):
            after = counts.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 16
            return int((after.astype(int) ** 2).sum())

        level = windows.level_for(size)
        assert squares(level) == min(squares(h) for h in range(17 - size) if h == 0 or counts[h])
        list(windows.place(1, b"\0\0\0\0" * size))


def test_crc_is_over_whole_texts():
    assert zlib.crc32(b"\0\0\0\0") == 558161692
