"""A hidden Markov language model of words, trained by Baum-Welch over all training documents.

States give word classes, classes give words: ``P(word | state) = P(class | state) * P(word | class)``. A word's class
is a hash, so the tables of the model have one size for any corpus, while word counts grow with it. ``P(word | class)``
is the word's share of the class's smoothed counts. The end of a text and unknown words have classes of their own.

Counts reach texts without a broadcast vocabulary: documents are dealt to chunks, each chunk's distinct words with their
counts in it are summed per word over all chunks, and the sums return to the chunks that have the word. Texts are then
kept as class numbers, which is all that Baum-Welch and scoring read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemill.llm.common import binary_column, keyed, written

STATES = 8
CLASSES = 32_768
ITERATIONS = 2
#: Bytes of text in a chunk, on average.
CHUNK_BYTES = 16_000_000
#: Partitions for each chunk; with one, hashing gave a task 5 of 11 chunks.
SPREAD = 2
#: Strength, in tokens, of the prior that gives every state the words' overall shares.
PRIOR = 1000.0
#: The first guess takes all training texts in pieces of at most so many tokens and deals them to states so often.
GUESS_TOKENS, GUESS_ROUNDS = 4000, 3
#: Tokens that forward and backward passes hold at a time, with some 160 bytes each, and the longest sequence they train
#: on as one. Sequences of about ``SORTED_TOKENS``, two bytes each, are ordered by length before they are grouped.
BATCH_TOKENS, SORTED_TOKENS = 200_000, 2_000_000
SEQUENCE_TOKENS = 100_000
#: Distinct words of its chunks that a task holds before it hands them on; a word may then have several rows of a chunk.
HELD_WORDS = 500_000
#: Texts that are Python objects at a time, and words handed on at a time.
TEXT_ROWS, WORD_ROWS = 256, 50_000

END_CLASS, UNKNOWN_CLASS = CLASSES, CLASSES + 1
_END = "\n"  # no word has it
_SUM = "k int, " + ", ".join(f"s{i} double" for i in range(STATES))


@dataclass(frozen=True)
class Model:
    """``start[s]``, ``moves[s, t]`` and ``emits[class, s]`` are chances."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


@dataclass(frozen=True)
class Corpus:
    """``texts``: one row per document with its class numbers; ``mass``: smoothed counts by class; training tokens and
    distinct ones."""

    texts: DataFrame
    mass: np.ndarray
    tokens: int
    distinct: int

    @property
    def smoothed(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


def held_out_by_id(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 5; null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _tokens(raw: bytes) -> list[bytes]:
    return [*raw.lower().split(), _END.encode()]


def _chunk_words(batches, held_words: int):
    """Each chunk's distinct tokens and how often its training texts have them."""
    held: dict[int, Counter] = {}

    def rows():
        for chunk, counts in held.items():
            items = iter(counts.items())
            while some := list(islice(items, WORD_ROWS)):
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(some), chunk, np.int64)),
                        pa.array([w.decode("utf-8", "replace") for w, _ in some], pa.string()),
                        pa.array([n for _, n in some], pa.int64()),
                    ],
                    names=["chunk", "word", "n"],
                )
        held.clear()

    for batch in batches:
        for start in range(0, batch.num_rows, TEXT_ROWS):
            some = batch.slice(start, TEXT_ROWS)
            trains = some.column("held_out").to_pylist()
            for chunk, out, raw in zip(some.column("chunk").to_pylist(), trains, binary_column(some, "text")):
                counts = held.setdefault(chunk, Counter())
                tokens = _tokens(raw)
                counts.update(dict.fromkeys(tokens, 0) if out else tokens)
            if sum(map(len, held.values())) > held_words:
                yield from rows()
    yield from rows()


_TEXTS = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, classes binary, "
    "mass binary, distinct bigint"
)


def _encode(docs: pa.Table, words: pa.Table) -> pa.Table:
    """A chunk's texts as class numbers, and in one more row what the words that this chunk leads add to the totals."""
    n = words.column("n").to_numpy()
    kind = words.column("class").to_numpy()
    place = {w: i for i, w in enumerate(words.column("word").cast(pa.binary()).to_pylist())}
    lead = words.column("lead").to_numpy(zero_copy_only=False) & (n > 0)
    mass = np.bincount(kind[lead], n[lead] + 0.5, CLASSES + 2)
    codes = np.where(n > 0, kind, UNKNOWN_CLASS).astype("<u2")
    logs = np.log(n + 0.5)
    rows = []
    for some in docs.to_batches(TEXT_ROWS):
        ids, outs = some.column("doc_id").to_pylist(), some.column("held_out").to_pylist()
        for doc_id, out, raw in zip(ids, outs, binary_column(some, "text")):
            at = np.fromiter(map(place.__getitem__, _tokens(raw)), np.int64)
            known = int((n[at] > 0).sum())
            rows.append((doc_id, out, len(at), known, float(logs[at].sum()), codes[at].tobytes(), None, None))
    rows.append((None, None, int(n[lead].sum()), None, None, None, mass.tobytes(), int(lead.sum())))
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.int64()]
    names = [f.split()[0] for f in _TEXTS.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_corpus(spark: SparkSession, docs: DataFrame) -> Corpus:
    """Counts all training tokens and writes every text as class numbers. Texts are shuffled once."""
    rows = keyed(docs)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    dealt = rows.select(
        "doc_id",
        held_out_by_id(F.col("doc_id")).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", "_h"), F.lit(chunks)).alias("chunk"),
        "text",
    ).repartition(SPREAD * chunks, "chunk")
    held_words = HELD_WORDS
    met = dealt.mapInArrow(lambda batches: _chunk_words(batches, held_words), "chunk bigint, word string, n bigint")
    every = Window.partitionBy("word")
    counted = met.select(
        "chunk",
        "word",
        F.sum("n").over(every).alias("n"),
        (F.row_number().over(every.orderBy("chunk")) == 1).alias("lead"),
        F.when(F.col("word") == _END, END_CLASS)
        .otherwise(F.pmod(F.xxhash64("word"), F.lit(CLASSES)).cast("int"))
        .alias("class"),
    )
    texts = dealt.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(_encode, _TEXTS)
    texts = written(spark, texts, "class-numbers")

    def add(batches):
        total = np.zeros(CLASSES + 2)
        for batch in batches:
            for raw in batch.column("mass").to_pylist():
                total += np.frombuffer(raw)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["k", "m"])

    parts = texts.where("mass IS NOT NULL")
    masses = parts.select("mass").mapInArrow(add, "k int, m double").groupBy("k").agg(F.sum("m").alias("m")).collect()
    mass = np.zeros(CLASSES + 2)
    for row in masses:
        mass[row.k] = row.m
    mass[UNKNOWN_CLASS] = 0.5
    totals = parts.agg(F.sum("n_tokens").alias("n"), F.sum("distinct").alias("v")).first()
    return Corpus(texts.where("mass IS NULL").drop("mass", "distinct"), mass, totals.n or 0, totals.v or 0)


# Forward and backward passes over many sequences at a time: step t of all sequences that are so long stands together.


def _by_step(sequences: list[np.ndarray]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The order by falling length, where each step begins, and all class numbers by step."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    active = np.searchsorted(-falling, -np.arange(falling[0]), side="left")
    begins = np.concatenate([[0], np.cumsum(active)])
    flat = np.empty(begins[-1], "<u2")
    for rank, i in enumerate(order.tolist()):
        flat[begins[: lengths[i]] + rank] = sequences[i]
    return order, begins, flat


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """The exact natural logarithms of the sequences' chances, by the scaled forward recursion."""
    order, begins, flat = _by_step(sequences)
    total = np.zeros(len(sequences))
    alpha = np.tile(model.start, (len(sequences), 1))
    for t, (begin, stop) in enumerate(zip(begins.tolist(), begins[1:].tolist())):
        alpha = alpha[: stop - begin]
        if t:
            alpha = alpha @ model.moves
        alpha *= model.emits[flat[begin:stop]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[: stop - begin] += np.log(scale)
    out = np.empty(len(sequences))
    out[order] = total
    return out


class Counts:
    """Expected numbers of starts, moves and emissions."""

    def __init__(self):
        self.start = np.zeros(STATES)
        self.moves = np.zeros((STATES, STATES))
        self.emits = np.zeros((CLASSES + 2, STATES))
        self.log_likelihood = 0.0

    def add(self, model: Model, sequences: list[np.ndarray]) -> None:
        _, begins, flat = _by_step(sequences)
        steps = list(zip(begins.tolist(), begins[1:].tolist()))
        emitted = model.emits[flat]
        alphas, scales = np.empty_like(emitted), np.empty(len(flat))
        alpha = np.tile(model.start, (len(sequences), 1))
        for t, (begin, stop) in enumerate(steps):
            alpha = alpha[: stop - begin]
            if t:
                alpha = alpha @ model.moves
            alpha *= emitted[begin:stop]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            alphas[begin:stop] = alpha
            scales[begin:stop] = scale
        self.log_likelihood += float(np.log(scales).sum())
        met, beta = np.zeros((STATES, STATES)), np.empty((0, STATES))
        for t in range(len(steps) - 1, -1, -1):
            begin, stop = steps[t]
            now = np.ones((stop - begin, STATES))
            if len(beta):
                after, last = steps[t + 1]
                ahead = emitted[after:last] * beta / scales[after:last, None]
                met += alphas[begin : begin + len(beta)].T @ ahead
                now[: len(beta)] = ahead @ model.moves.T
            beta = now
            alphas[begin:stop] *= beta  # from here on the chances of the states
        self.start += alphas[: steps[0][1]].sum(axis=0)
        self.moves += met * model.moves
        for s in range(STATES):
            self.emits[:, s] += np.bincount(flat, alphas[:, s], CLASSES + 2)

    def model(self, shares: np.ndarray) -> Model:
        """Chances from the counts, smoothed by one start and move of each kind and, like Witten and Bell, by as many
        emissions as there are classes met (and ``PRIOR``)."""
        strength = PRIOR + (self.emits > 0.5).sum(axis=0)
        emits = self.emits + strength * shares[:, None]
        moves, start = self.moves + 1.0, self.start + 1.0
        return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def _alike(sequences: list[np.ndarray], most: int):
    """The places of all sequences by falling length, in groups of at most ``most`` tokens, or of one sequence."""
    group, size = [], 0
    for i in np.argsort([-len(s) for s in sequences], kind="stable").tolist():
        if group and size + len(sequences[i]) > most:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(sequences[i])
    if group:
        yield group


def _groups(batches, longest: int, most: int, ordered: int):
    """Lists of class arrays of at most ``most`` tokens, alike in length among about ``ordered`` tokens; arrays of over
    ``longest`` come in pieces."""
    held, size = [], 0
    for batch in batches:
        for raw in batch.column("classes").to_pylist():
            codes = np.frombuffer(raw, "<u2")
            for start in range(0, len(codes), longest):
                held.append(codes[start : start + longest])
                size += len(held[-1])
                if size >= ordered:
                    yield from ([held[i] for i in group] for group in _alike(held, most))
                    held, size = [], 0
    yield from ([held[i] for i in group] for group in _alike(held, most))


def _summed(texts: DataFrame, add: Callable[[Counts, list[np.ndarray]], None]) -> Counts:
    """What ``add`` counts in all texts. Each task sums the counts of its texts and each class's counts are summed over
    tasks, so what comes to the driver has the size of the model."""

    sizes = SEQUENCE_TOKENS, BATCH_TOKENS, SORTED_TOKENS

    def count(batches):
        counts = Counts()
        for sequences in _groups(batches, *sizes):
            add(counts, sequences)
        table = np.concatenate([counts.emits, counts.moves, counts.start[None, :]])
        at = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(at.astype(np.int32)), *(pa.array(table[at, s].copy()) for s in range(STATES))]
        yield pa.record_batch(columns, names=["k", *(f"s{s}" for s in range(STATES))])

    sums = texts.select("classes").mapInArrow(count, _SUM).groupBy("k")
    sums = sums.agg(*(F.sum(f"s{s}").alias(f"s{s}") for s in range(STATES))).toArrow()
    table = np.zeros((CLASSES + 3 + STATES, STATES))
    table[sums.column("k").to_numpy()] = np.stack([sums.column(f"s{s}").to_numpy() for s in range(STATES)], axis=1)
    counts = Counts()
    counts.emits, counts.moves, counts.start = table[: CLASSES + 2], table[CLASSES + 2 : -1], table[-1]
    return counts


def _add_pieces(counts: Counts, sequences: list[np.ndarray], longest: int, table: np.ndarray, start) -> None:
    """Each piece goes whole to one state: by the signs of the sums of its classes' rows of ``table``, or, with the
    states' chances ``start``, to the largest sum."""
    pieces = [s[i : i + longest] for s in sequences for i in range(0, len(s), longest)]
    lengths = np.array([len(p) for p in pieces])
    flat = np.concatenate(pieces).astype(np.int64)
    sums = np.add.reduceat(table[flat], np.cumsum(lengths) - lengths)
    states = (sums > 0) @ (1 << np.arange(sums.shape[1])) % STATES if start is None else (sums + start).argmax(axis=1)
    each = np.bincount(flat * STATES + np.repeat(states, lengths), minlength=counts.emits.size)
    counts.emits += each.reshape(-1, STATES)
    counts.start += np.bincount(states, minlength=STATES)


def _dealt_to_states(spark: SparkSession, training: DataFrame, shares: np.ndarray) -> Counts:
    """All training texts, dealt to states piece by piece: first by random sums, in which rare classes weigh more and
    which are zero for the corpus as a whole, then to the state most likely to give the piece."""
    table = np.random.default_rng(3).choice([-1.0, 1.0], (CLASSES + 2, (STATES - 1).bit_length()))
    table /= np.sqrt(np.where(shares > 0, shares, 1.0))[:, None]
    table -= shares @ table
    longest, start = GUESS_TOKENS, None
    for _ in range(GUESS_ROUNDS):
        shared = spark.sparkContext.broadcast((table, start))
        counts = _summed(training, lambda c, sequences, shared=shared: _add_pieces(c, sequences, longest, *shared.value))
        model = counts.model(shares)
        table, start = np.log(model.emits.clip(1e-300)), np.log(model.start)
    return counts


def train(spark: SparkSession, corpus: Corpus, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over all training texts, from a first guess that all of them make: states begin as groups of pieces
    that are alike, and seldom change within one."""
    shares = corpus.mass / corpus.mass.sum()
    training = corpus.texts.where("NOT held_out")
    counts = _dealt_to_states(spark, training, shares)
    counts.moves = 1.0 + 9 * STATES * np.eye(STATES)
    model = counts.model(shares)
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(model)
        model = _summed(training, lambda c, sequences, shared=shared: c.add(shared.value, sequences)).model(shares)
    return model


def score(spark: SparkSession, corpus: Corpus, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document; scores are
    logarithms to base 10."""
    shared = spark.sparkContext.broadcast((model, np.log(corpus.mass.clip(1e-300))))
    tokens, smoothed, most = corpus.tokens, corpus.smoothed, BATCH_TOKENS

    def run(batches):
        chances, log_mass = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [np.frombuffer(raw, "<u2") for raw in batch.column("classes").to_pylist()]
            found = np.empty(len(codes))
            for group in _alike(codes, most):
                found[group] = log_likelihoods(chances, [codes[i] for i in group])
            found -= np.array([log_mass[c].sum() for c in codes])
            logs, n = batch.column("log_counts").to_numpy(), batch.column("n_tokens").to_numpy()
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")),
                    pa.array(np.full(len(n), tokens, np.int64)),
                    pa.array((logs - n * np.log(smoothed)) / np.log(10)),
                    pa.array((found + logs) / np.log(10)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return corpus.texts.mapInArrow(
        run,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
        "score double",
    )


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Trains on the documents that are not held out and scores all; columns as in :func:`score`.

    A-Z is lower-cased, words are what stands between ASCII white space, and each text has one end. Null texts are
    empty: an end only. Without training documents every token is unknown. An empty table gives no rows.
    """
    corpus = read_corpus(spark, docs)
    return score(spark, corpus, train(spark, corpus))
