"""Documents packed into windows of fixed length by the sum-of-squares rule.

A document goes into the open window whose fill level makes the sum of squares of the numbers of open windows by level
least. The numbers stand in a level array, so a choice is one pass over it. Documents of a window or more give whole
windows first. At most ``max_open`` windows are open: beyond that, and at the end of a partition, what open windows
hold is run together and cut at window ends, and the last rest at powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tablemill.llm.common import binary_column, keyed
from tablemill.llm.encoding import word_encoder

WINDOW = 4096
MAX_OPEN = 1024
END_ID = 2

PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)

#: A piece: document id, start in its document, ids as bytes, tokens of the document.
Piece = tuple


class SumOfSquares:
    """The windows of one partition. Finished windows are given out as lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)  # open windows by level
        self.open: dict[int, list[list[Piece]]] = {}  # the same windows themselves
        self.n_open = 0

    def place(self, doc_id: int | None, ids: bytes) -> Iterator[list[Piece]]:
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            yield [(doc_id, start, ids[4 * start : 4 * (start + self.window)], total)]
            start += self.window
        if start < total:
            yield from self._put((doc_id, start, ids[4 * start :], total))
        if self.n_open > self.max_open:
            yield from self.run_together()

    def level_for(self, size: int) -> int:
        """The level, 0 for a new window, that makes the sum of squares least; of equal ones the fullest."""
        after = self.counts[size:].copy()  # windows at the level that each level would go to
        before = self.counts[: len(after)]
        change = 2 * after + 1 - (2 * before - 1)
        change[-1] = -(2 * before[-1] - 1)  # a full window counts no more
        change[before == 0] = np.iinfo(np.int64).max
        change[0] = 2 * after[0] + 1
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _put(self, piece: Piece) -> Iterator[list[Piece]]:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        yield from self._keep(pieces, level + size)

    def _keep(self, pieces: list[Piece], level: int) -> Iterator[list[Piece]]:
        if level == self.window:
            yield pieces
        else:
            self.open.setdefault(level, []).append(pieces)
            self.counts[level] += 1
            self.n_open += 1

    def run_together(self) -> Iterator[list[Piece]]:
        """Closes all open windows but for one with the rest."""
        held = [piece for level in sorted(self.open, reverse=True) for pieces in self.open[level] for piece in pieces]
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        pieces, room = [], self.window
        for piece in held:
            while piece:
                head, piece = _cut(piece, room)
                pieces.append(head)
                room -= len(head[2]) // 4
                if not room:
                    yield pieces
                    pieces, room = [], self.window
        if pieces:
            yield from self._keep(pieces, self.window - room)

    def finish(self) -> Iterator[list[Piece]]:
        """Closes all windows; the last rest is cut into windows of powers of two."""
        yield from self.run_together()
        for level, (held,) in self.open.items():
            room = 1 << (level.bit_length() - 1)
            pieces, left = [], level
            for piece in held:
                while piece:
                    head, piece = _cut(piece, room)
                    pieces.append(head)
                    room -= len(head[2]) // 4
                    left -= len(head[2]) // 4
                    if not room:
                        yield pieces
                        pieces, room = [], 1 << (left.bit_length() - 1) if left else 0
        self.open, self.n_open = {}, 0
        self.counts[:] = 0


def _cut(piece: Piece, room: int) -> tuple[Piece, Piece | None]:
    doc_id, start, ids, total = piece
    if len(ids) <= 4 * room:
        return piece, None
    return (doc_id, start, ids[: 4 * room], total), (doc_id, start + room, ids[4 * room :], total)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, max_open: int = MAX_OPEN
) -> DataFrame:
    """One row per piece of every whole text: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers. Null texts are empty and give the end id only; null and
    repeated document ids are packed row by row; an empty table gives no rows. Every partition is packed by itself, in
    order of id and text, without a shuffle, so a lost task gives the same windows again. ``sequence_id`` is the
    partition's number times 2**40 and a count.
    """

    def pack(batches):
        encoder, windows = word_encoder(tokenizer_path), SumOfSquares(window, max_open)
        first, done = TaskContext.get().partitionId() << 40, 0
        rows: list[tuple] = []

        def number(closed):
            nonlocal done
            for pieces in closed:
                offset = 0
                for doc_id, start, ids, total in pieces:
                    rows.append((doc_id, start, len(ids) // 4, ids, total, first + done, offset))
                    offset += len(ids) // 4
                done += 1

        end = end_id.to_bytes(4, "little")
        for batch in batches:
            texts = binary_column(batch, "text")
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                number(windows.place(doc_id, ids + end))
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
        number(windows.finish())
        if rows:
            yield _batch(rows)

    ordered = keyed(docs).sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    return ordered.mapInArrow(pack, PIECE_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
    types = [pa.binary() if name == "ids" else pa.int64() for name in names]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
