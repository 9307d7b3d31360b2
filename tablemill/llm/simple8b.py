"""Token ids in Simple-8b blocks: 64-bit words, each a selector of 4 bits and 60 bits of equally wide ids.

A block is ``n_ids``, ``n_words`` and ``n_escapes`` as little-endian unsigned 32-bit integers and one unused word of 32
bits, then the words, then the positions (32 bits, padded to a multiple of 64) and the values (64 bits) of escapes.
Escaped ids, those of more than 60 bits, are zeros in the words. A block decodes in one go: the selectors give the
position of every word's first id, and all words of one selector are taken apart together.

A file of blocks is a Parquet table of one row per block, so Spark's committers, splits and remote stores hold for it:
``part, block, first`` (ids of the part before the block), ``doc_ids, doc_lengths, n_ids, payload``. Parts and blocks
are in ascending order of document id. A document is never cut, so a block ends with the document that fills it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemill.llm.common import binary_column, keyed, shuffle_partitions
from tablemill.llm.encoding import spaced_encoder
from tablemill.session import shared_dir

# Fixed values of the code: ids in a word and bits of an id, by selector.
SLOTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

BLOCK_IDS = 65_536
END_ID = 0

BLOCK_SCHEMA = (
    "part int, block int, first bigint, doc_ids array<bigint>, doc_lengths array<bigint>, n_ids bigint, payload binary"
)


def pack(ids: np.ndarray) -> bytes:
    """A block of any unsigned 64-bit ids."""
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    escapes = np.flatnonzero(ids >> np.uint64(60))
    plain = np.concatenate([ids, np.zeros(SLOTS[0] + 1, np.uint64)])
    plain[escapes] = 0
    width = np.frexp(plain.astype(np.float64))[1].astype(np.uint8)
    width[(plain > 0) & (width > 60)] = 60  # rounded up by the conversion
    selector = np.full(n + 1, 15, np.uint8)
    for k in range(14, -1, -1):  # from few ids to many: the last selector that fits takes most
        fits = _windows_max(width, int(SLOTS[k]), n + 1) <= BITS[k]
        selector[fits] = k
    step, starts, i = SLOTS.astype(np.uint8)[selector].tobytes(), [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts, np.int64)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for k in np.unique(chosen):
        at = np.flatnonzero(chosen == k)
        for slot in range(SLOTS[k] if BITS[k] else 0):
            words[at] |= plain[starts[at] + slot] << np.uint64(BITS[k] * slot)
    positions = np.zeros(len(escapes) + len(escapes) % 2, "<u4")
    positions[: len(escapes)] = escapes
    head = np.array([n, len(words), len(escapes), 0], "<u4")
    return b"".join(x.tobytes() for x in (head, words.astype("<u8"), positions, ids[escapes].astype("<u8")))


def _windows_max(width: np.ndarray, reach: int, n: int) -> np.ndarray:
    """The maximum over ``reach`` widths from each of the first ``n`` positions; ``width`` goes on that far."""
    out, have = width[: n + reach - 1], 1
    while have < reach:
        step = min(have, reach - have)
        out, have = np.maximum(out[step:], out[: len(out) - step]), have + step
    return out


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a block as unsigned 64-bit integers."""
    n, n_words, n_escapes, _ = np.frombuffer(payload, "<u4", 4)
    words = np.frombuffer(payload, "<u8", n_words, 16)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = SLOTS[selector]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for k in np.unique(selector):
        if BITS[k]:
            at = np.flatnonzero(selector == k)
            shifts = np.arange(SLOTS[k], dtype=np.uint64) * np.uint64(BITS[k])
            mask = np.uint64((1 << int(BITS[k])) - 1)
            out[starts[at][:, None] + np.arange(SLOTS[k])] = (words[at][:, None] >> shifts) & mask
    out = out[:n]
    if n_escapes:
        offset = 16 + 8 * int(n_words)
        positions = np.frombuffer(payload, "<u4", n_escapes, offset)
        out[positions] = np.frombuffer(payload, "<u8", n_escapes, offset + 4 * int(n_escapes + n_escapes % 2))
    return out


def write_token_blocks(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, path: str, block_ids: int = BLOCK_IDS
) -> None:
    """Encodes every whole text and writes the blocks in ascending order of ``doc_id``.

    Null texts are empty and give the end id only; null ids come first; rows of one id are in order of their text's
    hash, then text. An empty table gives an empty file. The one shuffle deals texts to ranges of (id, hash), so
    many rows of one id do not meet in one task.
    """

    def blocks(batches):
        encoder, part = spaced_encoder(tokenizer_path), TaskContext.get().partitionId()
        pending, lengths, ids, held, block, first = [], [], [], 0, 0, 0

        def flush():
            values = np.frombuffer(b"".join(pending), "<u4")
            row = [[part], [block], [first], [ids], [lengths], [len(values)], [pack(values)]]
            return pa.record_batch([pa.array(v, t) for v, t in zip(row, types)], names=names)

        names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
        longs = pa.list_(pa.int64())
        types = [pa.int32(), pa.int32(), pa.int64(), longs, longs, pa.int64(), pa.binary()]
        for batch in batches:
            texts = binary_column(batch, "text")
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                raw += END_ID.to_bytes(4, "little")
                pending.append(raw)
                ids.append(doc_id)
                lengths.append(len(raw) // 4)
                held += len(raw) // 4
                if held >= block_ids:
                    yield flush()
                    block, first = block + 1, first + held
                    pending, lengths, ids, held = [], [], [], 0
        if ids:
            yield flush()

    ordered = keyed(docs).repartitionByRange(shuffle_partitions(spark), "doc_id", "_h")
    ordered = ordered.sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a block file: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids``, the little-endian unsigned 32-bit ids."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))  # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, first, ids, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
                values = unpack(payload).astype("<u4")
                ends = np.cumsum(np.array(lengths, np.int64))
                starts = ends - lengths
                raw = values.tobytes()
                yield pa.record_batch(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(base + first + starts),
                        pa.array(lengths, pa.int64()),
                        pa.array([raw[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    # As many rows as the file has parts, so the blocks need no shuffle.
    located = blocks.join(F.broadcast(bases), "part").select("base", "first", "doc_ids", "doc_lengths", "payload")
    return located.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_blocks(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes a block file of ``docs`` in the shared folder and reads it back."""
    path = shared_dir(spark, "token-blocks")
    write_token_blocks(spark, docs, tokenizer_path, path)
    return read_token_blocks(spark, path)
