"""Packing along a space-filling curve.

Each document's words are hashed into a vector, the vector is projected to three dimensions, and
the cell it falls into is numbered along a Hilbert curve, so that documents with similar words
tend to get close numbers. ``pack`` sorts all documents by that number and lays their ids out as
one stream, cut every ``length`` ids: neighbours on the curve share sequences, and only the last
sequence of the whole corpus can need padding.

Scale: ids are made once and kept as 2-byte integers in a Parquet folder under the shared
folder. The range sort moves four numbers for a document, with the document and row numbers as
tie-breaks, so that one cell with a third of all documents is spread over tasks. One total per
task reaches the driver to place the ranges one after the other; positions then join the ids by
row number, whose keys are unique.

Edge cases: a null or empty text is the end id alone. Repeated rows and null ids are documents of
their own. Other columns are not read. An empty table gives no pieces. A text longer than a
sequence spans several.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.encoding import encoder, starts_of
from tillwork.llm.id_files import with_end
from tillwork.llm.words import mixed, slices, word_hashes
from tillwork.session import fresh_dir

DIMENSIONS = 3
BITS = 10
BUCKETS = 256
SPREAD = 8.0
# Text that a task tokenizes at once; its arrays take over twenty times as much memory.
TOKENIZED_BYTES = 3_000_000

TOKENS = "row long, doc_id long, curve long, n_tokens long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Number of each cell along the Hilbert curve; ``cells`` has a row for each point.

    Walks the bits of all points at once: each level's octant is undone by exchanging or
    mirroring the lower bits, then the coordinates are Gray-decoded and interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for d in range(dims):
            mirrored = (x[d] & bit) != 0
            swapped = np.where(mirrored, 0, (x[0] ^ x[d]) & below)
            x[0] ^= np.where(mirrored, below, swapped)
            x[d] ^= swapped
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> level & 1)
    return key


def _axes(dimensions: int) -> np.ndarray:
    return np.random.default_rng(7).normal(size=(BUCKETS, dimensions)).astype(np.float32)


def curve_keys(counts: np.ndarray, hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given as words: the mean of signed hashed unit vectors,
    projected by fixed random axes and squashed into the cube."""
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    sign = np.where(hashes >> np.uint64(63), 1.0, -1.0).astype(np.float32)
    arrows = _axes(DIMENSIONS)[bucket] * sign[:, None]
    owner = np.repeat(np.arange(len(counts)), counts)
    sums = np.stack(
        [
            np.bincount(owner, weights=arrows[codes, d], minlength=len(counts))
            for d in range(DIMENSIONS)
        ],
        axis=1,
    )
    mean = sums / np.maximum(counts, 1)[:, None]
    cells = ((np.tanh(SPREAD / 2 * mean) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)
    return hilbert_keys(cells, BITS)


def _tokenized(tokenizer: str, end_id: int, spaced: bool, folded: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, spaced, folded)
        width = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, limit=TOKENIZED_BYTES):
                texts = part.column("text")
                pieces = coder.split(texts)
                keys = curve_keys(pieces.counts, mixed(word_hashes(pieces.words)), pieces.codes)
                lengths, ids = coder.encode(texts, pieces)
                ids, lengths = with_end(ids, lengths, end_id)
                data = ids.astype(f"<u{width}").tobytes()
                bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)]) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(part.num_rows)),
                        part.column("doc_id"),
                        pa.array(keys),
                        pa.array(lengths),
                        pa.Array.from_buffers(
                            pa.binary(),
                            part.num_rows,
                            [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)],
                        ),
                    ],
                    names=["row", "doc_id", "curve", "n_tokens", "ids"],
                )
                row += part.num_rows
                # What Arrow keeps for later would stay with the worker beside the next stage's.
                pa.default_memory_pool().release_unused()

    return rows


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's first position within its range of the curve."""
    shard, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        lengths = batch.column("n_tokens").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(lengths), shard, np.int32)),
                batch.column("row"),
                batch.column("n_tokens"),
                pa.array(total + starts_of(lengths)),
            ],
            names=["shard", "row", "n_tokens", "first"],
        )
        total += int(lengths.sum())


def _cutter(length: int, bases: dict[int, int]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            shards = batch.column("shard").to_pylist()
            firsts = batch.column("first").to_pylist()
            names = batch.column("doc_id").to_pylist()
            totals = batch.column("n_tokens").to_pylist()
            for shard, first, name, total, data in zip(
                shards, firsts, names, totals, batch.column("ids")
            ):
                wide = np.frombuffer(data.as_buffer(), f"<u{len(data.as_buffer()) // total}").astype("<u4")
                place, start = bases[shard] + first, 0
                while start < total:
                    offset = place % length
                    size = min(length - offset, total - start)
                    crc = zlib.crc32(wide[start : start + size])
                    out.append((name, start, size, crc, total, place // length, offset))
                    place, start = place + size, start + size
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=[
                    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                ],
            )

    return cut


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    end_id: int = 2,
    spaced: bool = False,
    folded: bool = True,
) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of ``length`` ids.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32`` of the piece's ids as little-endian 32-bit integers, ``doc_tokens``,
    ``sequence_id`` and ``offset`` in it. Offsets have no gaps; all sequences but the last are
    full.
    """
    spark = docs.sparkSession
    tokens_at, order_at = fresh_dir(spark, "tokens"), fresh_dir(spark, "curve")
    docs.select("doc_id", "text").mapInArrow(
        _tokenized(tokenizer, end_id, spaced, folded), TOKENS
    ).write.option("compression", "zstd").parquet(tokens_at)
    tokens = spark.read.schema(TOKENS).parquet(tokens_at)
    (
        tokens.select("curve", "doc_id", "row", "n_tokens")
        .repartitionByRange("curve", "doc_id", "row")
        .sortWithinPartitions("curve", "doc_id", "row")
        .mapInArrow(_running, "shard int, row long, n_tokens long, first long")
        .write.parquet(order_at)
    )
    order = spark.read.parquet(order_at)
    totals = {
        r["shard"]: r["n"]
        for r in order.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()
    }
    shards = sorted(totals)
    bases = dict(zip(shards, starts_of(np.array([totals[s] for s in shards], np.int64)).tolist()))
    placed = tokens.select("row", "doc_id", "n_tokens", "ids").join(
        order.select("row", "shard", "first"), "row"
    )
    return placed.mapInArrow(_cutter(length, bases), PIECES)
