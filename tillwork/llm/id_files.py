"""Token-id files: a concatenated id array with Elias-Fano encoded document boundaries.

``write`` encodes a corpus in ascending document order into a folder of blocks; ``documents``
reads a folder back. Each block is one byte string that can be decoded on its own:

    magic ``TWID1``, id width in bytes, number of documents, number of ids,
    the boundaries as Elias-Fano parts, the ids as little-endian unsigned integers

Boundaries are a non-decreasing sequence of n + 1 offsets up to the number of ids u. Elias-Fano
keeps the low ``log2(u / n)`` bits of each in a packed array and the rest as unary gaps, about
2 + log2(u / n) bits for a document, and a sample of every 64th set bit makes ``select(i)``, the
offset of document i, a look at a few bytes; samples whose bits are spread far keep their places.
Document ids are stored the same way, as distances from a block's least one. Readers select a bounded
run of documents at a time; no table of 64-bit offsets is stored or built.

Scale: texts are range-sorted by document id once, with the row number as a tie-break, so that a
repeated id does not fill one task; each task encodes its range block by block, with one block in
memory. Only one total per task reaches the driver, to place the ranges one after the other.
Blocks lie in Parquet, so that Spark's commit keeps a retried task's blocks from appearing twice.

Edge cases: a null text is the empty text and has the end id only. Null ids come first.
Repeated rows are documents of their own, next to each other. An empty table gives no blocks and
no rows. Other columns are not read. Long texts are encoded whole, a block ends after the
document that fills it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.encoding import encoder, starts_of
from tillwork.llm.words import slices

MAGIC = b"TWID1"
HEADER = struct.Struct("<5sBQQ")
PARTS = struct.Struct("<BQQQ")
SAMPLE = 64
WIDE = 64 * SAMPLE  # bits
AT_ONCE = 16_384  # values packed, and documents read, at once; a multiple of eight
NAMES = struct.Struct("<Qq")
BLOCK_IDS = 4_000_000
BLOCKS = "shard int, block int, first_id long, n_ids long, doc_ids binary, data binary"


def _wide(samples: np.ndarray) -> np.ndarray:
    """Samples whose set bits are spread so far that their places are kept one by one. The last one
    never is, as its spread is not known from the samples."""
    return np.flatnonzero(np.diff(samples.astype(np.int64)) > WIDE)


class EliasFano:
    """A non-decreasing sequence of non-negative integers in near-minimal space."""

    def __init__(
        self, low_bits: int, size: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, far: np.ndarray
    ):
        self.low_bits, self.size, self.low, self.high = low_bits, size, low, high
        self.samples, self.far = samples, far
        self.wide = _wide(samples)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        size = len(values)
        top = int(values[-1]) if size else 0
        low_bits = max(0, (top // max(size, 1)).bit_length() - 1)
        spots = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)
        unary = np.zeros((top >> low_bits) + size + 1, np.uint8)
        unary[spots] = 1
        places = np.arange(low_bits, dtype=np.uint64)
        low = [
            np.packbits(((part[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
            for part in np.split(values, range(AT_ONCE, size, AT_ONCE))
        ]
        samples = spots[::SAMPLE].astype("<u4")
        far = [spots[g * SAMPLE : (g + 1) * SAMPLE] for g in _wide(samples)]
        return cls(
            low_bits,
            size,
            np.concatenate(low),
            np.packbits(unary, bitorder="little"),
            samples,
            np.concatenate([*far, np.zeros(0, np.int64)]).astype("<u4"),
        )

    def _spots(self, group: int) -> np.ndarray:
        """Places of the set bits ``SAMPLE * group`` and on, as many as a sample stands for."""
        count = min(SAMPLE, self.size - group * SAMPLE)
        at = int(np.searchsorted(self.wide, group))
        if at < len(self.wide) and self.wide[at] == group:
            return self.far[at * SAMPLE : at * SAMPLE + count].astype(np.int64)
        first = int(self.samples[group])
        last = int(self.samples[group + 1]) if group + 1 < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[first >> 3 : (last + 7) >> 3], bitorder="little")
        return (first + np.flatnonzero(bits[first & 7 :]))[:count]

    def select(self, first: int, last: int | None = None) -> np.ndarray:
        """The values from ``first`` to before ``last``, or the one at ``first``, read from the sample
        before them."""
        last = first + 1 if last is None else last
        if not 0 <= first < last <= self.size:
            raise IndexError((first, last))
        group = first // SAMPLE
        spots = np.concatenate([self._spots(g) for g in range(group, (last - 1) // SAMPLE + 1)])
        index = np.arange(first, last)
        upper = spots[first - group * SAMPLE :][: last - first] - index
        bit = first * self.low_bits
        bits = np.unpackbits(self.low[bit >> 3 : (last * self.low_bits + 7) >> 3], bitorder="little")
        bits = bits[bit & 7 :][: (last - first) * self.low_bits].reshape(last - first, self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        lower = (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return upper.astype(np.uint64) << np.uint64(self.low_bits) | lower

    def to_bytes(self) -> bytes:
        sizes = PARTS.pack(self.low_bits, self.size, len(self.low), len(self.high))
        return sizes + b"".join(x.tobytes() for x in (self.low, self.high, self.samples, self.far))

    @classmethod
    def read(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence at the start of ``data`` and the bytes it takes."""
        low_bits, size, n_low, n_high = PARTS.unpack_from(data)
        at = PARTS.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        samples = np.frombuffer(data, "<u4", -(-size // SAMPLE), at)
        at += 4 * len(samples)
        far = np.frombuffer(data, "<u4", SAMPLE * len(_wide(samples)), at)
        return cls(low_bits, size, low, high, samples, far), at + 4 * len(far)


def pack(ids: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    """One block: documents of ``lengths`` ids each, one after the other in ``ids``."""
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    head = HEADER.pack(MAGIC, width, len(lengths), len(ids))
    return head + EliasFano.of(ends).to_bytes() + ids.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> tuple[EliasFano, np.ndarray]:
    """Boundaries and ids of a block."""
    magic, width, _, n_ids = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token-id block")
    view = memoryview(data)[HEADER.size :]
    bounds, taken = EliasFano.read(view)
    return bounds, np.frombuffer(view, f"<u{width}", n_ids, taken)


def pack_names(names: pa.Array) -> bytes:
    """Ascending document ids, nulls first: how many nulls, the least id, the distances from it."""
    some = names.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    least = int(some[0]) if len(some) else 0
    apart = some.view(np.uint64) - np.array([least], np.int64).view(np.uint64)
    return NAMES.pack(names.null_count, least) + EliasFano.of(apart).to_bytes()


def unpack_names(data: bytes):
    """A function that gives the document ids from one place of a block to before another."""
    nulls, least = NAMES.unpack_from(data)
    apart, _ = EliasFano.read(memoryview(data)[NAMES.size :])
    base = np.array([least], np.int64).view(np.uint64)

    def names(first: int, last: int) -> pa.Array:
        none = pa.nulls(max(0, min(last, nulls) - first), pa.int64())
        if last <= nulls:
            return none
        some = (apart.select(max(first - nulls, 0), last - nulls) + base).view(np.int64)
        return pa.concat_arrays([none, pa.array(some)])

    return names


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each document, and the lengths with it."""
    return np.insert(ids, np.cumsum(lengths), end_id), lengths + 1


def _block_writer(tokenizer: str, end_id: int, spaced: bool, folded: bool, block_ids: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, spaced, folded)
        width = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def flushed() -> pa.RecordBatch:
            nonlocal block, first
            ids = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([h[1] for h in held])
            names = pa.concat_arrays([h[2] for h in held])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([pack_names(names)], pa.binary()),
                    pa.array([pack(ids, lengths, width)], pa.binary()),
                ],
                names=["shard", "block", "first_id", "n_ids", "doc_ids", "data"],
            )
            held.clear()
            block, first = block + 1, first + len(ids)
            return row

        size = 0
        for batch in batches:
            for part in slices(batch):
                lengths, ids = coder.encode(part.column("text"))
                ids, lengths = with_end(ids, lengths, end_id)
                held.append((ids, lengths, part.column("doc_id").cast(pa.int64())))
                size += len(ids)
                if size >= block_ids:
                    yield flushed()
                    size = 0
        if held:
            yield flushed()

    return blocks


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    spaced: bool = True,
    folded: bool = False,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) and write blocks in ascending ``doc_id`` order."""
    ordered = (
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(
        _block_writer(tokenizer, end_id, spaced, folded, block_ids), BLOCKS
    ).write.option("compression", "zstd").parquet(path)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document of a folder."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = {
        r["shard"]: r["n"]
        for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    }
    order = sorted(totals)
    bases = dict(zip(order, starts_of(np.array([totals[s] for s in order], np.int64)).tolist()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first_id, names, data = (batch.column(c)[row] for c in ("shard", "first_id", "doc_ids", "data"))
                bounds, ids = unpack(data.as_buffer())
                named = unpack_names(names.as_buffer())
                base = bases[shard.as_py()] + first_id.as_py()
                for first in range(0, bounds.size - 1, AT_ONCE):
                    last = min(first + AT_ONCE, bounds.size - 1)
                    ends = bounds.select(first, last + 1).astype(np.int64)
                    spans = zip(ends[:-1].tolist(), ends[1:].tolist())
                    yield pa.RecordBatch.from_arrays(
                        [
                            named(first, last),
                            pa.array(base + ends[:-1]),
                            pa.array(np.diff(ends)),
                            pa.array([zlib.crc32(ids[a:b].astype("<u4")) for a, b in spans], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return blocks.select("shard", "first_id", "doc_ids", "data").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
