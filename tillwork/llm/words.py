"""Words of text columns as Arrow arrays, for tasks that work on whole batches.

``slices`` cuts a batch into parts of bounded text size, so that the working memory of a task
does not depend on how many rows Spark puts into a batch; one long text is a part of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 12_000_000


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def filled(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts, "")


def numpy_of(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII white space: per text the number of words, the distinct words, and
    for every word of all texts the index of its distinct word."""
    lists = pc.ascii_split_whitespace(texts)
    counts = numpy_of(pc.list_value_length(lists)).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes, words = numpy_of(coded.indices), coded.dictionary
    empty = numpy_of(pc.equal(words, "")) if len(words) else np.zeros(0, bool)
    if empty.any():
        keep = ~empty[codes]
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[keep], minlength=len(counts))
        codes = codes[keep]
    return counts, words, codes


def word_hashes(words: pa.Array) -> np.ndarray:
    """A fixed 64-bit hash of each word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(numpy_of(words).astype(object), categorize=False)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing, so that all bits of the result depend on all bits given."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
