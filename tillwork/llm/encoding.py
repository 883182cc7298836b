"""Token ids of whole Arrow columns with a public tokenizer.

A byte-pair encoder that splits text before merging gives the same ids for a text as for its
pieces, as long as a cut never falls into one of its pre-tokens. ``Encoder`` cuts at spaces,
finds the distinct pieces of a batch, encodes each with the tokenizers library once, and
gathers the ids of all pieces in numpy. Running text repeats its words, so that most of the work
of encoding goes away, while every id still comes from the library.

Cuts that are used, with the pre-tokenizers of the two vocabularies in mind:

* at a single space between two characters that are not white space. Where space is part of the
  following token, a text with other runs of white space is encoded as a whole;
* between a plain letter or digit and a run of ASCII punctuation at the end of a piece, without
  apostrophes, which begin contractions.

Pieces that hold ``<|``, the beginning of a special token, are never cut nor lower-cased.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillwork.llm.words import filled, numpy_of

# Words whose ids a Python worker remembers between batches; beyond, words are encoded again.
REMEMBERED = 1_000_000

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_UNEVEN = rf"^ | $|{_SPACE} | {_SPACE}"
_TAIL = r"^(?P<stem>(?s:.*)[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?P<tail>[!-&(-/:-@\[-`{-~]+)$"


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """The running total before each length."""
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + length]`` one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - starts_of(lengths), lengths)
    return flat[shift + np.arange(total)]


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of ``counts`` values; empty groups give 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@dataclass
class Pieces:
    """Texts cut into pieces: pieces per text, the distinct pieces, and each piece's code."""

    counts: np.ndarray
    words: pa.Array
    codes: np.ndarray


@dataclass
class _Ids:
    starts: np.ndarray
    lengths: np.ndarray
    flat: np.ndarray


class Encoder:
    """``spaced``: a space belongs to the token after it. ``folded``: case does not matter."""

    def __init__(self, path: str, spaced: bool, folded: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced, self.folded = spaced, folded
        self.known = pa.array([], pa.string())
        self.ids = _Ids(*(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0, np.uint32))

    def split(self, texts: pa.Array) -> Pieces:
        lists = pc.split_pattern(filled(texts), " ")
        coded = lists.flatten().dictionary_encode()
        counts = numpy_of(pc.list_value_length(lists)).astype(np.int64)
        return Pieces(counts, coded.dictionary, numpy_of(coded.indices))

    def encode(self, texts: pa.Array, pieces: Pieces | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids per text and all ids, in the order of the texts."""
        texts = filled(texts)
        pieces = pieces or self.split(texts)
        counts, words, codes = pieces.counts, pieces.words, pieces.codes
        if self.spaced:
            first = starts_of(counts)
            heads, head_codes = np.unique(codes[first], return_inverse=True)
            bare = words.take(pa.array(heads))
            codes = codes.astype(np.int64)
            codes[first] = len(words) + head_codes
            words = pa.concat_arrays([pc.binary_join_element_wise(" ", words, ""), bare])
        table = self._of_words(words)
        lengths = table.lengths[codes]
        ids = gathered(table.flat, table.starts[codes], lengths)
        per_text = summed(lengths, counts)
        if self.spaced:
            uneven = numpy_of(pc.match_substring_regex(texts, _UNEVEN))
            if uneven.any():
                per_text, ids = self._replaced(texts, np.flatnonzero(uneven), per_text, ids)
        return per_text, ids

    def _replaced(self, texts, rows, per_text, ids):
        """Whole encodings in place of the pieces' ids for some rows."""
        parts = np.split(ids, np.cumsum(per_text)[:-1])
        for row in rows.tolist():
            parts[row] = np.array(
                self.tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids, np.uint32
            )
        return np.array([len(p) for p in parts], np.int64), np.concatenate(parts)

    def _of_words(self, words: pa.Array) -> _Ids:
        """Ids of distinct pieces, from those of their stems and tails."""
        special = pc.match_substring(words, "<|")
        cut = pc.extract_regex(words, _TAIL)
        whole = pc.or_(pc.is_null(cut), special)
        stems = pc.if_else(whole, words, pc.struct_field(cut, "stem"))
        tails = pc.if_else(whole, "", pc.struct_field(cut, "tail"))
        if self.folded:
            stems = pc.if_else(special, stems, pc.ascii_lower(stems))
        coded = pa.concat_arrays([stems, tails]).dictionary_encode()
        table = self._lookup(coded.dictionary)
        codes = numpy_of(coded.indices)
        pairs = np.stack([codes[: len(words)], codes[len(words) :]], axis=1).ravel()
        lengths = table.lengths[pairs]
        flat = gathered(table.flat, table.starts[pairs], lengths)
        both = lengths.reshape(-1, 2).sum(axis=1)
        return _Ids(starts_of(both), both, flat)

    def _lookup(self, words: pa.Array) -> _Ids:
        """Ids of words: remembered ones, and new ones by the tokenizer."""
        at = pc.index_in(words, value_set=self.known)
        new = numpy_of(pc.is_null(at))
        where = numpy_of(pc.fill_null(at, 0)).astype(np.int64)
        fresh = words.filter(pa.array(new))
        encoded = [
            e.ids for e in self.tokenizer.encode_batch_fast(fresh.to_pylist(), add_special_tokens=False)
        ]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(lengths.sum()))
        known = len(self.known)
        joined = _Ids(
            np.concatenate([self.ids.starts, len(self.ids.flat) + starts_of(lengths)]),
            np.concatenate([self.ids.lengths, lengths]),
            np.concatenate([self.ids.flat, flat]),
        )
        where[new] = known + np.arange(len(fresh))
        if known + len(fresh) <= REMEMBERED:
            self.known, self.ids = pa.concat_arrays([self.known, fresh]), joined
        return _Ids(joined.starts[where], joined.lengths[where], joined.flat)


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool, folded: bool) -> Encoder:
    """One encoder for each vocabulary in a Python worker."""
    return Encoder(path, spaced, folded)
