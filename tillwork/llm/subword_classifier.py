"""Quality classifier on supervised subword embeddings.

Words, as written, the character n-grams inside them and pairs of neighbouring words are hashed
into a table of learned vectors, pairs into a part of their own. A document is the average of all
its vectors, and a softmax over two classes sits on top. What occurs c times in a document counts
as its root of c in that average, so that a text of few words said over and over does not look like
one that says as much as it has words.
The table and the weights are trained together by stochastic gradient descent in numpy, on at most
``MAX_TRAINING`` labelled documents, a bound that does not depend on the corpus: the labelled ids
with the smallest hashes are taken. Features of the sample are made in Spark's tasks and have at
most ``BUCKETS`` entries a document.

Scoring covers all documents and is one pass without a shuffle. As average and weights are
linear in these counts, a word adds a fixed amount times its root; the model that tasks receive is
that amount for each bucket, and buckets that no training document has add nothing. Each distinct word of a batch is looked at once.

Edge cases: a null or empty text has the score of the classes' bias. Repeated rows are scored one
by one. Labels with null id or null quality are not used, of repeated ones the largest counts.
A null ``doc_id`` is not held out. Of rows that repeat a labelled id, the text with the smallest
hash trains, so that the bound holds for rows. Other columns are not read. Without labelled documents all
scores are 0.5. Texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.components import stored
from tillwork.llm.encoding import starts_of, summed
from tillwork.llm.words import ascii_words, filled, mixed, slices, word_hashes

BUCKETS = 1 << 16
PAIRS = 1 << 18  # buckets of word pairs, behind those of words and n-grams
WIDTH = 16
GRAMS = (3, 4)
MAX_TRAINING = 3000
EPOCHS = 5
STEPS = 15_000
RATE = 2.0
FEATURES = "quality int, buckets array<int>, shares array<float>"


@dataclass(frozen=True)
class Model:
    """What each bucket adds to the logit of class 1, and the logit of a document without words."""

    bucket_logits: np.ndarray
    bias: float


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of features of each word, and the buckets of all: the word and its n-grams."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    framed = pc.binary_join_element_wise("<", words, ">", "")
    lengths = pc.utf8_length(framed).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(framed.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    place = np.arange(len(points)) - np.repeat(starts_of(lengths), lengths)
    room = np.repeat(lengths, lengths) - place
    owner = np.repeat(np.arange(n), lengths)
    owners, found = [np.arange(n)], [word_hashes(words)]
    for size in GRAMS:
        rolled = np.full(max(len(points) - size + 1, 0), size, np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(0x100000001B3) + points[k : k + len(rolled)]
        whole = np.flatnonzero(room[: len(rolled)] >= size)
        owners.append(owner[whole])
        found.append(mixed(rolled[whole]))
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=n)
    return counts, (found[order] % np.uint64(BUCKETS)).astype(np.int64)


def word_pairs(counts: np.ndarray, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of neighbouring words in each text, and the buckets of all these pairs."""
    hashes = word_hashes(words)[codes]
    pairs = mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[1:] == owner[:-1]
    return np.maximum(counts - 1, 0), BUCKETS + (pairs[inside] % np.uint64(PAIRS)).astype(np.int64)


def by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the ``counts`` values of each text, each by itself: no text's rest enters another."""
    return np.bincount(np.repeat(np.arange(len(counts)), counts), values, len(counts))


def damped(counts: np.ndarray, codes: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes of each text: their text, the code, and the root of how often it occurs."""
    owner = np.repeat(np.arange(len(counts)), counts)
    found, times = np.unique(owner * kinds + codes, return_counts=True)
    return found // kinds, found % kinds, np.sqrt(times)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            counts, words, codes = ascii_words(filled(part.column("text")))
            sizes, buckets = word_features(words)
            starts = starts_of(sizes)
            pair_counts, pairs = word_pairs(counts, words, codes)
            total = np.maximum(summed(sizes[codes], counts) + pair_counts, 1)
            texts, kinds, weights = damped(counts, codes, len(words) + 1)
            pair_texts, pair_kinds, pair_weights = damped(pair_counts, pairs, BUCKETS + PAIRS)
            at = np.searchsorted(texts, np.arange(len(counts) + 1))
            pair_at = np.searchsorted(pair_texts, np.arange(len(counts) + 1))
            names, shares = [], []
            for row in range(len(counts)):
                own = np.zeros(BUCKETS + PAIRS, np.float32)
                mine = slice(pair_at[row], pair_at[row + 1])
                own[pair_kinds[mine]] = pair_weights[mine]
                for code, weight in zip(kinds[at[row] : at[row + 1]], weights[at[row] : at[row + 1]]):
                    np.add.at(own, buckets[starts[code] : starts[code] + sizes[code]], weight)
                names.append(np.flatnonzero(own).astype(np.int32))
                shares.append(own[names[-1]] / np.float32(total[row]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("quality").cast(pa.int32()),
                    pa.array(names, pa.list_(pa.int32())),
                    pa.array(shares, pa.list_(pa.float32())),
                ],
                names=["quality", "buckets", "shares"],
            )


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 when divided by 3."""
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))
    return F.coalesce(rest == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAINING) -> DataFrame:
    """At most ``bound`` labelled documents outside the held-out part, with features."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = stored(
        usable.where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound),
        "chosen",
    )
    texts = (
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("quality", "text")
    )
    return texts.mapInArrow(_sample_features, FEATURES)


def trained(
    features: pa.Table,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 5,
    least_steps: int = STEPS,
) -> Model:
    """Stochastic gradient descent over single documents, with a rate that falls to zero."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS + PAIRS, WIDTH)).astype(np.float32)
    weights, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    docs = []
    for quality, buckets, shares in zip(
        features.column("quality").to_pylist(), features.column("buckets"), features.column("shares")
    ):
        names = buckets.values.to_numpy()
        if len(names):
            docs.append((int(quality > 0), names, shares.values.to_numpy()))
    docs.sort(key=lambda d: (len(d[1]), int(d[1].sum()), d[0]))
    epochs = max(epochs, -(-least_steps // max(len(docs), 1)))
    steps, done = epochs * len(docs), 0
    for _ in range(epochs if docs else 0):
        for k in rng.permutation(len(docs)):
            label, names, share = docs[k]
            hidden = share @ table[names]
            logits = hidden @ weights + bias
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[label] -= 1
            step = rate * (1 - done / steps)
            back = weights @ error
            weights -= step * np.outer(hidden, error)
            bias -= step * error
            table[names] -= step * share[:, None] * back
            done += 1
    toward = weights[:, 1] - weights[:, 0]
    seen = np.zeros(len(table), bool)
    for _, names, _ in docs:
        seen[names] = True
    return Model(np.where(seen, table @ toward, np.float32(0)), float(bias[1] - bias[0]))


def _scorer(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts, words, codes = ascii_words(filled(part.column("text")))
                sizes, buckets = word_features(words)
                pair_counts, pairs = word_pairs(counts, words, codes)
                amounts = by_text(model.bucket_logits[buckets].astype(np.float64), sizes)
                texts, kinds, weights = damped(counts, codes, len(words) + 1)
                total = np.bincount(texts, amounts[kinds] * weights, len(counts))
                texts, kinds, weights = damped(pair_counts, pairs, BUCKETS + PAIRS)
                total += np.bincount(texts, model.bucket_logits[kinds] * weights, len(counts))
                features = summed(sizes[codes], counts) + pair_counts
                logits = np.clip(model.bias + total / np.maximum(features, 1), -500, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(1 / (1 + np.exp(-logits)))],
                    names=["doc_id", "score"],
                )

    return rows


def fit(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAINING) -> Model:
    """A model from at most ``bound`` labelled documents; their features come to the driver."""
    return trained(sample(docs, labels, bound).toArrow())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``."""
    return (
        docs.select("doc_id", "text")
        .mapInArrow(_scorer(model), "doc_id long, score double")
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
