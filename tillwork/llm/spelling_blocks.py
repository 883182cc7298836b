"""Spelling variants of a corpus' words, by blocked Gram matrices of letter counts.

1. Words are counted over the whole corpus; those that occur often enough are the vocabulary.
2. One inserted or deleted letter moves a word's letter counts by a squared distance of one, a
   replaced letter by two. Letters are dealt to groups, and a block holds the words with the same
   number of letters in each group, so the same length: near words lie in one block, in blocks that
   differ by one letter of a group (adjacent lengths), or by one letter moved between two groups.
3. Each pair of such blocks is a row. A task multiplies their count matrices; the product with the
   norms appended is the squared distance, and pairs at most two apart are verified letter by
   letter.
4. Each word gets its most frequent near word, if that is frequent enough, as its form; forms are
   followed to the last one by pointer doubling.

Scale: counting is combined before its shuffle. A block is cut into chunks of ``CHUNK`` letters, and
the number of letter groups grows until a word shares its block with no more than ``MATES`` words on
average, so that the work for a word stays about the same as the vocabulary grows. Blocks that have
no neighbour form no row. The driver sees letter frequencies, a bounded alphabet, and sums.

Edge cases: a null or empty text has no words; a null id counts as an empty one in the checksum.
Repeated rows count as often as they occur. Very long runs are words like others, alone in their
chunk. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.components import stored
from tillwork.llm.positional_index import LOWER, UPPER

# What a run is made of, which runs lose a letter, and what a word is.
RUN = "[a-zÀ-ÿ]"
SLIP = 31
LEAST_LETTERS, LEAST_COUNT = 7, 2
TIMES = 10  # a form is so many times as frequent as its variant

CHUNK = 40_000
MATES = 2_500
GROUPS = range(4, 13)
STRIPE = 256  # rows of a product held at once

PAIRS = "word string, n long, near string, near_n long"


def _lowered(text: Column) -> Column:
    """A-Z in lower case and no other letter; a text of ASCII alone takes the faster function."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` for the words of ``docs``. One run in ``SLIP`` loses a letter, both
    chosen by the checksum of document and run."""
    text = F.coalesce(docs["text"], F.lit(""))
    runs = docs.select(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(_lowered(text), F.lit(f"{RUN}{{{LEAST_LETTERS},}}"), F.lit(0))).alias("run"),
    )
    checked = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (
        checked.select(F.when(F.col("h") % SLIP == 0, rest).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= LEAST_LETTERS)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
    )


def _grouped(letters: list[tuple[str, int]], groups: int) -> list[str]:
    """Letters dealt to groups of about equal weight, the most frequent first."""
    dealt, weight = [""] * groups, [0] * groups
    for letter, n in sorted(letters, key=lambda x: (-x[1], x[0])):
        k = weight.index(min(weight))
        dealt[k] += letter
        weight[k] += n
    return dealt


def _block(groups: list[str]) -> Column:
    """How many letters of each group a word has."""
    return F.array(
        *(F.length("word") - F.length(F.translate("word", g, "")) if g else F.lit(0) for g in groups)
    )


def _blocks(words: DataFrame, chunk: int, mates: int) -> tuple[DataFrame, int]:
    """Rows (block, chunk, words, ns): packed chunks of blocks, and the number of groups."""
    letters = (
        words.select(F.explode(F.split("word", "")).alias("letter"))
        .groupBy("letter")
        .agg(F.count("*").alias("n"))
        .where("letter <> ''")
    )
    dealt = [(r.letter, r.n) for r in letters.collect()]
    for groups in GROUPS:
        placed = words.withColumn("block", _block(_grouped(dealt, groups)))
        sizes = stored(
            placed.groupBy("block").agg(F.count("*").alias("size"), F.sum(F.length("word")).alias("letters")),
            "sizes",
        )
        mean = sizes.agg(F.sum(F.col("size").cast("double") * F.col("size")) / F.sum("size")).first()[0]
        if (mean or 0) <= mates:
            break
    chunks = F.ceil(F.col("letters") / chunk)
    packed = (
        placed.join(sizes, "block")
        .groupBy("block", F.pmod(F.xxhash64("word"), chunks).cast("int").alias("chunk"))
        .agg(F.collect_list(F.struct("word", "n")).alias("held"))
        .select("block", "chunk", F.col("held.word").alias("words"), F.col("held.n").alias("ns"))
    )
    return stored(packed, "blocks"), groups


def _steps(groups: int) -> Column:
    """The differences between neighbouring blocks, one of each two opposite ones."""

    def moved(plus: int | None, minus: int | None) -> Column:
        return F.array(*(F.lit(int(k == plus) - int(k == minus)) for k in range(groups)))

    return F.array(
        moved(None, None),
        *(moved(i, None) for i in range(groups)),
        *(moved(i, j) for i in range(groups) for j in range(i)),
    )


def _pairs_of_blocks(blocks: DataFrame, groups: int) -> DataFrame:
    """Neighbouring chunks that exist, each two once: words and counts of both, and ``same`` for a
    chunk with itself."""
    names = blocks.select("block", "chunk")
    near = names.select(
        F.col("block").alias("from_block"), F.col("chunk").alias("from_chunk"), F.explode(_steps(groups)).alias("step")
    ).select(
        "from_block",
        "from_chunk",
        F.zip_with("from_block", "step", lambda have, more: have + more).alias("block"),
    )
    inside = F.col("from_block") == F.col("block")
    pairs = near.join(names, "block").where(~inside | (F.col("from_chunk") <= F.col("chunk")))
    left = blocks.select(
        F.col("block").alias("from_block"), F.col("chunk").alias("from_chunk"),
        F.col("words").alias("left_words"), F.col("ns").alias("left_ns"),
    )
    return (
        stored(pairs, "pairs")
        .join(left, ["from_block", "from_chunk"])
        .join(blocks, ["block", "chunk"])
        .select(
            "left_words",
            "left_ns",
            "words",
            "ns",
            (inside & (F.col("from_chunk") == F.col("chunk"))).alias("same"),
        )
    )


def _letters(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _counts(codes: np.ndarray, names: np.ndarray, kind: type) -> np.ndarray:
    """How often each word has each letter."""
    at = np.searchsorted(names, codes) + np.arange(len(codes))[:, None] * len(names)
    return np.bincount(at.ravel(), minlength=len(codes) * len(names)).reshape(len(codes), -1).astype(kind)


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced or one inserted letter."""
    n = short.shape[1]
    if n == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    head = np.minimum.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    tail = np.minimum.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


def near_words(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) one edit apart, of letters of equal or adjacent lengths; of two equal blocks
    each pair once."""
    names = np.union1d(np.unique(left), np.unique(right))
    kind = np.float32 if right.shape[1] < 1000 else np.float64
    a, b = _counts(left, names, kind), _counts(right, names, kind)
    half_a, half_b = ((x * x).sum(axis=1, keepdims=True) / 2 for x in (a, b))
    one = np.ones((len(a), 1), kind)
    a = np.hstack([a, -half_a, one])
    b = np.hstack([b, np.ones((len(b), 1), kind), -half_b])
    found = []
    for low in range(0, len(a), STRIPE):
        # The product is minus half the squared distance.
        i, j = np.nonzero(a[low : low + STRIPE] @ b.T >= -1)
        i += low
        if same:
            i, j = i[i < j], j[i < j]
        short, long = (left[i], right[j]) if left.shape[1] <= right.shape[1] else (right[j], left[i])
        ok = _one_edit(short, long)
        found.append((i[ok], j[ok]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of every near pair of each pair of chunks."""
    for batch in batches:
        for k in range(batch.num_rows):
            sides = []
            for words, ns in (("left_words", "left_ns"), ("words", "ns")):
                held = batch.column(words)[k].values
                sides.append((held, batch.column(ns)[k].values, _letters(held.to_pylist())))
            (left, left_n, a), (right, right_n, b) = sides
            i, j = (pa.array(x) for x in near_words(a, b, batch.column("same")[k].as_py()))
            there = (left.take(i), left_n.take(i), right.take(j), right_n.take(j))
            for order in ((0, 1, 2, 3), (2, 3, 0, 1)):
                yield pa.RecordBatch.from_arrays(
                    [there[x] for x in order], names=["word", "n", "near", "near_n"]
                )


def near_pairs(words: DataFrame, chunk: int = CHUNK, mates: int = MATES) -> DataFrame:
    """All (word, n, near, near_n) of words that differ by one letter, in both directions."""
    blocks, groups = _blocks(words, chunk, mates)
    return _pairs_of_blocks(blocks, groups).mapInArrow(_near, PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for words with a form. A form is ten times as frequent as its word, so
    that chains are short and have no rings."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(roots.join(ahead, "root", "left"), "chains")
        if longer.where(F.col("next").isNotNull()).isEmpty():
            return roots
        roots = longer.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, chunk: int = CHUNK, mates: int = MATES, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``n_near`` (near words), ``form`` (the near word with the largest count, if
    that is ``times`` the word's), ``form_n``, and ``root``, the last of the chain of forms."""
    words = stored(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("word")))
    near = near_pairs(words, chunk, mates).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.minus") >= F.col("n") * times
    found = stored(
        near.select(
            "word",
            "n_near",
            F.when(frequent, F.col("best.word")).alias("form"),
            F.when(frequent, -F.col("best.minus")).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return (
        words.join(found, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
