"""The prefix trie of conversations against a loop on small tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture
def turns(spark, corpus):
    extra = {c: F.lit(1) for c in ("a", "b", "x", "y", "row", "part", "pos", "lead", "depth", "segment", "n")}
    return lambda rows: spark.createDataFrame(rows, TURNS).withColumns(extra)


def expected(rows):
    """Nodes by the definition; turns of one number must be equal or absent."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    talks = {c: [t[1:] for t in sorted(ts)] for c, ts in talks.items()}
    whole = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - int(math.fmod(c, 100))
        whole[c] = talks.get(donor, [])[:h] + own[h:]
    nodes = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if len(whole[c]) == len(path))
        out[path] = (
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in below),
            sum(not any(q[: len(p)] == p and len(q) > len(p) for q in below) for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(out.values(), key=repr)


def found(turns, rows, size=prefix_trie.SEGMENT, **bounds):
    nodes = prefix_trie.trie(prefix_trie.rebuilt(turns(rows), size), size, **bounds)
    assert tuple(nodes.columns) == prefix_trie.COLUMNS
    return sorted((tuple(r) for r in nodes.collect()), key=repr)


def talks(seed, convs, first=0, words=3, most=8):
    rng = random.Random(seed)
    for c in rng.sample(range(first, first + 6 * convs), convs):
        for t in range(rng.randrange(1, most)):
            yield c, t, rng.choice(["user", "assistant"][: 1 + t % 2]), "é" * rng.randrange(1, words)


def test_random_conversations(turns):
    rows = list(talks(1, 60)) + list(talks(2, 20, 1000, 2, 4))
    assert found(turns, rows) == expected(rows)


def test_small_shards_and_segments(turns):
    """Most nodes are shared by shards, and conversations have several segments."""
    rows = list(talks(3, 40, 0, 2, 14))
    rows += [(c, t, "user", "same") for c in range(2000, 2030) for t in range(9)]
    assert found(turns, rows, 4, leading=2, limit=20) == expected(rows)


def test_edges(turns):
    rows = [
        (0, None, "user", "first"), (0, 1, None, "b"), (0, 2, "", None), (0, 3, "user", "d"),
        (0, 3, "user", "d"), (7, 0, "user", "a"), (8, None, None, None), (None, 1, "user", "x"),
        (-5, 0, "user", "first"), (205, 0, "user", "q"), (300, 5, "user", "long " * 20_000),
    ]
    assert found(turns, rows) == expected(rows)
    assert found(turns, [(None, 1, "user", "x")]) == []


def test_equal_numbers_have_one_order(turns):
    rows = [(100, 0, "user", "a"), (100, 0, "user", "b"), (100, 1, "user", "c")]
    again = found(turns, rows[::-1])
    assert found(turns, rows) == again
    assert [r[1] for r in again] == [0, 1, 2, 3]


def test_double_array_keeps_every_sequence():
    rng = random.Random(5)
    words = [[rng.randrange(1, 30) for _ in range(rng.randrange(1, 7))] for _ in range(3000)]
    counts = np.array([len(w) for w in words])
    symbols = np.array([s for w in words for s in w])
    starts = np.cumsum(counts) - counts
    trie = prefix_trie.DoubleArray(4)
    root = np.zeros(len(words), np.int64)
    prefix_trie._levels(trie, root, symbols, starts, counts, grow=True)
    at = prefix_trie._levels(trie, root, symbols, starts, counts, grow=False)
    paths = {}
    for k, w in enumerate(words):
        for d in range(len(w)):
            assert paths.setdefault(int(at[starts[k] + d]), tuple(w[: d + 1])) == tuple(w[: d + 1])
    assert len(paths) == len({p for p in paths.values()})
    assert (trie.check >= 0).sum() == len(paths) + 1
