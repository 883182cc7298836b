"""Spelling variants against a loop on small tables."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwork.llm import spelling_blocks


@pytest.fixture
def clashing(corpus):
    extra = {c: F.lit(1) for c in ("word", "n", "run", "h", "id", "block", "chunk", "near", "root", "form")}
    return lambda rows: corpus(*rows).withColumns(extra)


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            words[low] += len(low) >= 7
    return {w: n for w, n in words.items() if n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def expected(rows):
    words = counted(rows)
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(out)


def texts(seed, docs, letters="abÀÿé"):
    rng = random.Random(seed)
    bases = ["".join(rng.choices(letters, k=rng.randrange(6, 12))) for _ in range(25)]
    for doc in range(docs):
        words = []
        for _ in range(60):
            w = bases[min(int(rng.expovariate(0.3)), 24)]
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice(letters), w[k] + rng.choice(letters)]) + w[k + 1 :]
            words.append(rng.choice([w, w, w.upper(), w + "1"]))
        yield doc, rng.choice([" ", "\n", "_"]).join(words)


def found(df, **bounds):
    got = spelling_blocks.variants(df, **bounds)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(tuple(r) for r in got.collect())


def test_against_a_loop(clashing):
    rows = list(texts(1, 120))
    want = expected(rows)
    assert sum(r[3] is not None for r in want) > 20
    assert found(clashing(rows)) == want


def test_small_chunks_and_many_groups(clashing):
    rows = list(texts(2, 60, "abcde"))
    assert found(clashing(rows), chunk=60, mates=3) == expected(rows)


def test_chains_of_forms(clashing):
    rows = [(k, "aaaaaaaaa " * 400 + "aaaaaaaab " * 30 + "aaaaaaabb aaaaaaabb") for k in range(1, 4)]
    got = {r[0]: r for r in found(clashing(rows))}
    assert found(clashing(rows)) == expected(rows)
    assert got["aaaaaaabb"][5] == "aaaaaaaaa"


def test_edges(clashing):
    long = "x" * 30_000
    rows = [
        (1, None), (2, ""), (None, "Äpfelmuß äpfelmuß Äpfelmuß äpfelmuß"), (3, f"{long} {long}y {long}"),
        (3, f"{long} {long}y {long}"), (4, "sixsix sevensev SEVENSEV seven×sev seven×sev"),
    ]
    assert found(clashing(rows)) == expected(rows)
    assert found(clashing([(1, "short")])) == []
    assert found(clashing(rows).where("false")) == []
