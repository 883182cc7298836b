"""MinHash near duplicates against all pairs on small tables."""

import random
import re
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import bayesian_minhash

WORDS = [f"w{k}" for k in range(300)]


@pytest.fixture
def clashing(corpus):
    extra = {c: F.lit(1) for c in ("key", "class", "check", "bands", "bucket", "label", "a", "b", "n", "place")}
    return lambda rows: corpus(*rows).withColumns(extra)


def shingles(text, n=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1 if words else 0)))


def expected(rows):
    sets = {k: shingles(t) for k, t in rows}
    label = {k: k for k in sets}
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {k: (len(sets[k]), label[k]) for k in sets}


def found(df, **bounds):
    got = bayesian_minhash.near_duplicates(df, **bounds).collect()
    return {r.key.doc_id: (r.n_shingles, r.component_id) for r in got}


def near_copies(seed, groups, shares):
    """Groups around a text, most members nearer to it than to each other."""
    rng, rows = random.Random(seed), []
    passage = rng.choices(WORDS, k=30)
    for _ in range(groups):
        base = rng.choices(WORDS, k=rng.randrange(40, 160))
        for share in shares:
            rows.append([rng.choice(WORDS) + "x" if rng.random() < share else w for w in base])
        rows.append(rng.choices(WORDS, k=40) + passage)
    rng.shuffle(rows)
    return [(10 + k, rng.choice([" ", "\n"]).join(w)) for k, w in enumerate(rows)]


def test_against_all_pairs(clashing):
    rows = near_copies(1, 8, (0, 0, 0.01, 0.02, 0.02, 0.03, 0.04))
    rows += [(500 + k, t) for k, t in enumerate(["", None, "one", "ONE", "a b c d", "a  b c d e", " \n", "É b c d", "é b c d"])]
    want = expected(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 20
    assert found(clashing(rows)) == want


def test_one_group_of_many_near_copies(clashing):
    rows = near_copies(2, 1, [0] + [0.03] * 60)
    assert found(clashing(rows)) == expected(rows)


def test_near_copies_that_do_not_link_are_not_compared_in_pairs(corpus, monkeypatch):
    """Copies at 0.7 of a text share buckets with each other and nearly all their shingles with some
    other; their maps tell that they cannot link."""
    rng, counted, kept = random.Random(7), [], bayesian_minhash.stored

    def stored(df, label):
        out = kept(df, label)
        if label == "pairs":
            counted.append(out.count())
        return out

    monkeypatch.setattr(bayesian_minhash, "stored", stored)
    base = [f"b{k}" for k in range(150)]
    rows = [(0, " ".join(base))]
    for k in range(1, 61):
        changed = set(rng.sample(range(5, 145, 5), 6))
        rows.append((k, " ".join(f"c{i}" if i in changed else w for i, w in enumerate(base))))
    rows.append((61, " ".join(base[:-1])))
    assert found(corpus(*rows)) == expected(rows)
    # The first round compares a pivot of each bucket with the others.
    assert sum(counted[1:]) <= len(rows), counted


def test_long_sets_in_fragments(clashing):
    rng = random.Random(3)
    base = [str(rng.random()) for _ in range(36_000)]
    other = [w + "x" if rng.random() < 0.04 else w for w in base]
    rows = [(1, " ".join(base)), (2, " ".join(base[:31_000])), (3, " ".join(other)), (4, " ".join(base[:20_000]))]
    assert bayesian_minhash._bits(36_000) == 1 and bayesian_minhash._bits(31_000) == 0
    assert found(clashing(rows)) == expected(rows)


def test_edges(corpus):
    assert found(corpus((1, "a")).where("false")) == {}
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (4, "other text"), (None, None)]
    got = bayesian_minhash.near_duplicates(corpus(*rows)).collect()
    assert sorted((r.key.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 0, 0), (0, 2, 4), (4, 1, 4), (4, 2, 4), (4, 2, 4),
    ]


def test_bounds_of_the_posterior():
    least = bayesian_minhash.least_matches(80, 1e-6, 64, 32)

    def reaches(m, n):
        return sum(comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))

    for n, m in zip((32, 64), least):
        assert reaches(m, n) >= 1e-6 > reaches(m - 1, n)
    # The posterior itself, by summing the likelihood over a fine grid of similarities.
    grid = (np.arange(200_000) + 0.5) / 200_000
    weight = grid ** least[0] * (1 - grid) ** (32 - least[0])
    assert weight[grid >= 0.8].sum() / weight.sum() == pytest.approx(reaches(least[0], 32), rel=1e-3)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[1000:])
    signs = bayesian_minhash.signatures(np.array([2000, 2000]), np.concatenate([a, b]) * np.uint64(2), 600)
    assert abs((signs[0] == signs[1]).mean() - 1 / 3) < 0.06
