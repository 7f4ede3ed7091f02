"""The second lists of near-dedup: no link lost, few pairs verified."""

import random

import numpy as np
import pytest

from launchboard.llm import near_dup
from launchboard.llm.store import Scratch
from tests.llm import brute


def near_copies(n, size, changed, seed=1):
    """Copies of one text with ``changed`` words replaced by words of their own."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for d in range(n):
        w = list(base)
        for k in rng.sample(range(size), changed):
            w[k] = f"own{d}x{k}"
        out.append((d, " ".join(w)))
    return out


def kept_tables(monkeypatch):
    rows = {}
    keep = Scratch.keep

    def watch(self, df, name):
        out = keep(self, df, name)
        if name.startswith("passed-"):
            rows[name] = [tuple(r) for r in out.collect()]
        return out
    monkeypatch.setattr(Scratch, "keep", watch)
    return rows


def test_far_near_copies_meet_nobody(spark, monkeypatch):
    docs = near_copies(400, 300, 9)
    sets = [brute.shingles(t, 3) for _, t in docs]
    far = [len(a & b) / len(a | b) for a, b in zip(sets, sets[1:])]
    assert 0.65 < np.mean(far) < 0.82
    passed = kept_tables(monkeypatch)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = near_dup.near_duplicates(df, 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(d, c) for d, _, c in brute.components(docs, 3, 85)]
    assert sum(map(len, passed.values())) < 2 * len(docs)  # of 79,800 pairs


@pytest.mark.parametrize("second", [2048, 100, 260])
def test_links_of_mixed_distances(spark, monkeypatch, second):
    """Classes whose values are all retained, some of them, and pairs of either."""
    monkeypatch.setattr(near_dup, "SECOND", second)
    docs = [(d + 1000 * k, t) for k, changed in enumerate((1, 4, 6, 8)) for d, t in near_copies(25, 200 + 60 * k, changed, k)]
    rng = random.Random(2)
    for d, t in list(docs):  # chains, and texts that are parts of others
        w = t.split()
        docs.append((d + 500, " ".join(w[rng.randrange(20):len(w) - rng.randrange(25)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = near_dup.near_duplicates(df, 3, 85).collect()
    expected = brute.components(docs, 3, 85)
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted((d, c) for d, _, c in expected)
    assert len({c for _, _, c in expected}) < len(docs)
