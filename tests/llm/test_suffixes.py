"""Suffix dedup against a plain count of all windows."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from launchboard.llm import queries, slices, suffixes


def plain(texts, window):
    """(n_bytes, spans, kept) per text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = True
        edge = np.flatnonzero(np.diff(np.r_[False, gone]))
        spans = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        out.append((len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def corpus(window, seed=3):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefgh é漢\n") for _ in range(n))
    texts = [noise(rng.randint(0, 6 * window)) for _ in range(40)]
    passages = [noise(k) for k in (window - 2, window, window + 1, 2 * window, 9 * window)]
    for _ in range(40):  # passages at any offset, some cut, some doubled
        p = rng.choice(passages)
        cut = rng.randint(0, max(len(p) - window, 0))
        texts.append(noise(rng.randint(0, 3 * window)) + p[cut:] + noise(rng.randint(0, window)) + rng.choice(("", p[:window])))
    texts += [texts[2], texts[2], texts[5] + "x", "y" + texts[6]]  # copies, at like offsets and shifted
    for i in (41, 45, 52):  # near copies
        t = texts[i]
        texts.append(t[:len(t) // 3] + "#" + t[len(t) // 3 + 1:])
    texts += [None, "", "a", "ab" * (2 * window), "z" * (window + 1), "q" * window, noise(80 * window)]
    return texts


def rows_of(df):
    return [(r.text, r["__suffixes"].n_bytes, [(s.start, s.end) for s in r["__suffixes"].spans],
             bytes(r["__suffixes"].kept), r["__suffixes"].n_removed) for r in df.collect()]


@pytest.mark.parametrize("window, shard_bytes", [(14, 1 << 23), (40, 2000), (200, 1 << 23), (130, 5000)])
def test_removed_bytes(spark, monkeypatch, window, shard_bytes):
    monkeypatch.setattr(slices, "SHARD_BYTES", shard_bytes)
    texts = corpus(window)
    df = spark.createDataFrame([(i % 9 or None, t, "s", "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, slice string, replies string").repartition(3)
    expected = [(t, n, spans, kept, n - len(kept)) for t, (n, spans, kept) in zip(texts, plain(texts, window))]
    assert sum(x[4] for x in expected) > 10 * window
    found = suffixes.remove_repeated_bytes(df, window)
    assert found.columns == ["doc_id", "text", "slice", "replies", "__suffixes"]
    assert sorted(rows_of(found), key=repr) == sorted(expected, key=repr)


def test_covers():
    for period, cover in suffixes.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    with pytest.raises(ValueError):
        suffixes.cover_for(13)


def test_stretches_spare_suffixes(spark):
    """Copies leave only their ends to the third level."""
    import pyarrow as pa
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    state = suffixes.SliceSuffixes(pa.RecordBatch.from_pydict({"text": [text, text]}), 200)
    assert state.ranks.several.all()
    state.learn_ranks(np.full(len(state.ranks), suffixes.ALIGNED, np.uint8))
    state.cover_runs(state.stretches()[0], state.stretch)
    at, _ = state.suffixes(*state.wanted())
    assert 0 < len(at) <= 2 * 3 * state.period


def test_empty(spark, none):
    assert suffixes.remove_repeated_bytes(none).count() == 0
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [x[1:] for x in rows_of(suffixes.remove_repeated_bytes(df))] == [(0, [], b"", 0)] * 2


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = [(d.doc_id, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                for d, (n, spans, kept) in zip(docs, plain([d.text for d in docs], 200))]
    found = queries.op13_suffix_dedup(spark, sf)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert [t for _, t in found.dtypes] == ["bigint"] * 4 + ["string"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_hashes_hold_little_more_than_their_sums():
    """Nothing of a slice's size stays or comes on top but 8 bytes a position; chunks agree."""
    rng = np.random.default_rng(5)
    half = rng.integers(0, 256, 1_000_003, dtype=np.uint8)
    data = np.r_[half, half]  # the copy lies at other places of its chunks
    tracemalloc.start()
    try:
        hashes = suffixes.SubstringHashes(data, suffixes._BASES[0])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10 * len(data) + (6 << 20)
    at = np.arange(len(half) - 200)
    found = hashes.of(at, 200)
    assert (found == hashes.of(at + len(half), 200)).all()
    assert len(np.unique(found)) == len(at)
    assert (np.diff(suffixes.Distinct(found).first.astype(np.int64)[suffixes.Distinct(found).number]) == 1).all()
