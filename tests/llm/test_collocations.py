"""Collocations against plain counting, and the FM-index against plain search."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from launchboard.llm import collocations, fm_index, queries
from launchboard.llm.fm_index import FMIndex, containing
from tests.llm.brute import LOWER


def plain(docs, least, top):
    """Rows (lang, rank, phrase, a, l, r, n, score)."""
    count, total = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    count[lang, tuple(w[i:i + k])] += 1
    frequent = {key: a for key, a in count.items() if a >= least and len(key[1]) > 1}
    found = {}
    for (lang, p), a in frequent.items():
        cuts = [(count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p))]
        score, _, l, r = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        longer = [b for (other, q), b in frequent.items() if other == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if all(100 * b < 80 * a for b in longer):
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, total[lang], -s) for lang, rows in found.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1))


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["la", "Le", "é", "to", "a", "a", "b", "x-y", "#", "ÄB", "z\x00z"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" "] * 8 + ["\t", "  ", ". ", ",", "\n", "\x0b", "! "]) for _ in range(60))
        if i % 3 == 0:
            text += " new york city hall new york"
        if i % 4 == 0:
            text += "; San Francisco bay, aa aa aa aa aa"
        out.append((rng.choice(["en", "en", "en", "de", None, "und", "a b"]), text))
    return out + [("en", None), (None, ""), ("fr", " .,;"), ("en", "x" * 10_000), ("es", "only one")]


@pytest.mark.parametrize("shard_bytes, top", [(1 << 24, 2000), (3000, 7)])
def test_collocations(spark, monkeypatch, shard_bytes, top):
    monkeypatch.setattr(collocations, "HASH_SHARD_BYTES", 20_000)
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard_bytes)
    docs = corpus(1)
    df = spark.createDataFrame([(t, lang, 1, "s", 2) for lang, t in docs],
                               "text string, lang string, number int, shard string, n int").repartition(4)
    found = collocations.top_collocations(df, top, 8)
    expected = plain(docs, 8, top)
    assert len(expected) > 20
    assert sorted(map(tuple, found.drop("left_extension", "right_extension").collect())) == expected


def test_extensions(spark):
    docs = [("en", "a b c")] * 9 + [("en", "a b d")] * 40 + [("en", "x a b")] * 6
    df = spark.createDataFrame([(t, lang) for lang, t in docs], "text string, lang string")
    rows = {r.phrase: r for r in collocations.top_collocations(df, 10, 6).collect()}
    assert (rows["a b"].left_extension, rows["a b"].right_extension) == (6, 40)


def test_index():
    rng = np.random.default_rng(2)
    text = np.r_[0, rng.integers(0, 4, 400), 0]
    index = FMIndex.unpack(FMIndex.of(text).pack())
    occurs = lambda p: sum(tuple(text[i:i + len(p)]) == p for i in range(len(text)))
    level, names = index.symbols(np.arange(3)), [(1,), (2,), (3,)]
    for side in ("right", "left", "right"):
        new, of = index.extend(level, side)
        longer = []
        for k, (low, size) in enumerate(zip(new.low, new.size)):
            # the symbol that was added, from where the interval lies
            fits = [c for c in (1, 2, 3) if occurs(names[of[k]] + (c,) if side == "right" else (c,) + names[of[k]]) == size]
            taken = [n for n in longer]
            name = next(n for c in fits for n in [names[of[k]] + (c,) if side == "right" else (c,) + names[of[k]]]
                        if n not in taken)
            longer.append(name)
        every = {tuple(text[i:i + len(longer[0])]) for i in range(len(text) - len(longer[0]) + 1)}
        assert set(longer) == {e for e in every if 0 not in e}
        for low in (new.low, new.reverse_low):  # intervals of one length are disjoint
            order = np.argsort(low)
            assert (low[order][1:] >= (low + new.size)[order][:-1]).all()
        assert (containing(level.low if side == "right" else level.reverse_low, level.size,
                           new.low if side == "right" else new.reverse_low) == of).all()
        level, names = new, longer


def test_score_beyond_64_bits(spark):
    grams = spark.createDataFrame([(1, "en", ["a", "b"], 9 * 10**12, [9 * 10**12 + 1], [10**13])],
                                  "number long, lang string, words array<string>, a long, prefixes array<long>, suffixes array<long>")
    row = collocations.scored([grams, grams]).first()
    assert row.score == 2000000 * 9 * 10**12 // (9 * 10**12 + 1 + 10**13)


def test_empty(spark, none):
    found = collocations.top_collocations(none)
    assert found.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.op12_collocations(spark, sf)
    assert [t for _, t in found.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, found.collect())) == plain(docs, 30, 2000)


def test_numbers_travel_without_their_empty_bytes():
    rng = np.random.default_rng(2)
    for kind, most in ((np.int64, 1 << 20), (np.uint32, 200)):
        values = rng.integers(0, most, 5000).astype(kind)
        body = collocations._squeeze(values)
        assert len(body) < 0.45 * values.nbytes
        assert (collocations._spread(body, len(values), kind) == values).all()
    number = np.where(rng.random(5000) < 0.5, rng.integers(0, 1 << 20, 5000), -1)
    body = collocations._write(number)
    assert len(body) < 0.45 * 8 * (number >= 0).sum() + 5000 // 8 + 1
    assert (collocations._read(body, 5000) == number).all()
    none = np.full(9, -1)
    assert (collocations._read(collocations._write(none), 9) == none).all()
    assert len(collocations._spread(collocations._squeeze(none[:0]), 0, np.int64)) == 0


def test_index_of_a_shard_takes_little_memory(monkeypatch):
    """Extending the patterns of a shard takes a few bytes a word, in parts as in one go."""
    rng = np.random.default_rng(7)
    text = np.minimum(rng.zipf(1.3, 600_000), 30_000) * (rng.random(600_000) > 0.1)
    text[[0, -1]] = 0
    body = FMIndex.of(text).pack()
    numbers = collocations._pack_numbers(np.arange(30_000))

    def levels():
        state, out = collocations.Level(body, numbers), []
        for _ in range(3):
            new, left, right = state.extend()
            out.append((new, left, right))
            new.number[:] = np.where(new.size > 1, np.arange(len(new.size)), -1)
            state.patterns, state.length = new.take(np.flatnonzero(new.number >= 0)), state.length + 1
        return out

    tracemalloc.start()
    try:
        collocations.Level(body, numbers).extend()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 * len(text)
    parts = levels()
    monkeypatch.setattr(fm_index, "CHUNK_ROWS", 1 << 40)
    for (a, *x), (b, *y) in zip(parts, levels()):
        for c in ("low", "reverse_low", "size", "number"):
            assert np.array_equal(getattr(a, c), getattr(b, c))
        assert all(map(np.array_equal, x, y))
