"""Spelling variants against a plain search over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from launchboard.llm import queries, spelling
from launchboard.llm.store import Scratch
from tests.llm.brute import LOWER, edit_distance


def plain_vocabulary(docs, typo_every=31):
    count = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and typo_every and h % typo_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def plain_variants(n):
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and edit_distance(v, w) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def corpus(seed, alphabet, n_words, n_docs, length=10):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, length))) for _ in range(n_words)]
    docs = []
    for d in range(n_docs):
        text = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.08)), n_words - 1)]
            if rng.random() < 0.08:
                k = rng.randrange(len(w))
                w = rng.choice((w[:k] + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k:],
                                w[:k] + rng.choice(alphabet) + w[k + 1:], w.upper()))
            text.append(w)
        docs.append((d, rng.choice((" ", ", ", "-", "1", "\n", "ß×ő")).join(text)))
    return docs


ODD = [(None, "abcdefgh abcdefgh abcdefgi"), (900, None), (901, ""), (902, "AbcdefghÉté ABCDEFGHÉté abcdefghété"),
       (903, "x" * 400 + " " + "x" * 400 + " " + "x" * 399 + " " + "x" * 399), (904, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa baaaaaaa baaaaaaa"),
       (904, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa baaaaaaa baaaaaaa"), (905, "×÷×÷×÷× " * 3)]


@pytest.mark.parametrize("state_words", [20_000, 12])
@pytest.mark.parametrize("alphabet, length", [("ab", 11), ("abcdé", 9)])
def test_variants(spark, monkeypatch, alphabet, length, state_words):
    monkeypatch.setattr(spelling, "STATE_WORDS", state_words)
    docs = corpus(3, alphabet, 150, 60, length) + ODD
    df = spark.createDataFrame([(d, t, "w", "n", 1) for d, t in docs],
                               "doc_id long, text string, word string, form string, n int").repartition(3)
    found = sorted(map(tuple, spelling.spelling_variants(df).collect()), key=repr)
    expected = plain_variants(plain_vocabulary(docs))
    assert sum(x[4] for x in expected) > 40 and any(x[1] for x in expected)
    assert found == sorted(expected, key=repr)


def test_pairs_once(spark, monkeypatch):
    monkeypatch.setattr(spelling, "STATE_WORDS", 5)
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(7, 10))) for _ in range(250)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    pairs = [frozenset((r.a, r.b)) for r in spelling.near_pairs(df, Scratch(spark, "t")).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((v, w)) for v in words for w in words if v < w and edit_distance(v, w) == 1}


def test_long_chain_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}") for i in range(20)], "word string, form string")
    found = spelling.follow(forms, Scratch(spark, "t"))
    assert {r.root for r in found.collect()} == {"w20"}


def test_empty(spark, none):
    found = spelling.spelling_variants(none)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found.count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.op11_spelling_variants(spark, sf)
    assert dict(found.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint",
                                  "n_near": "bigint", "form_n": "bigint"}
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    n = plain_vocabulary(docs)
    assert {(r.word, r.n) for r in found.collect()} == set(n.items())
