"""Each registered query on the smallest tables: its columns, and what follows from the texts."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from launchboard.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def kinds(df):
    return dict(df.dtypes)


def remainder(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


def test_op1_and_op4(spark, texts):
    found = queries.op1_near_duplicates(spark, SF)
    assert kinds(found) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert {r.doc_id: r.n_shingles for r in found.collect()} == {d: len(brute.shingles(t, 3)) for d, t in texts.items()}
    found = queries.op4_substring_dedup(spark, SF)
    assert kinds(found) == {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}
    assert {r.doc_id: r.n_words for r in found.collect()} == {d: len(brute.words(t)) for d, t in texts.items()}


def test_op2(spark, texts):
    found = queries.op2_decontamination(spark, SF)
    assert set(kinds(found)) == {"doc_id", "item_id", "start", "n_words", "distance"}
    items = {r.item_id: brute.words(r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = found.collect()
    assert rows
    for r in rows:
        window = brute.words(texts[r.doc_id].lower())[r.start:r.start + r.n_words]
        assert brute.edit_distance(items[r.item_id], window) == r.distance <= 0.2 * len(items[r.item_id])


def test_op3(spark, texts):
    found = queries.op3_quality_rules(spark, SF)
    assert {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"} <= {c for c, t in found.dtypes if t == "bigint"}
    for r in found.collect():
        n, chars, symbols, lines, repeats = brute.statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n) and not (r.base_failed and r.kept)


def test_op5(spark):
    found = {r.page_id: r for r in queries.op5_url_filter(spark, SF).collect()}
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    for page in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect():
        host = path = ""
        if page.url and "://" in page.url:
            rest = page.url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = rest[:cut].translate(brute.LOWER)
            path = rest[cut:].split("?")[0].split("#")[0]
        fits = [x for x in rules if (host == (h := x.split("/")[0]) or host.endswith("." + h)) and path.startswith(x[len(h):])]
        rule = max(fits, key=len, default=None)
        r = found[page.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert rule is None or r.verdict == rules[rule]


def test_op6(spark, texts):
    found = queries.op6_quality_model(spark, SF)
    assert kinds(found) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = found.collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op7(spark, texts):
    found = queries.op7_best_fit_packing(spark, SF)
    assert kinds(found) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint",
                            "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, places = set(), defaultdict(list)
    for d, t in texts.items():
        ids = np.array(model.encode(t, add_special_tokens=False).ids + [1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            expected.add((d, k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())))
    rows = found.collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        ends = np.cumsum([n for _, n in sorted(found)])
        assert [a for a, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_op8(spark):
    assert "doc_id" in queries.op8_license_scan(spark, SF).columns


def test_op9(spark, texts):
    found = queries.op9_token_counts(spark, SF)
    assert kinds(found) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect()}
    for d, t in texts.items():
        n = len(model.encode(t, add_special_tokens=False).ids)
        assert rows[d] == (len(t.encode()), n, n > 512)


def test_op10(spark, texts):
    found = queries.op10_lm_scoring(spark, SF)
    assert kinds(found) == {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                            "train_tokens": "bigint", "base_score": "double", "score": "double"}
    train = [t for d, t in texts.items() if remainder(d, 10)]
    n = sum(len(brute.words(t)) + 1 for t in train)
    for r in found.collect():
        assert r.held_out == (remainder(r.doc_id, 10) == 0) and r.train_tokens == n
        assert r.n_tokens == len(brute.words(texts[r.doc_id])) + 1 and r.score <= 0
