"""Operators against brute force on odd rows, and on empty tables."""

import hashlib
import itertools
import random
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from launchboard.llm import (decontaminate, kneser_ney, license_scan, near_dup, packing, quality_model,
                             quality_rules, repeats, tokens, url_filter)
from launchboard.llm.words import Words, blocks, window_hashes
from tests.llm import brute
from tests.llm.conftest import sentence


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def same(a, b):
    assert a == sorted(b, key=repr)


def test_words_and_windows():
    texts = ["a bb  ccc\n", None, "", "é Ab c\x0bdd", " \t", "zz", "a bb ccc a bb ccc"]
    w = Words(pa.array(texts).slice(1))
    found = [bytes(w.data[s:e]).decode() for s, e in zip(w.starts, w.ends)]
    assert found == [x for t in texts[1:] for x in brute.words(t)]
    assert w.counts.tolist() == [len(brute.words(t)) for t in texts[1:]]
    h = w.hashes()
    assert len(set(h.tolist())) == len(set(found))
    for k in (1, 2, 3):
        x = window_hashes(h, k)[w.first[5]:]
        assert x[0] == x[3] or k > 3
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert sum(b.num_rows for b in blocks(iter([batch]), max_bytes=70)) == len(texts)


@pytest.mark.parametrize("words, percent", [(3, 85)])
def test_near_duplicates(odd, rows, words, percent):
    expected = brute.components(rows, words, percent)
    found = near_dup.near_duplicates(odd, words, percent)
    same(got(found, "doc_id", "n_shingles", "component_id"), expected)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found.collect())


def test_drop_duplicates_keeps_one_of_each_group(odd, rows):
    expected = brute.components(rows, 5, 80)
    kept = [(d, t) for (d, t), (_, _, c) in zip(rows, expected) if d is None or d == c]
    out = near_dup.drop_duplicates(odd)
    assert out.schema == odd.schema
    same(got(out, "doc_id", "text"), kept)


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = sentence(rng, 120).split(" ")
    rows = []
    for i in range(150):
        w = list(base)
        for k in range(3):
            w[(7 * i + 40 * k) % 120] = f"edit{i}-{k}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(got(near_dup.near_duplicates(docs, 3, 85), "doc_id", "n_shingles", "component_id"),
         brute.components(rows, 3, 85))


def test_decontamination(spark, odd, rows):
    rng = random.Random(2)
    texts = {}
    for d, t in rows:
        if d is not None and t:
            texts.setdefault(d, t)
    items = [(i, " ".join(texts[d].split()[4:4 + n])) for i, (d, n) in enumerate(
        [(0, 15), (11, 24), (12, 33), (20, 16), (30, 18)])]
    items += [(50, None), (51, ""), (52, items[1][1]), (53, "Absent words only in this benchmark item of ten words")]
    for i in (60, 61, 62, 63):  # edited copies
        w = texts[40 + i % 4].split()[:20]
        for _ in range(i - 59):
            w[rng.randrange(len(w))] = "edited"
        items.append((i, " ".join(w).upper()))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(odd, table)
    short = [(d, t) for d, t in rows if t is None or len(t) < 20_000]
    expected = brute.leaks(short, items, decontaminate.EDIT_RATE)
    mine = {(r["doc_id"], r["item_id"]): (r["distance"], r["start"]) for r in found.collect() if r["doc_id"] not in (100, 7, 8, None)}
    assert mine == {k: v for k, v in expected.items() if k[0] not in (100, 7, 8, None)}
    kept = decontaminate.drop_leaking(odd, table)
    assert kept.schema == odd.schema
    gone = {d for d, _ in expected}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {d for d, _ in rows} - gone
    assert decontaminate.find_leaks(odd, table.limit(0)).count() == 0


def test_distances_to_the_best_beginning():
    rng = np.random.default_rng(3)
    for n, width in ((1, 1), (5, 7), (17, 14), (17, 20)):
        a, b = rng.integers(1, 4, (40, n)).astype(np.uint64), rng.integers(1, 4, (40, width)).astype(np.uint64)
        for k in (3, 99):
            distance, length = decontaminate.distances_within(a, b, k)
            rows = [brute.edit_rows(x, y) for x, y in zip(a.tolist(), b.tolist())]
            assert distance.tolist() == [min(min(r), k + 1) for r in rows]
            assert all(r[m] == d for r, m, d in zip(rows, length.tolist(), distance.tolist()) if d <= k)


@pytest.mark.parametrize("alone", [False, True])
@pytest.mark.parametrize("share", [0.5, 1.0])
def test_recall_of_unclipped_edits(share, alone):
    """Items of 15 to 400 words after half and all of the allowed edits, of any kind, inside
    a text or as all of it."""
    rng = random.Random(int(10 * share) + alone)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    sizes = [15, 24, 40, 59, 100, 150, 400]
    items = [[word() for _ in range(n)] for n in sizes for _ in range(8)]
    w = Words(pa.array([" ".join(x) for x in items]))
    h = w.hashes()
    index = decontaminate.Index([(i, h[a:b]) for i, (a, b) in enumerate(zip(w.first, w.first[1:]))],
                                decontaminate.EDIT_RATE)
    texts, wanted = [], []
    for row, item in enumerate(items):
        for _ in range(8):
            copy = list(item)
            for _ in range(int(share * decontaminate.allowed(len(item)))):
                kind, at = rng.randrange(3), rng.randrange(len(copy))
                if kind == 0:
                    copy[at] = word()
                elif kind == 1:
                    copy.insert(at, word())
                else:
                    del copy[at]
            around = [[word() for _ in range(0 if alone else 30)] for _ in range(2)]
            texts.append(" ".join(around[0] + copy + around[1]))
            wanted.append((len(texts) - 1, row))
    found = {(t, i) for t, i, *_ in decontaminate.leaks_of(pa.array(texts), index)}
    assert found <= set(wanted)
    for n in sizes:
        of = [x for x in wanted if len(items[x[1]]) == n]
        assert len(found & set(of)) >= 0.9 * len(of), n
    # a word left out, and nothing else
    short = pa.array([" ".join(x[:7] + x[8:]) for x in items])
    assert len(decontaminate.leaks_of(short, index)) == len(items)


def test_leaks_in_no_documents(spark, none):
    table = spark.createDataFrame([(1, "some words of an item that is long enough")], "item_id long, text string")
    found = decontaminate.find_leaks(none, table)
    assert found.columns == ["doc_id", "item_id", "start", "n_words", "distance"] and found.count() == 0


def test_recall_of_each_length():
    """Many short items and a few long ones in one index: each length is found."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    sizes = [rng.randint(12, 40) for _ in range(600)] + [80, 200, 300, 400]
    items = [[word() for _ in range(n)] for n in sizes]
    w = Words(pa.array([" ".join(x) for x in items]))
    h = w.hashes()
    index = decontaminate.Index([(i, h[a:b]) for i, (a, b) in enumerate(zip(w.first, w.first[1:]))],
                                decontaminate.EDIT_RATE)
    texts, wanted = [], []
    for row in range(600, len(items)):
        for _ in range(25):
            copy, k = list(items[row]), decontaminate.allowed(sizes[row])
            for _ in range(k // 4):  # a word goes and one comes: two edits, same length
                del copy[rng.randrange(len(copy))]
                copy.insert(rng.randrange(len(copy) + 1), word())
            for at in rng.sample(range(len(copy)), k - 2 * (k // 4)):
                copy[at] = word()
            texts.append(" ".join([word() for _ in range(9)] + copy + [word() for _ in range(9)]))
            wanted.append((len(texts) - 1, row))
    found = {(t, i) for t, i, *_ in decontaminate.leaks_of(pa.array(texts), index)}
    for row in range(600, len(items)):
        of = [x for x in wanted if x[1] == row]
        assert len(found & set(of)) >= 0.95 * len(of), sizes[row]
    assert found <= set(wanted)


def test_items_of_null_id_leak_too(spark):
    rng = random.Random(6)
    texts = [sentence(rng, 60) for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(None, " ".join(texts[0].split()[5:25])), ("q-17", " ".join(texts[1].split()[7:30])),
             ("12", " ".join(texts[2].split()[:20])), (None, None)]
    table = spark.createDataFrame(items, "item_id string, text string")
    assert got(decontaminate.find_leaks(docs, table), "doc_id", "item_id", "start", "n_words", "distance") == [
        (0, None, 5, 20, 0), (1, None, 7, 23, 0), (2, 12, 0, 20, 0)]
    assert [r["doc_id"] for r in decontaminate.drop_leaking(docs, table).collect()] == [3]


def test_quality_rules(odd, rows):
    found = quality_rules.quality_rules(odd, quality_rules.DEFAULT)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = []
    for d, t in rows:
        s = brute.statistics(t)
        expected.append((d, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
    same(got(found, "doc_id", *names), expected)
    clean = quality_rules.keep_clean(odd, quality_rules.DEFAULT)
    assert clean.schema == odd.schema
    assert got(clean, "doc_id") == got(found.where("kept"), "doc_id")
    assert found.where("kept and base_failed").count() == 0
    assert {102, 98, 92, 93} <= {r["doc_id"] for r in found.where("not kept").collect()}


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(5)
    text = np.repeat(np.arange(30), rng.integers(1, 8, 30))
    emission, trans = rng.normal(0, 2, len(text)), rng.normal(0, 1, (2, 2))
    labels = quality_rules.viterbi(text, emission, trans)
    for t in range(30):
        at = np.flatnonzero(text == t)
        value = lambda y: sum(emission[i] for i, k in zip(at, y) if k) + sum(
            trans[a, b] for a, b in zip(y, y[1:]))
        best = max(map(value, itertools.product((0, 1), repeat=len(at))))
        assert abs(value(labels[at].tolist()) - best) < 1e-9


def test_field_is_fitted_on_labels(spark, sf_dir):
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    field = quality_rules.fit(docs, labels)
    judged = quality_rules.quality_rules(docs, field).join(labels, "doc_id").where("not base_failed")
    right = judged.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.95
    assert quality_rules.fit(docs, labels.limit(0)) is quality_rules.DEFAULT


def test_repeats(odd, rows):
    out = repeats.remove_repeats(odd)
    assert out.columns[:-1] == odd.columns
    same(got(out, "doc_id", "__repeats.n_words", "__repeats.n_removed", "text"), brute.repeats(rows))


def test_levels_double():
    for size in (4, 8, 13, 50, 100):
        found = repeats.levels(size)
        assert found[-1] == size and all(a < b <= 2 * a for a, b in zip(found, found[1:]))


RULES = [url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"),
         url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow")]


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.rule), default=None)


def test_url_filter(spark, sf_dir):
    odd = [(None, "http://X.example.NET/en/1"), (1, None), (1, None), (2, ""), (3, "no scheme"), (4, "http://"),
           (5, "http://net/"), (6, "http://anet/"), (7, "http://a.net"), (8, "http://a.org/fr/?q=/x#y"),
           (9, "https://a.org?x=http://b.net/"), (10, "x://y.net:80/a"), (11, "https://example.com/de/" + "p" * 3000)]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(spark.createDataFrame(odd, pages.schema)).withColumns(
        {c: F.lit("x") for c in ("host", "shape", "verdict", "gram")})
    out = url_filter.filter_urls(pages, RULES).collect()
    parts = []
    for r in pages.collect():
        before, sep, rest = (r["url"] or "").partition("://")
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest)) if sep else 0
        host = rest[:end].translate(brute.LOWER) if sep else ""
        path = rest[end:].split("?")[0].split("#")[0] if sep else ""
        parts.append((r["page_id"], host, path, plain_rule(host, path)))
    import re
    shape = lambda h, p: re.sub("[0-9]", "0", (h + p).lower())
    score = url_filter_scores = brute.url_model([(shape(h, p), r and r.verdict) for _, h, p, r in parts])
    key = lambda x: repr(x)
    assert sorted([(r["page_id"], r["host"], r["path"], r["rule"]) for r in out], key=key) == sorted(
        [(i, h, p, r and r.rule) for i, h, p, r in parts], key=key)
    verdict = {(r["host"], r["path"]): (r["verdict"], r["score"]) for r in out}
    free = []
    for _, h, p, r in parts:
        v, s = verdict[h, p]
        assert abs(s - url_filter_scores(shape(h, p))) < 1e-9
        if r:
            assert v == r.verdict
        else:
            free.append((score(shape(h, p)), v))
    blocked, allowed = ([s for s, v in free if v == k] for k in ("block", "allow"))
    assert blocked and allowed and max(blocked) < min(allowed)
    # without training urls everything undecided is allowed
    assert {r["verdict"] for r in url_filter.filter_urls(pages.where("url like '%.org/en%'"), RULES).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_machine_identity_and_held_out_accuracy(spark, sf_dir, odd, rows):
    rng = np.random.default_rng(1)
    f = quality_model.featurise(pa.array(["a b c a", None, "x"]), np.array([7.0, 0, 1]))
    size = quality_model.BUCKETS + len(quality_model.STATISTICS)
    m = quality_model.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 4)))
    for i, logit in enumerate(m.logits(f)):
        part = slice(f.first[i], f.first[i + 1])
        c, x = f.column[part], f.value[part]
        pairs = sum(m.factors[c[p]] @ m.factors[c[q]] * x[p] * x[q] for p, q in itertools.combinations(range(len(c)), 2))
        assert abs(logit - (0.3 + m.linear[c] @ x + pairs)) < 1e-3
    read = lambda n: spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    machine = quality_model.fit(docs, labels)
    held = (quality_model.score(docs, machine).join(labels, "doc_id")
            .where(quality_model.held_out(F.col("doc_id"))))
    assert held.agg(F.avg(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("int"))).first()[0] > 0.9
    out = quality_model.score(odd, machine)
    assert out.count() == len(rows) and out.where("score between 0 and 1").count() == len(rows)
    assert quality_model.fit(docs, labels.limit(0)) is None
    assert quality_model.score(odd, None).where("score = 0.5").count() == len(rows)


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_packing_round_trip(odd, rows):
    library = Tokenizer.from_file(TOKENIZER)
    out = packing.pack(odd, TOKENIZER, sequence=256, with_ids=True).collect()
    texts = {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] and 0 < len(ids) <= 256
        texts.setdefault(r["doc_id"], []).append((r["start"], r["piece"], ids.tolist()))
    ids_of = lambda t: library.encode(t or "", add_special_tokens=False).ids + [1]
    counts = {}
    for d, t in rows:
        counts.setdefault(d, []).append(ids_of(t))
    for d, pieces in texts.items():
        if len(counts[d]) == 1:
            assert sum((ids for _, _, ids in sorted(pieces)), []) == counts[d][0]
            assert [p for _, p, _ in sorted(pieces)] == list(range(len(pieces)))
    assert sum(r["length"] for r in out) == sum(len(x) for v in counts.values() for x in v)
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in out)
    assert len(by) <= 1.02 * total / 256 + 2


def test_fullest_is_the_best_subset():
    rng = random.Random(1)
    for _ in range(60):
        items = [(n, rng.randint(1, 3)) for n in sorted(rng.sample(range(1, 30), 5), reverse=True)]
        room = rng.randint(1, 60)
        best = max(s for s in (sum(n * k for (n, _), k in zip(items, take)) for take in itertools.product(
            *(range(c + 1) for _, c in items))) if s <= room)
        chosen = packing.fullest(items, room)
        assert sum(n * k for n, k in chosen) == best
        assert all(k <= dict(items)[n] for n, k in chosen)
    plan = packing.plan_bins({7: 5, 3: 4, 10: 2, 1: 1}, 10)
    assert plan.bins == 7


def test_token_counts_and_cache(spark, odd, rows, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    cache = str(tmp_path / "cache")
    expected = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    same(got(tokens.count_tokens(odd, path, cache), "doc_id", "n_bytes", "n_tokens"), expected)
    stored = tokens.read_cache(spark, cache)
    assert stored.count() == len({t or "" for _, t in rows})
    again = tokens.count_tokens(odd, path, cache)
    same(got(again, "doc_id", "n_bytes", "n_tokens"), expected)
    assert tokens.read_cache(spark, cache).count() == stored.count()  # nothing was encoded anew


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_piece_counter_equals_library(name):
    texts = ["a  b\n\n c\t", "  x", "x ", "it's a<|endoftext|> b  <|endoftext|>", "a\r\n  b 12 !!? x\u3000 y", " ",
             "\n\n", "a\x85 b", "1 2  3's", "\x1c a", "a\u00a0 b", "", None, "don't  'll we\tgo\u2003 \u2003x"]
    counter = tokens.PieceCounter.of(public_tokenizers.path(name))
    assert counter.counts(texts) == [n for n in (counter._encode([t])[0] if t else 0 for t in texts)]


def test_license_scan(spark, odd, sf_dir):
    import duckdb
    rows = [(1, None), (2, ""), (3, "Licensed under the Apache License, Version 2.0."), (3, "x\nALL RIGHTS RESERVED\n\n"),
            (None, "released  under the   MIT-License"), (4, "license"), (5, "word " * 5000)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumns(
        {c: F.lit(1) for c in ("line", "license", "dice", "m", "__grams")})
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    expected = con.sql(license_scan.oracle_sql()).fetchall()
    same(got(license_scan.scan_licenses(docs), "doc_id", "line", "license", "dice"), expected)
    assert {"Apache-2.0", "proprietary", "MIT"} <= {r[2] for r in expected}


def test_license_scan_of_wrapped_and_embedded_notices(spark):
    def wrapped(text, width, mark):
        return "\n".join(f"{mark} {x}" for x in textwrap.wrap(text, width))
    mit, gpl = license_scan.PASSAGES["MIT"][0], license_scan.PASSAGES["GPL-3.0"][0]
    bsd, apache = license_scan.PASSAGES["BSD-3-Clause"][1], license_scan.PASSAGES["Apache-2.0"][1]
    nc = license_scan.TEMPLATES["CC-BY-NC-4.0"][1]
    rows = [(1, "some code\n" + wrapped(mit, 40, "//") + "\nmore code"), (2, wrapped(gpl, 30, " *")),
            (3, "a\nb\n" + wrapped(bsd, 35, "#")), (4, "intro " * 30 + "\n\n" + wrapped(apache, 30, "--")),
            (5, "Copyright 2020 Foo. All rights reserved."), (6, " ".join(f"word{i}" for i in range(80)) + " " + nc + " Thank you."),
            (7, "All rights\nof others are reserved."), (8, "x\nAll rights reserved.\ny"), (9, None),
            (10, "All\nrights\nreserved here, and all rights reserved there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["line"], r["license"], round(r["dice"], 6))
             for r in license_scan.scan_licenses(docs).collect()]
    assert sorted(found) == [
        (1, 1, "MIT", 1.0), (2, 0, "GPL-3.0", 1.0), (3, 2, "BSD-3-Clause", 1.0), (4, 2, "Apache-2.0", 1.0),
        (5, 0, "proprietary", 1.0), (6, 0, "CC-BY-NC-4.0", 1.0), (8, 1, "proprietary", 1.0),
        (10, 0, "proprietary", 1.0), (10, 2, "proprietary", 1.0)]


def test_kneser_ney(odd, rows):
    train = odd.where("doc_id % 3 = 0")
    model = kneser_ney.fit(train)
    expected, p, vocabulary = brute.kneser_ney([t for _, t in rows], [t for d, t in rows if d is not None and d % 3 == 0])
    found = kneser_ney.score(odd, model).collect()
    mine = sorted([(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in found])
    for a, b in zip(mine, sorted(expected)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * abs(b[2]) + 1e-9 and abs(a[3] - b[3]) < 1e-6 * abs(b[3]) + 1e-9
    for context in (0, "one", "never seen"):
        assert abs(sum(p(context, b) for b in vocabulary) + p(context, "never seen") - 1) < 1e-9
    untrained = kneser_ney.fit(train.limit(0))
    assert kneser_ney.score(odd, untrained).where("n_known = 0 and score = 0").count() == len(rows)


def test_empty_tables(spark, none, tmp_path):
    assert near_dup.near_duplicates(none).count() == 0
    assert near_dup.drop_duplicates(none).count() == 0
    assert quality_rules.quality_rules(none, quality_rules.DEFAULT).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert quality_model.score(none, None).count() == 0
    assert packing.pack(none, TOKENIZER).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    assert tokens.count_tokens(none, TOKENIZER, str(tmp_path / "cache")).count() == 0
    assert kneser_ney.score(none, kneser_ney.fit(none)).count() == 0


def test_kept_text_digest():
    # Spark's sha2 of the kept text is the contract's digest
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_packing_numbers_pieces_in_the_worker_that_cuts_them(spark, monkeypatch):
    """Each Python step of a stage's plan holds a worker of its own in every task."""
    steps = {}
    keep = packing.Scratch.keep

    def seen(self, df, name):
        steps[name] = df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
        return keep(self, df, name)

    monkeypatch.setattr(packing.Scratch, "keep", seen)
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d " * 9000)], "doc_id long, text string")
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert steps["pieces"] == 1
    assert sorted((r.doc_id, r.piece) for r in found) == [(1, 0), (2, 0), (3, 0), (3, 1), (3, 2)]
