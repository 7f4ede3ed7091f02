"""Lines of one text get labels of their own, from documents' labels alone."""

import numpy as np
import pyarrow as pa
import pytest

from launchboard.llm import quality_rules as Q

SF = "/root/testdata/sf0.1"
BLOCK = ["### *** BUY NOW !!! ### $$$ | CLICK HERE | $$$", "*** 100% FREE *** | | | ###", "!!! $$$ !!! 24/7 *** ORDER | NOW"]


@pytest.fixture(scope="module")
def field(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return Q.fit(docs, labels)


def clean_lines(spark):
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    rows = spark.read.parquet(f"{SF}/documents.parquet").join(good, "doc_id", "left_semi").orderBy("doc_id").limit(40).collect()
    lines = [[x for x in r.text.split("\n") if len(x.split()) > 8] for r in rows]
    return [x for x in lines if len(x) > 5]


def labels_of(lines, field):
    m = Q.measure(pa.array(["\n".join(lines)]))
    return Q.viterbi(m.text, m.features @ field.weights, field.transitions).tolist()


def test_planted_block_is_marked_and_nothing_else(spark, field):
    texts = clean_lines(spark)
    assert len(texts) > 10
    for lines in texts:
        for at in (0, 2, len(lines)):
            planted = lines[:at] + BLOCK + lines[at:]
            assert labels_of(planted, field) == [1] * at + [0] * len(BLOCK) + [1] * (len(lines) - at)


def test_share_decides(spark, field):
    lines = clean_lines(spark)[0]
    few, many = (Q.judge(pa.array(["\n".join(lines + BLOCK * k)]), field) for k in (1, 60))
    words = sum(len(x.split()) for x in lines)
    assert few["n_content_words"][0] == words and few["kept"][0]
    assert many["n_content_words"][0] < 0.5 * many["n_words"][0] and not many["kept"][0]


def test_least_of_several_labels_counts(spark):
    docs = spark.createDataFrame([(i, f"some words of text number {i}\nand a second line") for i in range(40)], "doc_id long, text string")
    once = [(i, i % 2) for i in range(40)]
    twice = [(i, q) for i, q in once] + [(i, 1) for i, _ in once]
    fields = [Q.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int").repartition(n))
              for rows, n in ((once, 1), (twice, 1), (twice, 7))]
    assert all(np.array_equal(f.weights, fields[0].weights) for f in fields)
    assert np.array_equal(Q.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).weights, Q.DEFAULT.weights)
