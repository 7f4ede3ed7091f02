"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

Features of a document: its distinct words, hashed into ``BUCKETS`` buckets with
equal weights of total square 1, and a few statistics of the text and the
``n_chars`` column. The score is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2),

pairwise interactions in time linear in the number of features.

The machine is fitted with Adagrad on a bounded sample: the ``TRAIN_DOCS`` labelled
rows of least hash that are not held out. Scoring covers every row and whole texts.

Defined cases: null and empty texts score by their statistics; a null id is not
held out and never trains; labels other than 0 and 1 are ignored, and of several
labels of an id the least counts; without training rows of both labels every score
is 0.5; repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchboard.llm.quality_rules import BLOCK, BYTE_CLASS
from launchboard.llm.words import U64, Words, blocks

BUCKETS = 1 << 16
FACTORS = 8
TRAIN_DOCS = 4000
HOLD_OUT = 5
PREDICT_AT = 0.3

STATISTICS = ("log_words", "log_lines", "word_bytes", "symbols", "bars", "shouts", "capitals",
              "digits", "distinct_words", "non_ascii", "log_n_chars")


def held_out(doc_id: Column, parts: int = HOLD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))


@dataclass
class Features:
    """Rows in compressed form: entries first[i]:first[i + 1] belong to row i.
    Statistic s has the column BUCKETS + s."""

    column: np.ndarray
    value: np.ndarray
    first: np.ndarray


def featurise(texts: pa.Array, n_chars: np.ndarray) -> Features:
    w = Words(texts, lower=True)
    n = len(w.counts)
    sizes = np.diff(w.offsets)
    byte_text = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(byte_text * 7 + _classes(texts, w), minlength=n * 7).reshape(n, 7)
    bucket = (w.hashes() & U64(BUCKETS - 1)).astype(np.int64)
    pairs = np.unique(w.text_of_word() * BUCKETS + bucket)
    row, bucket = pairs // BUCKETS, pairs % BUCKETS
    distinct = np.bincount(row, minlength=n)
    per = lambda x: np.bincount(byte_text, x, n)
    total, words = np.maximum(sizes, 1), np.maximum(w.counts, 1)
    word_bytes = per(~w.space)
    stats = np.stack([
        np.log1p(w.counts) / 8, np.log1p(per(w.data == 10)) / 6, np.minimum(word_bytes / words / 10, 3),
        *(np.minimum(10 * kinds[:, k] / total, 1) for k in (1, 2, 3)),
        kinds[:, 4] / np.maximum(kinds[:, 4] + kinds[:, 5], 1), kinds[:, 6] / total,
        np.sqrt(distinct / words), per(w.data >= 128) / total, np.log1p(np.maximum(n_chars, 0)) / 10], axis=1)
    value = 1 / np.sqrt(np.maximum(distinct, 1))[row]
    k = len(STATISTICS)
    order = np.argsort(np.concatenate([row, np.repeat(np.arange(n), k)]), kind="stable")
    return Features(np.concatenate([bucket, np.tile(BUCKETS + np.arange(k), n)])[order],
                    np.concatenate([value, stats.ravel()])[order].astype(np.float32),
                    np.concatenate([[0], np.cumsum(distinct + k)]))


def _classes(texts: pa.Array, lowered: Words) -> np.ndarray:
    return BYTE_CLASS[Words(texts).data] if len(lowered.data) else np.zeros(0, np.int64)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, f: Features) -> np.ndarray:
        if len(f.first) < 2:
            return np.zeros(0)
        v = self.factors[f.column] * f.value[:, None]
        # every row has its statistics, so no segment is empty
        sums = np.add.reduceat(v, f.first[:-1])
        squares = np.add.reduceat((v * v).sum(1), f.first[:-1])
        line = np.add.reduceat(self.linear[f.column] * f.value, f.first[:-1])
        return self.bias + line + 0.5 * ((sums ** 2).sum(1) - squares)


def fit_machine(f: Features, y: np.ndarray, epochs: int = 20, rate: float = 0.2, batch: int = 100,
                prior: float = 1e-4, seed: int = 1) -> Machine:
    random = np.random.default_rng(seed)
    size = BUCKETS + len(STATISTICS)
    m = Machine(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(size, np.float32),
                random.normal(0, 0.03, (size, FACTORS)).astype(np.float32))
    g_line, g_fact = np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-3, np.float32)
    counts = np.diff(f.first)
    for _ in range(epochs):
        order = random.permutation(len(y))
        for lo in range(0, len(y), batch):
            rows = order[lo:lo + batch]
            n = counts[rows]
            first = np.concatenate([[0], np.cumsum(n)])
            at = np.repeat(f.first[rows] - first[:-1], n) + np.arange(first[-1])
            part = Features(f.column[at], f.value[at], first)
            error = 1 / (1 + np.exp(-m.logits(part))) - y[rows]
            e = np.repeat(error, n) * part.value
            v = m.factors[part.column]
            sums = np.repeat(np.add.reduceat(v * part.value[:, None], first[:-1]), n, axis=0)
            columns, where = np.unique(part.column, return_inverse=True)
            d_line = np.bincount(where, e, len(columns)) / len(rows) + prior * m.linear[columns]
            d = e[:, None] * (sums - v * part.value[:, None])
            d_fact = np.stack([np.bincount(where, d[:, k], len(columns)) for k in range(FACTORS)], 1)
            d_fact = d_fact / len(rows) + prior * m.factors[columns]
            g_line[columns] += d_line ** 2
            g_fact[columns] += d_fact ** 2
            m.linear[columns] -= rate * d_line / np.sqrt(g_line[columns])
            m.factors[columns] -= rate / 2 * d_fact / np.sqrt(g_fact[columns])
            m.bias -= rate / 2 * float(error.mean())
    return m


def _inputs(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", F.coalesce(chars, F.lit(0.0)).alias("n_chars"))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", BLOCK):
        f = featurise(block.column(1), block.column(2).to_numpy(zero_copy_only=False))
        parts = [(f.column[a:b].astype(np.int32).tobytes(), f.value[a:b].tobytes())
                 for a, b in zip(f.first, f.first[1:])]
        yield pa.RecordBatch.from_arrays(
            [block.column(0), block.column(3), *(pa.array(list(c), pa.binary()) for c in zip(*parts))],
            ["doc_id", "quality", "columns", "values"])


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Machine | None:
    sample = (labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
              .where("quality in (0, 1) and __id is not null").where(~held_out(F.col("__id")))
              .groupBy("__id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("__id"), "__id").limit(train_docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (_inputs(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).drop("__id")
            .mapInArrow(_sample_features, f"doc_id {kind}, quality int, columns binary, values binary")
            .orderBy("doc_id", "columns").collect())
    y = np.array([r["quality"] for r in rows], dtype=float)
    if len(set(y)) < 2:
        return None
    columns = [np.frombuffer(r["columns"], np.int32) for r in rows]
    f = Features(np.concatenate(columns), np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows]),
                 np.concatenate([[0], np.cumsum([len(c) for c in columns])]))
    return fit_machine(f, y)


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score) per row; the model travels as a broadcast of fixed size."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for block in blocks(batches, "text", BLOCK):
            if model is None:
                result = np.full(block.num_rows, 0.5)
            else:
                f = featurise(block.column(1), block.column(2).to_numpy(zero_copy_only=False))
                result = 1 / (1 + np.exp(-model.logits(f).astype(float)))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(result)], ["doc_id", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _inputs(docs).mapInArrow(run, f"doc_id {kind}, score double")
