"""Token counting through a digest cache.

``count_tokens`` joins each text's digest and the tokenizer's version digest to
a table of stored counts, encodes only the distinct texts that the table lacks,
appends their counts and answers from the table.

A count depends on every byte of the text, so normalising a text for its digest
only turns null into the empty text. The digest is SHA-256: texts of one digest
are the same text. The version digest is the SHA-256 of the tokenizer file.

Workers encode word by word: a text is cut before each run of ASCII white space
that follows a character outside white space, which no pre-token of the
byte-level pattern crosses, and each distinct piece is encoded once per worker
and kept in a bounded table. Texts with other Unicode spaces or with the markup
of special tokens go to the library whole, so counts equal the library's always.

Defined cases: null and empty text have 0 tokens; rows that repeat a text or an
id each get their row; a null id stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchboard.llm.store import Scratch
from launchboard.llm.words import blocks

#: Entries of a worker's table of encoded pieces; a full table starts anew.
PIECE_CACHE = 500_000

#: A text with more rows than this part of a partition's share has its count copied.
FRACTIONS = 4

CACHE_SCHEMA = "text_sha256 string, tokenizer_sha256 string, n_tokens long"

_PIECES = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+$")
_WHOLE = re.compile("<\\||[\x1c-\x1f\x85\xa0  -     　]")


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceCounter:
    """Counts the tokens of texts with a tokenizer file; lives in a worker."""

    _by_path: dict = {}

    def __init__(self, path: str):
        self.sizes: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.by_piece = False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._encode = lambda texts: [len(x) for x in model.encode_batch_fast(
                texts, add_special_tokens=False)]
            # pieces only for byte-level splitting without a normalizer or an added prefix space
            pre = model.pre_tokenizer
            self.by_piece = (model.normalizer is None and "ByteLevel" in str(pre)
                             and "add_prefix_space=False" in str(pre)
                             and "Sequence" not in str(pre))

    @classmethod
    def of(cls, path: str) -> PieceCounter:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def counts(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        whole = [i for i, t in enumerate(texts) if t and not (self.by_piece and not _WHOLE.search(t))]
        for i, n in zip(whole, self._encode([texts[i] for i in whole]) if whole else []):
            out[i] = n
        skip, sizes = set(whole), self.sizes
        split = {i: _PIECES.findall(t) for i, t in enumerate(texts) if t and i not in skip}
        distinct = set().union(*split.values())
        if len(sizes) > PIECE_CACHE:
            sizes.clear()
        if missing := [p for p in distinct if p not in sizes]:
            sizes.update(zip(missing, self._encode(missing)))
        for i, pieces in split.items():
            out[i] = sum(map(sizes.__getitem__, pieces))
        return out


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.of(path)
        for block in blocks(batches, "__text"):
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(counter.counts(block.column(1).to_pylist()), pa.int64())],
                ["text_sha256", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    """The stored counts; an absent table counts as empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path).select("text_sha256", "tokenizer_sha256", "n_tokens")
    return spark.createDataFrame([], CACHE_SCHEMA)


def hot_texts(texts: DataFrame, rows: int) -> DataFrame:
    """(text_sha256, __copies) of the texts that more rows have than a fraction of a shuffle
    partition's share: at most ``FRACTIONS`` of them a partition, so they are broadcast."""
    share = max(1, rows // (FRACTIONS * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return F.broadcast(texts.where(F.col("__rows") > share).select(
        "text_sha256", F.ceil(F.col("__rows") / share).cast("long").alias("__copies")))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row of ``docs``; appends new counts to ``cache_path``.

    Digests are computed and written first. One row of each digest that the cache
    lacks is chosen, by least id, and only these rows' texts move on to be encoded;
    the join that picks them is keyed by digest and id, so a text with countless
    copies is spread over all tasks. Counts come back to the rows by digest; those of texts
    with many rows are copied, and each row joins one of the copies. The cache is
    partitioned by the tokenizer's digest: counts of other versions are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    version = tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.sha2(text, 256).alias("text_sha256"),
                       text.alias("__text"))
    digests = scratch.keep(rows.select(
        "__id", "text_sha256", F.octet_length("__text").cast("long").alias("n_bytes")), "digests")
    known = read_cache(spark, cache_path).where(F.col("tokenizer_sha256") == version)
    texts = scratch.keep(digests.groupBy("text_sha256").agg(
        F.min("__id").alias("__chosen"), F.count(F.lit(1)).alias("__rows")), "texts")
    chosen = (texts.select("text_sha256", "__chosen")
              .join(known.select("text_sha256"), "text_sha256", "left_anti")
              .withColumnRenamed("text_sha256", "__sha").hint("shuffle_hash"))
    misses = rows.join(chosen, (F.col("text_sha256") == F.col("__sha"))
                       & F.col("__id").eqNullSafe(F.col("__chosen")), "left_semi")
    counted = (misses.select("text_sha256", "__text")
               .mapInArrow(_encode(tokenizer_path), "text_sha256 string, n_tokens long")
               .groupBy("text_sha256").agg(F.max("n_tokens").alias("n_tokens")))
    (counted.select("text_sha256", F.lit(version).alias("tokenizer_sha256"), "n_tokens")
     .write.mode("append").partitionBy("tokenizer_sha256").parquet(cache_path))
    stored = (read_cache(spark, cache_path).where(F.col("tokenizer_sha256") == version)
              .groupBy("text_sha256").agg(F.max("n_tokens").alias("n_tokens")))
    hot = hot_texts(texts, digests.count())
    spread = digests.join(hot, "text_sha256", "left").withColumn(
        "__copy", F.pmod(F.monotonically_increasing_id(), F.coalesce("__copies", F.lit(1))))
    copied = stored.join(hot, "text_sha256", "left").withColumn(
        "__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__copies", F.lit(1)) - 1)))
    return (spread.join(copied.select("text_sha256", "__copy", "n_tokens"), ["text_sha256", "__copy"], "left")
            .select(F.col("__id").alias(id_col), "n_bytes", "n_tokens"))
