"""Corpus pipeline: five operators of ``launchboard.llm`` in a row.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All stages but the last return the columns of ``documents``:

1. quality rules: documents that fail the base statistics or whose lines are mostly
   boilerplate go;
2. near-dedup: of each group of near-duplicates (five-word shingles, similarity 0.8)
   the document with the least id stays;
3. substring dedup: passages of 13 or more words that an earlier document holds are
   removed from the text; ``n_chars`` follows the text; a text may become empty;
4. decontamination: documents with a passage within edit distance of a benchmark
   item go;
5. packing: the pieces of all documents with their places in sequences.

Nulls, empty texts, repeated rows and empty tables are handled as the operators'
docstrings say; columns that ``documents`` has besides its own are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchboard.llm import decontaminate, near_dup, packing, quality_rules, repeats
from launchboard.llm.queries import table
from launchboard.llm.store import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_clean(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

# a fitted model, sketches and an edit-distance search are beyond SQL; the tests
# compare the stages with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.release()
    return docs
