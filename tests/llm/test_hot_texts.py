"""Counts of a text that a third of the rows have come back over many partitions."""

import tempfile

import public_tokenizers
from pyspark.sql import functions as F

from launchboard.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_hot_text(spark):
    n = 6000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text")).repartition(5)
    cache = tempfile.mkdtemp(prefix="lb-cache-") + "/c"
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        counts = tokens.count_tokens(docs, PATH, cache)
        sizes = [r[0] for r in counts.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
        assert sum(sizes) == n and max(sizes) < 0.2 * n
        rows = {r.doc_id: r.n_tokens for r in counts.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plain = tokens.PieceCounter(PATH).counts(["the same text", "text 1"])
    assert len(rows) == n and rows[0] == rows[2997] == plain[0] and rows[1] == plain[1]
    # another version's counts lie apart and are not read
    assert spark.read.parquet(cache).select("tokenizer_sha256").distinct().count() == 1
    plan = tokens.read_cache(spark, cache).where(F.col("tokenizer_sha256") == "other")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tokenizer_sha256" in plan
