"""The pipeline stage by stage against brute force, on odd rows and empty tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from launchboard.llm import quality_rules
from tests.llm import brute
from tests.llm.conftest import make


@pytest.fixture(scope="module")
def folder(spark, odd, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    odd.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    item = " ".join(rows[12][1].split()[3:25])
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, [(1, item)]


def test_stages(spark, folder, rows):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    pairs = lambda df: sorted(map(tuple, df.select("doc_id", "text").collect()), key=repr)
    before = rows
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if k == 4:
            assert {r["doc_id"] for r in out.collect()} == {d for d, _ in before}
            break
        assert out.columns == docs.columns
        found = pairs(out)
        if k == 0:
            verdict = quality_rules.quality_rules(docs, quality_rules.DEFAULT).where("kept")
            ids = sorted((r["doc_id"] for r in verdict.collect()), key=repr)
            assert [d for d, _ in found] == ids or sorted((d for d, _ in found), key=repr) == ids
        elif k == 1:
            expected = [(d, t) for (d, t), (_, _, c) in zip(before, brute.components(before, 5, 80)) if d is None or d == c]
            assert found == sorted(expected, key=repr)
        elif k == 2:
            expected = [(d, t) for d, _, _, t in brute.repeats(before)]
            assert found == sorted(expected, key=repr)
            assert out.where(F.col("n_chars") != F.length("text")).count() == 0
        else:
            leaks = brute.leaks([(i, t) for i, (_, t) in enumerate(before) if len(t) < 20_000], items, 0.2)
            gone = {i for i, _ in leaks}
            assert found == sorted([x for i, x in enumerate(before) if i not in gone], key=repr)
            assert gone
        out.write.parquet(f"{path}/out-{k}")
        docs, before = spark.read.parquet(f"{path}/out-{k}"), found


def test_run_on_empty_documents(spark, folder, tmp_path):
    make(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
