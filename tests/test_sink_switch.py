"""Staged refreshes and the positional check."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchboard.plans import catalog
from launchboard.sources.sink import (
    SchemaMismatch, check_positional, current_version, read_refreshed, storable, table_details, write_full_refresh)


def rows(spark, lo, hi):
    return spark.range(lo, hi, 1, 4).select(F.col("id").alias("a"), F.concat(F.lit("t"), "id").alias("b"))


def failing(spark):
    """Most tasks write their rows before one fails."""
    bad = F.when(F.col("id") == 999, F.raise_error(F.lit("half way")).cast("string")).otherwise("x")
    return spark.range(0, 1000, 1, 8).select(F.col("id").alias("a"), bad.alias("b"))


@pytest.fixture
def table(spark):
    path = tempfile.mkdtemp(prefix="lb-sink-") + "/t"
    spark.sql(f"CREATE TABLE lb_switch (first bigint, second string) USING parquet LOCATION '{path}'")
    yield path
    spark.sql("DROP TABLE lb_switch")


def values(df):
    return sorted(r[0] for r in df.collect())


def test_folder_keeps_its_rows_when_a_write_fails(spark):
    path = tempfile.mkdtemp(prefix="lb-sink-") + "/f"
    with pytest.raises(FileNotFoundError):
        read_refreshed(spark, path)
    with pytest.raises(Exception, match="half way"):
        write_full_refresh(failing(spark), ("a", "b"), path=path)
    assert current_version(spark, path) is None
    write_full_refresh(rows(spark, 0, 10), ("a", "b"), path=path)
    with pytest.raises(Exception, match="half way"):
        write_full_refresh(failing(spark), ("a", "b"), path=path)
    assert values(read_refreshed(spark, path)) == list(range(10))
    assert len([x for x in os.listdir(path) if x.startswith("_v-")]) == 1


def test_folder_switch_serves_readers_and_drops_older_versions(spark):
    path = tempfile.mkdtemp(prefix="lb-sink-") + "/f"
    for k in range(3):
        if k:
            before = read_refreshed(spark, path)
        write_full_refresh(rows(spark, k, k + 5), ("b", "a"), path=path)
        if k:  # a reader that has listed the version before
            assert len(before.collect()) == 5
    assert read_refreshed(spark, path).columns == ["b", "a"]
    assert len([x for x in os.listdir(path) if x.startswith("_v-")]) == 2
    write_full_refresh(rows(spark, 0, 4), ("a", "b"), path=path, partition_by=("b",))
    assert values(read_refreshed(spark, path)) == [0, 1, 2, 3]


def test_table_keeps_its_rows_when_a_write_fails(spark, table):
    write_full_refresh(rows(spark, 0, 10), ("a", "b"), table="lb_switch")
    with pytest.raises(Exception, match="half way"):
        write_full_refresh(failing(spark), ("a", "b"), table="lb_switch")
    assert values(spark.table("lb_switch")) == list(range(10))


def test_table_with_rows_of_its_own_is_switched(spark, table):
    spark.sql("INSERT INTO lb_switch VALUES (-1, 'own')")
    before = spark.table("lb_switch")
    write_full_refresh(rows(spark, 0, 3), ("a", "b"), table="lb_switch")
    assert values(before) == [-1]  # its files are kept until the next refresh
    for k in range(1, 4):
        write_full_refresh(rows(spark, k, k + 3), ("a", "b"), table="lb_switch")
        assert values(spark.table("lb_switch")) == [k, k + 1, k + 2]
    assert spark.table("lb_switch").columns == ["first", "second"]
    assert table_details(spark, "lb_switch")[1].startswith(f"file:{table}/_v-")
    assert len(os.listdir(table)) == 2  # the current version and the one before


def test_partitioned_table(spark):
    path = tempfile.mkdtemp(prefix="lb-sink-") + "/t"
    spark.sql(f"CREATE TABLE lb_parts (a bigint, b string) USING parquet PARTITIONED BY (b) LOCATION '{path}'")
    try:
        for k in (0, 2):
            write_full_refresh(rows(spark, k, k + 3), ("a", "b"), table="lb_parts")
        assert values(spark.table("lb_parts")) == [2, 3, 4]
    finally:
        spark.sql("DROP TABLE lb_parts")


@pytest.mark.parametrize("columns, said", [
    (("a",), "1 columns for the 2"), (("a", "b", "a"), "3 columns for the 2"), (("b", "a"), "column 1: b string cannot")])
def test_rows_that_do_not_fit_write_nothing(spark, table, columns, said):
    write_full_refresh(rows(spark, 0, 2), ("a", "b"), table="lb_switch")
    before = os.listdir(table)
    with pytest.raises(SchemaMismatch, match=said):
        write_full_refresh(rows(spark, 5, 9), columns, table="lb_switch")
    assert os.listdir(table) == before and values(spark.table("lb_switch")) == [0, 1]


def test_number_too_large_for_its_column_changes_nothing(spark, table):
    big = spark.sql("SELECT CAST('100000000000000000000' AS decimal(21,0)) AS a, 'x' AS b")
    write_full_refresh(rows(spark, 0, 2), ("a", "b"), table="lb_switch")
    with pytest.raises(Exception, match="CAST_OVERFLOW|out of range|overflow|Overflow"):
        write_full_refresh(big, ("a", "b"), table="lb_switch")
    assert values(spark.table("lb_switch")) == [0, 1]


def test_positional_rules():
    s = lambda text: T._parse_datatype_string(text)
    check_positional(s("x int, y date, z int"), s("a bigint, b timestamp, c string"))
    with pytest.raises(SchemaMismatch, match="x may be NULL, a must not"):
        check_positional(s("x int"), T.StructType([T.StructField("a", T.LongType(), False)]))
    for a, b in (("string", "int"), ("boolean", "int"), ("int", "boolean"), ("int", "date"), ("array<int>", "string"),
                 ("array<string>", "array<int>"), ("binary", "string"), ("struct<a:int>", "struct<a:int,b:int>")):
        assert not storable(s(f"x {a}")["x"].dataType, s(f"x {b}")["x"].dataType), (a, b)
    for a, b in (("int", "decimal(9,2)"), ("double", "float"), ("timestamp_ntz", "date"), ("array<int>", "array<bigint>"),
                 ("map<string,int>", "map<string,double>"), ("struct<a:int>", "struct<b:string>")):
        assert storable(s(f"x {a}")["x"].dataType, s(f"x {b}")["x"].dataType), (a, b)


def test_sink_query_leaves_no_table(spark, sf_dir):
    before = {t.name for t in spark.catalog.listTables()}
    assert catalog.QUERIES["sink_positional_insert"](spark, sf_dir).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
