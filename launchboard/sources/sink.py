"""Full-refresh sinks of the dashboard tables.

The dashboard empties its table and inserts the new result by column position. Here
the new rows are written to a folder of their own first, and one switch makes them the
table: readers see the old rows until then and the new ones from then on, and a write
that fails half way changes nothing.

* A table of files (Parquet, ORC, CSV, JSON) without partitions keeps its definition; its
  location is changed to the new folder. Tables of other formats, which replace rows in a
  transaction of their own, and partitioned tables take Spark's ``INSERT OVERWRITE``.
* A folder sink holds its versions in hidden folders beside a small file that names the
  current one and is replaced by a rename. ``read_refreshed`` reads the current version.

The version that was replaced stays until the next refresh, so that readers which have
listed its files can finish. Before anything is written, the rows are held against an
existing table by position: number of columns, types that can be stored, and columns that
must not be NULL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_FORMATS = ("parquet", "orc", "csv", "json")
VERSION = "_v-"
POINTER = "_CURRENT"


class SchemaMismatch(ValueError):
    """Rows that do not fit the table they would be inserted into by position."""


def storable(source: T.DataType, target: T.DataType) -> bool:
    """Whether values of a type can be stored in a column of another without a change of
    kind: numbers as numbers (one too large fails when written), dates and times as such,
    anything atomic as text; never text as a number, a date or a flag."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return storable(source.elementType, target.elementType)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return len(source) == len(target) and all(
            storable(a.dataType, b.dataType) for a, b in zip(source, target))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return storable(source.keyType, target.keyType) and storable(source.valueType, target.valueType)
    days = (T.DateType, T.TimestampType, T.TimestampNTZType)
    kinds = ((T.NumericType,), days, (T.StringType, T.CharType, T.VarcharType))
    if any(isinstance(source, k) and isinstance(target, k) for k in kinds):
        return True
    nested = (T.ArrayType, T.StructType, T.MapType, T.BinaryType)
    return isinstance(target, T.StringType) and not isinstance(source, nested)


def check_positional(source: T.StructType, target: T.StructType, name: str = "the table") -> None:
    """Raise ``SchemaMismatch`` with all that keeps rows of ``source`` out of ``target``."""
    if len(source) != len(target):
        raise SchemaMismatch(f"{len(source)} columns for the {len(target)} of {name}: "
                             f"{', '.join(source.names)} for {', '.join(target.names)}")
    faults = []
    for i, (a, b) in enumerate(zip(source, target), 1):
        if not storable(a.dataType, b.dataType):
            faults.append(f"column {i}: {a.name} {a.dataType.simpleString()} "
                          f"cannot be stored as {b.name} {b.dataType.simpleString()}")
        elif a.nullable and not b.nullable:
            faults.append(f"column {i}: {a.name} may be NULL, {b.name} must not")
    if faults:
        raise SchemaMismatch(f"rows do not fit {name}: {'; '.join(faults)}")


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _files(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


def _fits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows under the target's names and types, by position."""
    return df.select(*[F.col(f"`{a}`").cast(b.dataType).alias(b.name) for a, b in zip(df.columns, schema)])


def _version(folder: str) -> str:
    return f"{folder.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"


def _drop_versions(spark: SparkSession, folder: str, keep: set[str]) -> None:
    """Delete versions but those in ``keep`` (names); the folder's own files, which a table
    had before its first refresh, go unless "" is kept."""
    for name in _children(spark, folder):
        own = not name.startswith(VERSION) and name != POINTER
        if ("" if own else name) not in keep and name != POINTER:
            _delete(spark, f"{folder}/{name}")


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of a sink's current rows; None before the first refresh."""
    if POINTER not in _children(spark, path):
        return None
    fs, pointer = _files(spark, f"{path.rstrip('/')}/{POINTER}")
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no refresh has been written to {path}")
    return spark.read.parquet(folder)


def _point_to(spark: SparkSession, path: str, name: str) -> None:
    """Replace the pointer in one rename."""
    jvm = spark._jvm
    fs, new = _files(spark, f"{path}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(name.encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, _files(spark, f"{path}/{POINTER}")[1], options)


def _refresh_folder(out: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    spark, path = out.sparkSession, path.rstrip("/")
    old, new = current_version(spark, path), _version(path)
    try:
        out.write.partitionBy(*partition_by).parquet(new)
    except Exception:
        _delete(spark, new)
        raise
    name = new.rsplit("/", 1)[1]
    _point_to(spark, path, name)
    _drop_versions(spark, path, {name, old.rsplit("/", 1)[1] if old else ""})


def table_details(spark: SparkSession, table: str) -> tuple[str, str, bool]:
    """(format, location, partitioned) of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    found = {r["col_name"]: r["data_type"] for r in rows}
    return found.get("Provider", "").lower(), found.get("Location", ""), "# Partition Information" in found


def _refresh_table(out: DataFrame, table: str) -> None:
    spark = out.sparkSession
    schema = spark.table(table).schema
    check_positional(out.schema, schema, table)
    kind, location, partitioned = table_details(spark, table)
    if kind not in FILE_FORMATS or partitioned or not location:
        out.write.insertInto(table, overwrite=True)
        return
    folder, _, last = location.rstrip("/").rpartition("/")
    old = last if last.startswith(VERSION) else ""
    folder = folder if old else location.rstrip("/")
    new = _version(folder)
    try:
        _fits(out, schema).write.format(kind).save(new)
    except Exception:
        _delete(spark, new)
        raise
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)
    _drop_versions(spark, folder, {new.rsplit("/", 1)[1], old})


def write_full_refresh(df: DataFrame, columns: tuple[str, ...], *, path: str | None = None,
                       table: str | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Replace all rows of a table or a folder sink by ``df``'s, in the order of ``columns``."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    out = df.select(*columns)
    if path is not None:
        _refresh_folder(out, path, partition_by)
    elif out.sparkSession.catalog.tableExists(table):
        _refresh_table(out, table)
    else:
        # the catalog knows the table once its rows are written
        w = out.write.format("parquet")
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(table)
