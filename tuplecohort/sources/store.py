"""Stored sketch tables: Parquet with the sketch as a nested struct column.

Writing partitions by the group columns (e.g. a day), so a later merge over a
date range reads only the needed partitions, and the estimate reads only the
``theta`` and ``entries.h`` leaves (nested column pruning).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sketch import SKETCH_TYPE, sketch_valid


def _strip(dt: T.DataType) -> T.DataType:
    """The type with every nullability flag set, for shape comparison."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _strip(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_strip(dt.elementType), True)
    return dt


def is_sketch_type(dt: T.DataType) -> bool:
    return _strip(dt) == _strip(SKETCH_TYPE)


def check_sketch_column(df: DataFrame, column: str) -> DataFrame:
    """Raise unless ``column`` has the sketch layout; returns ``df`` (for chaining)."""
    if column not in df.columns:
        raise ValueError(f"sketch column {column!r} not found in {df.columns}")
    dt = df.schema[column].dataType
    if not is_sketch_type(dt):
        raise TypeError(f"column {column!r} is {dt.simpleString()}, "
                        f"expected {SKETCH_TYPE.simpleString()}")
    return df


def as_sketch_column(df: DataFrame, column: str, validate: bool = False) -> DataFrame:
    """Ingest a column that already carries sketches: check its type and cast to
    the canonical type (null values pass through).  ``validate`` also checks
    every value's invariants when the data is read (a bad row raises)."""
    check_sketch_column(df, column)
    c = F.col(column).cast(SKETCH_TYPE)
    if validate:
        c = F.when(sketch_valid(c), c).otherwise(
            F.raise_error(F.lit(f"column {column!r} holds a value that is not a valid sketch")))
    return df.withColumn(column, c)


def write_sketches(df: DataFrame, path: str, sketch: str = "sketch",
                   partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    check_sketch_column(df, sketch)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_sketches(spark: SparkSession, path: str, sketch: str = "sketch",
                  validate: bool = False) -> DataFrame:
    return as_sketch_column(spark.read.parquet(path), sketch, validate=validate)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A stream over a Parquet table: a folder of part files, or a single file.

    A folder is read as it stands (later files included).  A file is read through its folder, filtered by its name:
    file streams take folders only."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_file = hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(hpath).isFile()
    stream = spark.readStream.schema(schema)
    return stream.option("pathGlobFilter", name).parquet(folder) if is_file else stream.parquet(path)
