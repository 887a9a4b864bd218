"""Input rows -> (group columns, key, filtered metric values).

Shared by the exact rollup and the sketch build.  A row whose key is null or
empty, or which has a null in any metric column, keeps its group alive but
gets a null key (column ``KEY``), so it contributes to no tuple.  Multi-valued keys
(an ARRAY column) fan out to one row per element; duplicates count twice and
an empty list contributes nothing.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import (ColumnOrName, Metric, as_column, rows_with_complete_metrics,
                                 valid_key)

KEY = "__tc_k"


def group_columns(by: Sequence[ColumnOrName] | ColumnOrName | None) -> list[ColumnOrName]:
    if by is None:
        return []
    if isinstance(by, (str, Column)):
        return [by]
    return list(by)


def group_names(df: DataFrame, by: Sequence[ColumnOrName]) -> tuple[DataFrame, list[str]]:
    """Project Column-valued group expressions to named columns (their alias).

    One projection for all of them; an alias equal to an existing column
    replaces that column (``withColumn`` semantics)."""
    exprs = [b for b in by if not isinstance(b, str)]
    if not exprs:
        return df, [b for b in by]
    old = df.columns
    projected = df.select("*", *exprs)
    new_names = projected.columns[len(old):]
    if set(new_names) & set(old) or len(set(new_names)) != len(new_names):
        for b, name in zip(exprs, new_names):  # rare: an alias shadows a column
            df = df.withColumn(name, b)
    else:
        df = projected
    it = iter(new_names)
    return df, [b if isinstance(b, str) else next(it) for b in by]


def has_column(df: DataFrame, key: ColumnOrName) -> bool:
    """Whether the analyzer finds the column (any case, nested fields, back quotes)."""
    if not isinstance(key, str) or key in df.columns:
        return True
    try:
        df.select(key).schema  # noqa: B018
    except AnalysisException as e:
        if "UNRESOLVED_COLUMN" in str(e.getCondition()) or "FIELD_NOT_FOUND" in str(e.getCondition()):
            return False
        raise
    return True


def hashed_key(rows: DataFrame) -> Column:
    """The key of prepared rows as its hash reads it: an instant by its microseconds, in no time zone."""
    if isinstance(rows.schema[KEY].dataType, T.TimestampType):
        return F.unix_micros(F.col(KEY))
    return F.col(KEY)


def prepared(df: DataFrame, by: list[str], key: ColumnOrName,
             metrics: Sequence[Metric], keep_invalid: bool = True) -> DataFrame:
    """``by..., __tc_k (null = no key), __tc_m0.. DOUBLE`` (one per metric).

    ``_k`` keeps the key's own type (integers group faster than their text);
    :func:`key_text` gives the string form after aggregation, once per key.
    Floating-point keys are turned into text first so that key identity is
    always the identity of the text.  ``keep_invalid=False`` drops rows without
    a usable key instead of keeping them as group markers (the condition then
    reaches the Parquet scan as a pushed filter)."""
    key_col = as_column(key)
    if isinstance(key, str) and key in df.columns:
        key_type = df.schema[key].dataType  # cached schema, no analysis
    else:
        key_type = df.select(key_col).schema.fields[0].dataType
    ok = rows_with_complete_metrics(metrics)
    vals = [m.filtered().alias(f"__tc_m{i}") for i, m in enumerate(metrics)]
    if isinstance(key_type, T.ArrayType):
        # explode_outer keeps rows whose list is empty or null as group markers.
        df = df.select(*by, F.explode_outer(key_col).alias("__tc_kraw"), ok.alias("__tc_ok"), *vals)
        k, ok, elem_type = F.col("__tc_kraw"), F.col("__tc_ok"), key_type.elementType
        ms = [F.col(f"__tc_m{i}") for i in range(len(metrics))]
    else:
        k, elem_type, ms = key_col, key_type, vals
    if isinstance(elem_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        k = k.cast("string")
        elem_type = T.StringType()
    if isinstance(elem_type, T.StringType):
        valid = valid_key(k)
    else:
        valid = k.isNotNull()  # the text of a non-string value is never empty
    if not keep_invalid:
        return df.where(ok & valid).select(*by, k.alias(KEY), *ms)
    return df.select(*by, F.when(ok & valid, k).alias(KEY), *ms)


def key_text(c: Column) -> Column:
    return c.cast("string")
