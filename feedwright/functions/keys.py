"""Lower-case every key of nested records (struct fields, map keys, arrays)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_keys_column(c: Column, dtype: T.DataType) -> Column:
    """Rebuild ``c`` with all struct field names and string map keys lower-cased."""
    if isinstance(dtype, T.StructType):
        # a null record stays null (it doesn't become a record of nulls)
        return F.when(c.isNotNull(), F.struct(*[lower_keys_column(c.getField(f.name), f.dataType).alias(f.name.lower())
                                                for f in dtype.fields]))
    if isinstance(dtype, T.ArrayType):
        if _has_keys(dtype.elementType):
            return F.transform(c, lambda x: lower_keys_column(x, dtype.elementType))
        return c
    if isinstance(dtype, T.MapType):
        m = c
        if isinstance(dtype.keyType, T.StringType):
            m = F.transform_keys(m, lambda k, v: F.lower(k))
        if _has_keys(dtype.valueType):
            m = F.transform_values(m, lambda k, v: lower_keys_column(v, dtype.valueType))
        return m
    return c


def _has_keys(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.MapType)) or (
        isinstance(dtype, T.ArrayType) and _has_keys(dtype.elementType))


def lower_keys(df: DataFrame) -> DataFrame:
    """Lower-case column names and every nested key; a narrow projection, no shuffle."""
    return df.select([lower_keys_column(F.col(f"`{f.name}`"), f.dataType).alias(f.name.lower())
                      for f in df.schema.fields])
