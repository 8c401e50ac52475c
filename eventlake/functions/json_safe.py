"""Turn any row into values that plain JSON can carry, by column type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.text import bytes_to_text
from eventlake.functions.times import iso_text

_PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.NullType)


def json_safe_column(c: Column, dtype: T.DataType) -> Column:
    """Dates and times become ISO text, decimals doubles, NaN and infinities null, binary text,
    map keys strings; arrays, maps and structs are treated entry by entry; the rest is text."""
    if isinstance(dtype, _PLAIN):
        return c
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c)
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.BinaryType):
        return bytes_to_text(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: json_safe_column(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        safe = F.transform_values(c, lambda _, v: json_safe_column(v, dtype.valueType))
        if isinstance(dtype.keyType, T.StringType):
            return safe
        return F.transform_keys(safe, lambda k, _: k.cast("string"))
    if isinstance(dtype, T.StructType):
        fields = [json_safe_column(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c.cast("string")


def json_safe(df: DataFrame) -> DataFrame:
    """All columns of ``df`` made JSON-safe; types that are safe already pass unchanged."""
    return df.select(*[json_safe_column(df[f.name], f.dataType).alias(f.name) for f in df.schema.fields])


def json_rows(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON text per row. Nulls are written out, so every row has every field."""
    safe = json_safe(df)
    return safe.select(F.to_json(F.struct(*safe.columns), {"ignoreNullFields": "false"}).alias(column))


def computed_once(c: Column) -> Column:
    """A generator giving exactly this value, for ``select``.

    A filter on its result stays above it. Without that, the optimizer moves the filter below and
    repeats the expression in it, which doubles the cost of parsing JSON.
    """
    return F.explode(F.array(c))


def id_text(c: Column) -> Column:
    """64-bit ids as text, so that readers with double-precision numbers keep every digit."""
    return c.cast("string")
