"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(kind: T.DataType) -> T.DataType:
    """The type with every decimal, however deep, as a double."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(_plain(kind.keyType), _plain(kind.valueType), kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType), f.nullable) for f in kind])
    return kind


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, replacing what was there; NULLs are written, decimals become floats."""
    columns = []
    for field in df.schema:
        plain = _plain(field.dataType)
        column = F.col(f"`{field.name}`")
        columns.append(column if plain == field.dataType else column.cast(plain).alias(field.name))
    df.select(*columns).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_routed(df: DataFrame, path: str, column: str = "feed", mode: str = "overwrite") -> None:
    """All feeds in one pass and without a shuffle: a task writes at most one file per feed."""
    df.write.mode(mode).partitionBy(column).parquet(path)
