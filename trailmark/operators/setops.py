"""Unions of tables that must line up."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _bare(data_type: T.DataType) -> T.DataType:
    """A type without nullability."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _bare(f.dataType)) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_bare(data_type.elementType))
    return data_type


def _shape(frame: DataFrame, names: bool) -> list:
    return [
        (field.name.lower() if names else None, _bare(field.dataType)) for field in frame.schema.fields
    ]


def union_all(frames: Sequence[DataFrame], same_names: bool = True) -> DataFrame:
    """Positional union. Schemas must agree, by type only if ``same_names`` is off."""
    first, *rest = frames
    for other in rest:
        if _shape(first, same_names) != _shape(other, same_names):
            raise ValueError(f"schemas differ: {first.schema.simpleString()} / {other.schema.simpleString()}")
    return reduce(DataFrame.union, rest, first)


def union_distinct(frames: Sequence[DataFrame], same_names: bool = True) -> DataFrame:
    """Positional union without duplicate rows, within one input as well as across."""
    return union_all(frames, same_names).distinct()
