"""Columns of tables whose other columns may have any name and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain(docs: DataFrame, *known: str) -> DataFrame:
    """The table with names for all columns but the known ones that clash with nothing; ``toDF(*docs.columns)`` restores them."""
    return docs.toDF(*[name if name in known else f"other_column_{k}" for k, name in enumerate(docs.columns)])


def _unhashed(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _unhashed(kind.elementType)
    if isinstance(kind, StructType):
        return any(_unhashed(field.dataType) for field in kind.fields)
    return isinstance(kind, MapType | VariantType)


def row_hash(docs: DataFrame, seed: int) -> Column:
    """A seeded hash of whole rows. Maps and variants, which have no hash of their own, go by their JSON."""
    parts = [F.to_json(F.struct(quoted(f.name))) if _unhashed(f.dataType) else quoted(f.name) for f in docs.schema.fields]
    return F.xxhash64(F.lit(seed), *parts)
