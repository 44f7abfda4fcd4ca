"""Landing nested and wide snapshots, and telling changed snapshots from unchanged ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.names import column
from quotelake.functions.hashing import multiset_digest, row_digest
from quotelake.operators.dedup import keep_first

EXTRACTED = "extraction_timestamp"


def tag_extraction(df: DataFrame, **constants: str) -> DataFrame:
    """Add constant columns and the time of extraction as ISO text."""
    tagged = df.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else df
    return tagged.withColumn(EXTRACTED, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def text_column(field: T.StructField) -> Column:
    """One column as a string; nested values as JSON."""
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column(field.name)).alias(field.name)
    return column(field.name).cast("string").alias(field.name)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[text_column(f) for f in df.schema])


def parse_snapshot(df: DataFrame, payload: str, schema: T.StructType | str, keys: Sequence[str]) -> DataFrame:
    """One JSON object per row to one row of columns, next to its keys."""
    return df.select(F.from_json(payload, schema).alias("_p"), *keys).select("_p.*", *keys)


def flatten_categories(df: DataFrame, payload: str, keys: Sequence[str]) -> DataFrame:
    """A JSON object of categories to rows (keys, category, item, fields).

    A category that holds an object gives one row, one that holds a list gives a row per object in it;
    anything else gives none. ``fields`` is a map of text.
    """
    content = F.col("_content")
    objects = F.when(content.startswith("{"), F.array(F.from_json(content, "map<string,string>"))).when(
        content.startswith("["),
        F.transform(
            F.filter(F.from_json(content, "array<string>"), lambda item: item.startswith("{")),
            lambda item: F.from_json(item, "map<string,string>"),
        ),
    )
    categories = df.select(*keys, F.explode(F.from_json(payload, "map<string,string>")).alias("category", "_content"))
    return categories.select(*keys, "category", F.posexplode(objects).alias("item", "fields"))


def widen(df: DataFrame, fields: str, names: Sequence[str]) -> DataFrame:
    """Named entries of a map column as columns of their own."""
    others = [c for c in df.columns if c != fields]
    return df.select(*others, *[F.try_element_at(fields, F.lit(n)).alias(n) for n in names])


def overlay(*maps: Column) -> Column:
    """One map from several; a later map wins, a missing map changes nothing."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")

    def over(below: Column, above: Column) -> Column:
        kept = F.map_filter(below, lambda key, _: ~F.map_contains_key(above, key))
        return F.map_concat(kept, above)

    merged = F.coalesce(maps[0], empty)
    for later in maps[1:]:
        merged = over(merged, F.coalesce(later, empty))
    return merged


def transpose_statement(
    statement: DataFrame, keys: Sequence[str], item: str, items: Sequence[str] | None = None, period: str = "period"
) -> DataFrame:
    """Items in rows and periods in columns become periods in rows and items in columns.

    Every item becomes a column; ``items`` only names columns to have besides, or to have first.
    """
    periods = [c for c in statement.columns if c not in (*keys, item)]
    found = {r[0] for r in statement.select(item).where(F.col(item).isNotNull()).distinct().collect()}
    items = [*(items or ()), *sorted(found.difference(items or ()))]
    # one struct of quoted columns, since names may hold dots
    cells = F.array(*[F.struct(F.lit(c).alias(period), column(c).alias("_value")) for c in periods])
    long = statement.select(*map(column, keys), column(item), F.inline(cells))
    return long.groupBy(*keys, period).pivot(item, list(items)).agg(F.first("_value", ignorenulls=True))


def reference_keys(info: DataFrame, key: str, first_by: str = "ticker") -> DataFrame:
    """Each non-empty key once, with the first row that names it."""
    return keep_first(info.where(F.col(key).isNotNull() & (F.col(key) != "")), [key], [first_by])


def content_digests(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One digest per logical key over all columns but the time of extraction, whatever the row order."""
    content = [c for c in df.columns if c != EXTRACTED]
    return df.groupBy(*map(column, keys)).agg(multiset_digest(row_digest(content)).alias("content_hash"))


def compare_digests(current: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the current run with status new, changed or unchanged."""
    before = stored.select(*keys, F.col("content_hash").alias("_before"), F.lit(True).alias("_known"))
    status = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("content_hash").eqNullSafe(F.col("_before")), "unchanged")
        .otherwise("changed")
    )
    return current.join(before, list(keys), "left").select(*keys, "content_hash", status.alias("status"))


def changed_rows(df: DataFrame, compared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the keys that are new or changed: the ones worth writing."""
    return df.join(compared.where(F.col("status") != "unchanged").select(*keys), list(keys), "left_semi")
