"""Looking at data: schema, previews and single-value lookups, all as DataFrames or plain values."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable."""
    rows = [(field.name, field.dataType.simpleString(), field.nullable) for field in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean")


def schema_profile(df: DataFrame) -> DataFrame:
    """The schema with rows and NULLs counted per column, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(_named(field.name)).alias(f"n_{i}") for i, field in enumerate(df.schema)],
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("n_rows"),
            (F.col("n_rows") - F.col(f"n_{i}")).alias("n_null"),
        )
        for i, field in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*entries)))


def _cell(field: T.StructField, width: int) -> Column:
    value = _named(field.name)
    if isinstance(field.dataType, T.BinaryType):
        # a byte takes three characters, so `width` bytes always fill the cell
        head = F.substring(value, 1, width) if width > 0 else value
        text = F.concat(F.lit("["), F.regexp_replace(F.hex(head), "(..)(?!$)", "$1 "), F.lit("]"))
    else:
        text = value.cast("string")
    text = F.coalesce(text, F.lit("NULL"))
    if width > 0:
        if width < 4:
            cut = F.substring(text, 1, width)
        else:
            cut = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
        text = F.when(F.length(text) > width, cut).otherwise(text)
    return text.alias(field.name)


def preview(
    df: DataFrame,
    n: int = 20,
    truncate: int = 20,
    order_by: Sequence[str | Column] | str | None = None,
) -> DataFrame:
    """The first `n` rows with every cell as text cut to `truncate` characters (0: uncut).

    With `order_by` the rows are well defined and each task keeps only its own best `n`.
    """
    if order_by is not None:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(n).select(*[_cell(field, truncate) for field in df.schema])


def matching(df: DataFrame, key: str, value: Any) -> DataFrame:
    """Rows whose column `key` (any name, spaces included) equals `value`."""
    return df.where(_named(key) == F.lit(value))


def lookup_row(df: DataFrame, key: str, value: Any, columns: Sequence[str]) -> Row:
    """The one row with `key` = `value`; none or several is an error."""
    found = matching(df, key, value).select(*[_named(c) for c in columns]).limit(2).collect()
    if len(found) != 1:
        raise LookupError(f"{'no row' if not found else 'more than one row'} where {key!r} matches")
    return found[0]


def lookup_value(df: DataFrame, key: str, value: Any, column: str) -> Any:
    return lookup_row(df, key, value, [column])[column]
