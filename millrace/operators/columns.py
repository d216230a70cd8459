"""Operators on the schema of a table: names, types, defaults, constant columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import coerce_numeric, missing_number
from millrace.schemas import CANONICAL, TEXT_DEFAULTS


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case column names, ``-`` to ``_``."""
    return df.toDF(*[name.lower().replace("-", "_") for name in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the table does not have are passed over."""
    return df.withColumnsRenamed(dict(names))


def tag_source(df: DataFrame, value: str, column: str = "source", only_if_absent: bool = False) -> DataFrame:
    """Set a constant column, or leave the one that is there."""
    if only_if_absent and column in df.columns:
        return df
    return df.withColumn(column, F.lit(value))


def fill_text(df: DataFrame, defaults: Mapping[str, str] = TEXT_DEFAULTS) -> DataFrame:
    """NULL text becomes the column's default. Columns the table lacks are passed over."""
    present = {name: value for name, value in defaults.items() if name in df.columns}
    return df.withColumns(
        {name: F.coalesce(quoted(name).cast("string"), F.lit(value)) for name, value in present.items()}
    )


def coerce_and_fill(
    df: DataFrame,
    schema: T.StructType = CANONICAL,
    text_defaults: Mapping[str, str] = TEXT_DEFAULTS,
    missing: str = "null",
) -> DataFrame:
    """Bring the schema's columns that are present to their types and defaults.

    Other columns stay, and absent columns stay absent: the union fills those with NULL.
    """
    return df.withColumns(
        {
            field.name: _conformed(df, field, text_defaults, missing)
            for field in schema
            if field.name in df.columns
        }
    )


def conform(
    df: DataFrame,
    schema: T.StructType = CANONICAL,
    text_defaults: Mapping[str, str] = TEXT_DEFAULTS,
    missing: str = "null",
) -> DataFrame:
    """Exactly the schema's columns in its order: absent ones added, text as blank, others dropped, all
    coerced and filled. One projection, so unused columns never leave the scan."""
    return df.select(*[_conformed(df, f, text_defaults, missing).alias(f.name) for f in schema])


def _conformed(df: DataFrame, field: T.StructField, text_defaults: Mapping[str, str], missing: str) -> Column:
    absent = field.name not in df.columns
    if isinstance(field.dataType, T.DoubleType):
        if absent:
            return missing_number(F.lit(None).cast("double"), missing)
        if isinstance(df.schema[field.name].dataType, T.NumericType):
            return missing_number(quoted(field.name).cast("double"), missing)
        return coerce_numeric(quoted(field.name), missing)
    value = F.lit(None).cast(field.dataType) if absent else quoted(field.name).try_cast(field.dataType)
    if field.name in text_defaults:
        value = F.coalesce(value, F.lit("" if absent else text_defaults[field.name]))
    return value


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def as_number(df: DataFrame, column: str) -> Column:
    """A column as double. Text that is no number is NULL; a NaN that is there stays."""
    return coerce_numeric(quoted(column)) if is_text(df, column) else quoted(column).cast("double")


def require_columns(df: DataFrame, names: Sequence[str], operator: str) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"{operator} needs the columns {absent}; run conform first")
