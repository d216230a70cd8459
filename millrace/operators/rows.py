"""Operators on the rows of a table: union, duplicates, limits, reports of counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import has_suffix, is_blank
from millrace.operators.columns import quoted


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name. A column missing in a table is NULL there; columns come in the order of
    their first appearance; duplicates stay. A column that is text in one table becomes text in
    all: under ANSI rules Spark would turn that text into numbers and fail on the first that is none.
    """
    if not dfs:
        raise ValueError("the list of tables is empty (la liste est vide)")
    texts = {f.name for df in dfs for f in df.schema if isinstance(f.dataType, T.StringType)}
    alike = [
        df.withColumns(
            {
                f.name: quoted(f.name).cast("string")
                for f in df.schema
                if f.name in texts and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.StringType)
            }
        )
        for df in dfs
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike)


def drop_null(df: DataFrame, column: str = "title") -> DataFrame:
    return df.where(quoted(column).isNotNull())


def blank_rows(df: DataFrame, column: str = "title") -> DataFrame:
    return df.where(is_blank(quoted(column)))


def with_suffix(df: DataFrame, column: str, suffix: str) -> DataFrame:
    return df.where(has_suffix(quoted(column), suffix))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(quoted(column).startswith(prefix))


def dedup(
    df: DataFrame,
    keys: Sequence[str] = ("title", "source"),
    normalized: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key; NULL keys are equal. The survivor is the smallest row.

    Rows compare by their other columns from left to right, NULL first, NaN last, so the result does
    not depend on partitioning. The smallest row is an aggregate: every task keeps one row per key
    before the shuffle, so a key that holds a third of the table arrives as one row per task.

    ``normalized`` maps keys to the expression they are compared by; the smallest original key then
    survives with its row.
    """
    normalized = normalized or {}
    grouping = [normalized.get(k, quoted(k)).alias(f"_key{i}") for i, k in enumerate(keys)]
    payload = [k for k in keys if k in normalized] + [c for c in df.columns if c not in keys]
    kept = [k for k in keys if k not in normalized]
    if not payload:
        return df.distinct()
    order = [_orderable(df.schema[c]) for c in payload]
    if all(o is None for o in order):
        survivor = F.min(F.struct(*[quoted(c) for c in payload]))
    else:
        survivor = F.min_by(
            F.struct(*[quoted(c) for c in payload]),
            F.struct(*[quoted(c) if o is None else o for c, o in zip(payload, order)]),
        )
    best = df.groupBy(*grouping).agg(survivor.alias("_row"))
    key_column = {k: F.col(f"_key{i}") for i, k in enumerate(keys) if k in kept}
    return best.select(
        *[
            (key_column[c] if c in key_column else F.col("_row").getField(c)).alias(c)
            for c in df.columns
        ]
    )


def dedup_any(df: DataFrame, keys: Sequence[str] = ("title", "source")) -> DataFrame:
    """One arbitrary row per key: Spark's own form, for callers to whom the survivor is all one."""
    return df.dropDuplicates(list(keys))


def _orderable(field: T.StructField) -> Column | None:
    """What a column is ordered by, or None for the column itself."""
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(quoted(field.name)))
    return None


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in an order. Every task keeps ``n`` rows, the rest is never shuffled.

    Without an order any ``n`` rows are returned.
    """
    return (df.orderBy(*order) if order else df).limit(n)


def preview(df: DataFrame, columns: Sequence[str], n: int, *order: Column | str, width: int = 35) -> DataFrame:
    """First rows of some columns, long text cut to ``width`` with an ellipsis."""
    shown = []
    for name in columns:
        text = quoted(name).cast("string")
        cut = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
        shown.append(F.when(F.length(text) > width, cut).otherwise(text).alias(name))
    return first_rows(df, n, *order).select(*shown)


def count_rows(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def rows_per_source(df: DataFrame, column: str = "source") -> DataFrame:
    """Rows per source plus a total row with NULL source and ``is_total`` 1.

    Counted first and rolled up after, so the rollup expands the few counts, not the table.
    """
    counts = df.groupBy(quoted(column).alias(column)).agg(F.count(F.lit(1)).alias("_n"))
    return counts.rollup(column).agg(
        F.sum("_n").alias("n_rows"), F.grouping(column).cast("int").alias("is_total")
    )


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(quoted(column)).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values a column takes, one per row."""
    return df.select(quoted(column).alias(column)).distinct()


def smallest(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.min(quoted(column)).alias(name))


def all_rows(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """Does the condition hold on every row? True on an empty table, as NULL counts as a failure
    only where a row exists."""
    return df.agg(F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(True)).alias(name))
