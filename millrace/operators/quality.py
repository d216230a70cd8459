"""Data-quality rules, counted for a whole table: plain ones in one aggregation, unique keys in one each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import coerce_numeric, is_blank
from millrace.operators.columns import quoted


@dataclass(frozen=True)
class Rule:
    """A named rule; ``failures`` gives the aggregate that counts the rows breaking it.

    With ``key`` that aggregate runs over the counts ``_n`` of the key's values, not over the rows.
    """

    name: str
    failures: Callable[[DataFrame], Column]
    key: tuple[str, ...] = ()


def required(column: str) -> Rule:
    """The column exists; without it every row fails."""
    return Rule(
        f"required:{column}",
        lambda df: F.lit(0) if column in df.columns else F.count(F.lit(1)),
    )


def numeric(column: str) -> Rule:
    """Text that is there reads as a number."""
    return Rule(
        f"numeric:{column}",
        lambda df: F.count_if(quoted(column).isNotNull() & coerce_numeric(quoted(column)).isNull()),
    )


def unique(*columns: str) -> Rule:
    """No value twice. Rows with a NULL in the key are not compared, as in SQL's UNIQUE.

    The key's values are counted first, so copies of a key fold before the shuffle.
    """

    def failures(df: DataFrame) -> Column:
        complete = reduce(Column.__and__, [quoted(c).isNotNull() for c in columns])
        return F.coalesce(F.sum(F.when(complete, F.col("_n") - 1)), F.lit(0))

    return Rule(f"unique:{','.join(columns)}", failures, columns)


def domain(column: str, values: Sequence) -> Rule:
    """Only listed values; NULL fails."""
    return Rule(
        f"domain:{column}",
        lambda df: F.count_if(~F.coalesce(quoted(column).isin(*values), F.lit(False))),
    )


def in_range(column: str, low, high) -> Rule:
    """Between both bounds, bounds included; NULL and NaN fail."""
    return Rule(
        f"range:{column}",
        lambda df: F.count_if(~F.coalesce(quoted(column).between(low, high), F.lit(False))),
    )


def above(column: str, low) -> Rule:
    """Greater than the bound; NULL and NaN fail."""

    def failures(df: DataFrame) -> Column:
        passes = quoted(column) > low
        if isinstance(df.schema[column].dataType, T.FractionalType):
            passes = passes & ~F.isnan(quoted(column).cast("double"))
        return F.count_if(~F.coalesce(passes, F.lit(False)))

    return Rule(f"above:{column}", failures)


def not_blank(column: str) -> Rule:
    """Neither NULL nor the empty string."""
    return Rule(f"not_blank:{column}", lambda df: F.count_if(is_blank(quoted(column))))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows checked, rows failed, passed or not.

    Plain rules share one pass over the table, whose single row is then turned into one row per rule.
    Each uniqueness rule folds the table by its key once; no row is copied for it.
    """
    if not rules:
        raise ValueError("quality_report needs at least one rule")
    plain = [rule for rule in rules if not rule.key]
    reports = [_counted(df, plain, F.count(F.lit(1)))] if plain else []
    for rule in rules:
        if rule.key:
            folded = df.groupBy(*[quoted(c) for c in rule.key]).agg(F.count(F.lit(1)).alias("_n"))
            reports.append(_counted(folded, [rule], F.coalesce(F.sum("_n"), F.lit(0))))
    return reduce(DataFrame.unionAll, reports)


def _counted(df: DataFrame, rules: Sequence[Rule], checked: Column) -> DataFrame:
    counts = df.agg(
        checked.alias("_checked"),
        *[rule.failures(df).cast("long").alias(f"_failed{i}") for i, rule in enumerate(rules)],
    )
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col("_checked").alias("checked"),
            F.col(f"_failed{i}").alias("failed"),
            (F.col(f"_failed{i}") == 0).alias("passed"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))
