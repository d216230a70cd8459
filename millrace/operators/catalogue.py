"""The steps that turn the union of all sources into the catalogue table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from millrace.functions.buckets import price_category, rating_label
from millrace.functions.text import in_stock, is_blank
from millrace.operators.columns import as_number, is_text, require_columns
from millrace.operators.rows import dedup, union_sources
from millrace.schemas import DEFAULT_AVAILABILITY, DEFAULT_PRICE, PIPELINE_VERSION

KEYS = ("title", "source")


def clean(
    df: DataFrame,
    normalize_keys: bool = False,
    blank_is_missing: bool = False,
    missing: str = "null",
) -> DataFrame:
    """Drop rows without a title, keep one row per title and source, fill in defaults.

    Keys compare as they stand, so ``" A"`` and ``"A"`` are two titles; ``normalize_keys`` compares
    them trimmed (and the source lower-cased), which makes the whole transform idempotent.
    A NaN price counts as missing; ``missing="keep"`` leaves it NaN.
    """
    require_columns(df, ("title", "source", "availability", "price"), "clean")
    titled = df.where(~is_blank(F.col("title"))) if blank_is_missing else df.where(F.col("title").isNotNull())
    normalized = {"title": F.trim("title"), "source": F.lower(F.trim("source"))} if normalize_keys else None
    absent = F.col("price").isNull()
    if missing == "null" and not is_text(df, "price"):
        absent = absent | F.isnan(F.col("price").cast("double"))
    return dedup(titled, KEYS, normalized).withColumns(
        {
            "availability": F.coalesce(F.trim("availability"), F.lit(DEFAULT_AVAILABILITY)),
            # a text price that is there but no number is not absent: it becomes NULL, not the default
            "price": F.when(absent, F.lit(DEFAULT_PRICE)).otherwise(as_number(df, "price")),
        }
    )


def normalize(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Set types, trim text, lower-case the source, stamp the run.

    ``run_ts`` without a time zone is read as UTC; without ``run_ts`` it is the time of the query.
    """
    require_columns(df, ("title", "source", "availability", "price"), "normalize")
    if run_ts is None:
        stamp = F.current_timestamp()
    else:
        stamp = F.lit(run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc))
    return df.withColumns(
        {
            "price": as_number(df, "price"),
            "source": F.lower(F.trim(F.col("source").cast("string"))),
            "title": F.trim("title"),
            "availability": F.trim("availability"),
            "processed_at": stamp.cast("timestamp"),
            "pipeline_version": F.lit(PIPELINE_VERSION),
        }
    )


def enrich(df: DataFrame) -> DataFrame:
    """Price category, stock flag and rating label, each where its input column exists."""
    derived = {}
    if "price" in df.columns:
        derived["price_category"] = price_category(as_number(df, "price"))
    if "availability" in df.columns:
        derived["is_available"] = in_stock(F.col("availability"))
    if "rating" in df.columns:
        derived["rating_label"] = rating_label(as_number(df, "rating"))
    return df.withColumns(derived) if derived else df


def transform(
    dfs: Sequence[DataFrame],
    run_ts: datetime | None = None,
    normalize_keys: bool = False,
    blank_is_missing: bool = False,
    missing: str = "null",
) -> DataFrame:
    """Union, clean, normalize, enrich: one lazy plan with one shuffle."""
    return (
        union_sources(dfs)
        .transform(clean, normalize_keys, blank_is_missing, missing)
        .transform(normalize, run_ts)
        .transform(enrich)
    )
