"""Checks of keys, references, nulls and text lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import parse_date, string_columns
from starload.operators.dedupe import repeated_keys


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary key values held by more than one row."""
    return repeated_keys(df, keys)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Referenced keys without a parent and the number of rows that use them.

    Child rows are counted per key before the join, so the join sees each key once.
    """
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return used.join(known, child_key, "left_anti")


def _long_form(df: DataFrame, measures: dict[str, object], value: str) -> DataFrame:
    """One aggregation for all columns, turned into one row per column."""
    row = df.agg(*[measure.alias(f"m{i}") for i, measure in enumerate(measures.values())])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("column"), F.col(f"m{i}").alias(value)) for i, name in enumerate(measures)]
    )
    return row.select(F.inline(pairs))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _long_form(df, {c: F.count_if(F.col(c).isNull()) for c in columns or df.columns}, "nulls")


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Number of values longer than the column allows."""
    measures = {c: F.count_if(F.length(c) > n) for c, n in limits.items()}
    return _long_form(df, measures, "too_long")


def max_lengths(df: DataFrame) -> DataFrame:
    return _long_form(df, {c: F.max(F.length(c)) for c in string_columns(df)}, "max_length")


def rejected_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of texts per column that are present but no date."""
    measures = {
        c: F.count_if(F.col(c).isNotNull() & parse_date(F.col(c)).isNull()) for c in columns
    }
    return _long_form(df, measures, "rejected")
