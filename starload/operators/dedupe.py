"""Removal of repeated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import any_null, is_true


def keep_first(
    df: DataFrame, keys: list[str], tiebreak: list[str] | None = None, null_equal: bool = False
) -> DataFrame:
    """Keep one row per key, the first by ``tiebreak`` and then all other columns, ascending, nulls first.

    A null in the key matches nothing, so such rows all stay, unless ``null_equal``.
    The first row is the least struct of a group, an aggregate that is computed within
    each task before the shuffle: a key with very many copies sends one row per task.
    """
    order = tiebreak or []
    # grouping turns -0.0 into 0.0, so floating keys are read back from the row itself
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    inside = [*order, *[c for c in df.columns if c not in order and (c not in keys or c in floating)]]
    outside = [key for key in keys if key not in inside]

    def least(rows: DataFrame) -> DataFrame:
        if not inside:
            return rows.select(*keys).distinct()
        if len(inside) == 1 and inside[0] in keys and not null_equal:
            # one number without nulls needs no struct, whose least value Spark finds by sorting
            return rows.groupBy(*keys).agg(F.min(inside[0]).alias("_first")).select(*outside, F.col("_first").alias(inside[0])).select(*df.columns)
        first = rows.groupBy(*keys).agg(F.min(F.struct(*inside)).alias("_first"))
        return first.select(*outside, "_first.*").select(*df.columns)

    if null_equal:
        return least(df)
    return least(df.filter(~any_null(keys))).unionByName(df.filter(any_null(keys)))


def distinct_where(df: DataFrame, condition: Column) -> DataFrame:
    """Distinct rows where the condition holds; other rows pass untouched."""
    chosen = is_true(condition)
    return df.filter(chosen).distinct().unionByName(df.filter(~chosen))


def distinct_years(df: DataFrame, years: list[int], lineage: str) -> DataFrame:
    """Distinct rows of the given file years, the rest as it is."""
    return distinct_where(df, F.col(lineage).cast("int").isin([int(year) for year in years]))


def repeated_keys(df: DataFrame, keys: list[str], row_id: str | None = None) -> DataFrame:
    """Keys held by more than one row, with their count and optionally the least row id."""
    measures = [F.count("*").alias("copies")]
    if row_id:
        measures.append(F.min(row_id).alias("first_id"))
    return df.groupBy(*keys).agg(*measures).filter("copies > 1")
