"""Append a suffix to labels outside a fixed set: as built-in expression, as SQL function, and as Arrow UDF."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def with_suffix(label: Column, keep: list[str], suffix: str) -> Column:
    """Built-in form: stays in generated code and passes nulls through."""
    return F.when(label.isin(keep), label).otherwise(F.concat(label, F.lit(suffix)))


def suffix_udf(keep: list[str], suffix: str):
    """Python form, called once for a whole Arrow array; a null label is an error."""
    kept = pa.array(sorted(set(keep)), pa.string())

    @F.arrow_udf("string")
    def add_suffix(labels: pa.Array) -> pa.Array:
        if labels.null_count:
            raise TypeError("cannot add a suffix to a label that is a NoneType")
        return pc.if_else(pc.is_in(labels, kept), labels, pc.binary_join_element_wise(labels, suffix, ""))

    return add_suffix


def create_suffix_function(spark: SparkSession, name: str = "add_suffix") -> str:
    """SQL form, ``add_suffix(label, keep, suffix)``, for queries and views: its body becomes part of the plan that calls it."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(label STRING, keep ARRAY<STRING>, suffix STRING) RETURNS STRING"
        " COMMENT 'the label, with the suffix unless it is one to keep' RETURN CASE WHEN array_contains(keep, label) THEN label ELSE label || suffix END"
    )
    return name
