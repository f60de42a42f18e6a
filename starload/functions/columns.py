"""Column expressions and schema-driven column choices."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_DATE = "yyyy-MM-dd"


def any_of(conditions: list[Column]) -> Column:
    """OR over conditions; false when there are none."""
    return reduce(or_, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions) if conditions else F.lit(True)


def any_null(names: list[str]) -> Column:
    return any_of([F.col(name).isNull() for name in names])


def is_true(condition: Column) -> Column:
    """A condition whose unknown (null) outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)


def parse_date(text: Column, strict: bool = False) -> Column:
    """ISO text to date; text that is no date gives null, or an error when ``strict``."""
    if strict:
        return F.to_date(text, ISO_DATE)
    # A year has four digits or a sign. The parser makes an exception for every other text, which costs many times a date.
    fits = (F.length(text) == len(ISO_DATE)) | F.substring(text, 1, 1).isin("+", "-")
    return F.when(fits, F.try_to_date(text, ISO_DATE))


def text_to_int(text: Column, strict: bool = True) -> Column:
    """Padded text to integer; blank is null, garbage is an error unless ``strict`` is off."""
    filled = F.nullif(F.trim(text), F.lit(""))
    return filled.cast("int") if strict else filled.try_cast("int")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


# Amounts are summed in so many decimal digits, so many of them after the point.
MONEY = "decimal(38,6)"


def money_sum(amount: Column) -> Column:
    """Sum in decimals so the result does not depend on the order of the rows.

    Amounts count to a millionth; a sum of 10 ** 32 or more is an error.
    """
    return F.sum(amount.cast(MONEY)).cast("double")


def columns_of_type(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, kind)]


def array_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.ArrayType)


def string_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.StringType)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])
