"""Differences between two versions of a table and their application.

Keys are compared with plain equality, so a null key matches nothing; all other
columns are compared null-safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.functions.columns import all_of, any_null, any_of, differs

OP = "_op"
INSERT, UPDATE, DELETE, SAME = "INSERT", "UPDATE", "DELETE", "SAME"


def compared_columns(new: DataFrame, keys: list[str]) -> list[str]:
    return [name for name in new.columns if name not in keys]


def _keys_match(keys: list[str]):
    return all_of([F.col(f"new.{key}") == F.col(f"old.{key}") for key in keys])


def rows_to_update(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key exists in ``old`` with other values.

    A semi join: a row is listed once however many old rows it differs from. A table
    of keys alone has nothing to compare and gives no rows.
    """
    changed = any_of([differs(F.col(f"new.{c}"), F.col(f"old.{c}")) for c in compared_columns(new, keys)])
    return new.alias("new").join(old.alias("old"), _keys_match(keys) & changed, "left_semi")


def rows_to_insert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key is not in ``old``."""
    return new.alias("new").join(old.alias("old"), _keys_match(keys), "left_anti")


def rows_to_delete(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key is not in ``new``."""
    return rows_to_insert(new, old, keys)


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The same rows; the job fails on a key that occurs twice.

    Counted over the partitioning and order that a join on the keys needs as well, so
    the check adds no shuffle to it.
    """
    message = F.concat(F.lit(f"{what} holds a key more than once: "), F.to_json(F.struct(*keys)))
    alone = F.when(F.col("_same_key") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return df.withColumn("_same_key", F.count("*").over(W.partitionBy(*keys))).filter(alone).drop("_same_key")


def _refuse(df: DataFrame) -> DataFrame:
    """No row passes: the first one fails the job."""
    message = F.concat(F.lit("the new version holds a row with a null key: "), F.to_json(F.struct(*df.columns)))
    return df.filter(F.raise_error(message).cast("boolean"))


def classify(
    old: DataFrame, new: DataFrame, keys: list[str], null_keys: str = "insert", check_keys: bool = True
) -> DataFrame:
    """Every key of either side once, with ``_op`` and both images, from a single join.

    Columns: the keys, ``_op``, ``old_<c>`` for the other columns of ``old`` and
    ``new_<c>`` for those of ``new``. Keys have to be unique on each side, or the job fails
    (``check_keys=False`` trusts the caller). Rows with a null key can match nothing and
    skip the join: those of ``old`` stay as they are, those of ``new`` are inserted,
    refused with an error (``error``) or dropped (``reject``).
    """
    if null_keys not in ("reject", "insert", "error"):
        raise ValueError(f"unknown null key policy {null_keys!r}")
    compare = compared_columns(new, keys)
    rest = compared_columns(old, keys)
    missing = [name for name in compare if name not in rest]
    if missing:
        raise ValueError(f"columns {missing} are not in the old version")

    old_side = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in rest], F.lit(True).alias("_in_old"))
    new_side = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in compare], F.lit(True).alias("_in_new"))
    left, right = old_side.filter(~any_null(keys)), new_side.filter(~any_null(keys))
    if check_keys:
        left, right = require_unique(left, keys, "the old version"), require_unique(right, keys, "the new version")
    joined = left.join(right, keys, "full_outer")
    nullable = {f.name for side in (old, new) for f in side.schema if f.nullable}
    if nullable.intersection(keys):
        joined = joined.unionByName(
            old_side.filter(any_null(keys)).withColumn("_in_new", F.lit(None).cast("boolean"))
            .withColumn("_unmatched", F.lit(True)),
            allowMissingColumns=True,
        )
        if null_keys != "reject":
            lost = new_side.filter(any_null(keys))
            lost = _refuse(lost) if null_keys == "error" else lost
            joined = joined.unionByName(lost, allowMissingColumns=True)
    else:
        joined = joined.withColumn("_unmatched", F.lit(None).cast("boolean"))
    changed = any_of([differs(F.col(f"old_{c}"), F.col(f"new_{c}")) for c in compare])
    op = (
        F.when(F.col("_in_old").isNull(), INSERT)
        .when(F.col("_unmatched"), SAME)
        .when(F.col("_in_new").isNull(), DELETE)
        .when(changed, UPDATE)
        .otherwise(SAME)
    )
    return joined.select(
        *keys, op.alias(OP), *[f"old_{c}" for c in rest], *[f"new_{c}" for c in compare]
    )


def apply_changes(
    classified: DataFrame,
    keys: list[str],
    insert: bool = True,
    update: bool = True,
    delete: bool = False,
) -> DataFrame:
    """The table after the change; a switched-off operation leaves the old state.

    Columns only the old side has keep their value and are null for inserted rows.
    """
    rest = [c.removeprefix("old_") for c in classified.columns if c.startswith("old_")]
    compare = {c.removeprefix("new_") for c in classified.columns if c.startswith("new_")}
    written = [name for name, on in ((INSERT, insert), (UPDATE, update)) if on]
    skipped = [name for name, off in ((INSERT, not insert), (DELETE, delete)) if off]
    takes_new = F.col(OP).isin(written) if written else F.lit(False)

    def image(name: str):
        if name not in compare:
            return F.col(f"old_{name}").alias(name)
        return F.when(takes_new, F.col(f"new_{name}")).otherwise(F.col(f"old_{name}")).alias(name)

    kept = classified.filter(~F.col(OP).isin(skipped)) if skipped else classified
    return kept.select(*keys, *[image(name) for name in rest])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], check_keys: bool = True, **switches) -> DataFrame:
    """``old`` with the rows of ``new`` inserted and updated; ``delete=True`` mirrors ``new``."""
    null_keys = switches.pop("null_keys", "insert")
    return apply_changes(classify(old, new, keys, null_keys, check_keys), keys, **switches)


def mirror(old: DataFrame, new: DataFrame, keys: list[str], **options) -> DataFrame:
    return upsert(old, new, keys, delete=True, **options)


def upsert_sql(
    spark: SparkSession, sql_old: str, sql_new: str, keys: list[str], check_keys: bool = True, **switches
) -> DataFrame:
    """Upsert of two queries over tables and views of the session."""
    return upsert(spark.sql(sql_old), spark.sql(sql_new), keys, check_keys, **switches)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``, comparing whole rows null-safe.

    Copies are collapsed on both sides before the join.
    """
    return left.distinct().subtract(right.distinct())


def change_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(OP).agg(F.count("*").alias("n"))


def change_feed(
    classified: DataFrame,
    keys: list[str],
    insert: bool = True,
    update: bool = True,
    delete: bool = False,
) -> DataFrame:
    """Rows to write with their operation: whole new image, or just the keys for a delete."""
    compare = [c.removeprefix("new_") for c in classified.columns if c.startswith("new_")]
    chosen = [name for name, on in ((INSERT, insert), (UPDATE, update), (DELETE, delete)) if on]
    image = [F.col(f"new_{name}").alias(name) for name in compare]
    return classified.filter(F.col(OP).isin(chosen) if chosen else F.lit(False)).select(OP, *keys, *image)
