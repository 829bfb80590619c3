"""Equi-joins with natural and null-safe keys, and the size check before a broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def _bytes(name: str, kind) -> Column:
    """About how many bytes a column's value takes."""
    if isinstance(kind, StringType):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.col(name))), F.lit(0))
    return F.lit(8)


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mark a table for broadcast after measuring it; a larger one is left to a shuffle join.

    One aggregate of one row, summed in the tasks, gives the rows and their bytes.
    """
    row = sum((_bytes(f.name, f.dataType) for f in df.schema), F.lit(16))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("long")).alias("bytes")).first()
    return F.broadcast(df) if size.n <= max_rows and (size.bytes or 0) <= max_bytes else df


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, whose plan fails where a key (a missing one counts) stands in two rows, as such a key
    would multiply the rows that look it up.

    Nothing runs while the plan is built: rows are counted per key where they are used, with
    the partitioning and order that a shuffle join on these keys needs anyway.
    """
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    message = F.concat(F.lit("the look-up has a key twice: "), F.to_json(F.struct(*keys)))
    counted = df.withColumn("_times", times)
    return counted.where(F.assert_true(F.col("_times") <= 1, message).isNull()).drop("_times")


def natural_left(left: DataFrame, right: DataFrame, unique: bool = False) -> DataFrame:
    """Left join on every column name the two tables share.

    With `unique` the plan fails where the right table holds a key twice (`unique_keys`);
    without it such a key multiplies rows, as in any join.
    """
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("natural join of tables without a common column")
    if unique:
        right = unique_keys(right, common)
    return left.join(right, common, "left").select(
        *left.columns, *[c for c in right.columns if c not in common]
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    )
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def null_safe_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where a missing key equals a missing key."""
    return _null_safe(left, right, keys, "left")


def null_safe_inner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _null_safe(left, right, keys, "inner")


def semi(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the dimension; a missing key never does."""
    return df.join(dim.select(key), key, "left_semi")
