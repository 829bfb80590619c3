"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """First row per key in the given order, all columns kept; missing keys are equal.

    The order should name all columns by which equal-key rows differ and that matter
    later; with none given it is a hash of the whole row, which reads every column.
    Spark trims each key to one row per map task before the shuffle
    (WindowGroupLimit), so a hot key reaches its reducer as a handful of rows. A short hash of
    the key, as it is shuffled, stands before it, because rows are sorted by their first column's
    bits and compared in full only where these are equal.
    """
    if not keys:
        raise ValueError("keep_first needs a key")
    by = list(order) or [F.xxhash64(*df.columns)]
    rank = F.row_number().over(Window.partitionBy(F.hash(*keys), *keys).orderBy(*by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame, keys: Sequence[str], date: str, order: Sequence[Column | str]
) -> DataFrame:
    """Most recent row per key; rows without a date come last."""
    return keep_first(df, keys, [F.col(date).desc_nulls_last(), *order])


class Source(NamedTuple):
    """Rows of one table, the key they are deduplicated by, and which row of a key is first:
    numbers and texts, ascending, missing ones first."""

    rows: DataFrame
    keys: Sequence[Column]
    order: Sequence[Column]


def descending_date(date: Column) -> Column:
    """A number that puts later dates first and missing ones last."""
    return F.coalesce(-F.unix_date(date).cast("double"), F.lit(float("inf")))


def _is_text(kind) -> bool:
    return isinstance(kind, StringType)


def keep_first_stacked(sources: Mapping[str, Source], columns: Mapping[str, str], tag: str = "site") -> DataFrame:
    """The first row per key of each table, all tables in one shuffle.

    `columns` names what is kept of a row, with types; a table that lacks a column has NULL
    there, and `tag` holds the table's name. Keys and orders may differ in number and type from
    table to table: numbers go to number columns, texts to text columns, so that all tables
    share one window. Numbers are compared as doubles. A kept column that is a key or an order
    of its table is read from there, and not shuffled a second time.
    """
    slots: dict[str, dict[str, Column]] = {}
    for name, source in sources.items():
        own = slots[name] = {}
        for part, exprs in (("k", source.keys), ("o", source.order)):
            kinds = [f.dataType for f in source.rows.select(*[e.alias(str(i)) for i, e in enumerate(exprs)]).schema]
            for i, (expr, kind) in enumerate(zip(exprs, kinds)):
                # a key's place does not matter, an order's does
                at = sum(_is_text(k) == _is_text(kind) for k in kinds[:i]) if part == "k" else i
                own[f"_{part}{at}{'t' if _is_text(kind) else 'n'}"] = expr if _is_text(kind) else expr.cast("double")
    used = sorted({s for own in slots.values() for s in own})

    def held(name: str, column: str) -> str | None:
        """The slot that holds a column of the table as it is."""
        same = [s for s, e in slots[name].items() if str(e) in (str(F.col(column)), str(F.col(column).cast("double")))]
        exact = columns[column] in ("string", "double", "boolean")
        return same[0] if same and exact and (columns[column] == "string") == same[0].endswith("t") else None

    sent = [c for c in columns if any(c in s.rows.columns and not held(n, c) for n, s in sources.items())]

    def shaped(name: str, source: Source) -> DataFrame:
        empty = {s: F.lit(None).cast("string" if s.endswith("t") else "double") for s in used}
        kept = [
            (F.col(c) if c in source.rows.columns and not held(name, c) else F.lit(None)).cast(columns[c]).alias(c) for c in sent]
        return source.rows.select(
            F.lit(name).alias(tag), *kept, *[(empty | slots[name])[s].alias(s) for s in used])

    stack = reduce(DataFrame.union, [shaped(n, s) for n, s in sources.items()])
    keys = [tag, *[s for s in used if s.startswith("_k")]]
    first = keep_first(stack, keys, [s for s in used if s.startswith("_o")])

    def restored(column: str) -> Column:
        out = F.col(column) if column in sent else F.lit(None).cast(columns[column])
        for name, source in sources.items():
            slot = held(name, column) if column in source.rows.columns else None
            if slot:
                out = F.when(F.col(tag) == name, F.col(slot).cast(columns[column])).otherwise(out)
        return out.alias(column)

    return first.select(tag, *[restored(c) for c in columns])
