"""Expansion, wide-to-long, and union of ragged tables. All but `pivot_inventory` are narrow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from rentloom import fixed_values as fixed
from rentloom.functions.text import (
    one_line, parse_number, piece, piece_or_empty, replace_all, trim_space,
)

MOST_STEPS = 10_000


def sentinel_to_null(
    df: DataFrame,
    sentinels: Sequence[str] = (fixed.MISSING_ON_SITE,),
    trim: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Sentinel texts to NULL in every text column, which may first be trimmed to one line."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, StringType)]

    def clean(c):
        text = one_line(F.col(c)) if trim else F.col(c)
        return F.when(~text.isin(*sentinels), text) if sentinels else text

    return df.withColumns({c: clean(c) for c in names})


def inlined(df: DataFrame, kept: Sequence[str], cells: Column) -> DataFrame:
    """One row per struct of the array `cells`, with the columns kept; none where it is empty.

    The array is worked out once a row, in compiled code: a generator given an expression
    interprets it, and one that drops empty arrays has it worked out again for a filter.
    """
    rows = df.select(*kept, cells.alias("_cells"))
    return rows.select(*kept, F.posexplode_outer("_cells").alias("_at", "_cell")).where("_at IS NOT NULL").select(
        *kept, "_cell.*")


def split_building_unit(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Building ads and unit ads; rows where the predicate is unknown are in neither."""
    return df.where(predicate), df.where(~predicate)


def split_range(text: Column) -> tuple[Column, Column]:
    """Numbers on both sides of the first hyphen; the right one NULL without a hyphen."""
    return parse_number(piece(text, "-", 1)), parse_number(piece(text, "-", 2))


def overlong(lo: Column, hi: Column) -> Column:
    """Whether a range has more steps than a row may be expanded into."""
    return F.abs(hi - lo) > MOST_STEPS


def range_cells(
    lo: Column, hi: Column, value_lo: Column, value_hi: Column, step: str, value: str,
    single_value: bool = False,
) -> Column:
    """Array of (step, value) from lo to hi with linearly interpolated values.

    NULL if a bound is missing. A one-step range has no slope: its value is NULL, or the
    lower value when `single_value` is set. A range of more than MOST_STEPS steps is no
    range of bedrooms but a misread text: it is one cell of NULLs (`overlong` tells them).
    """
    steps = F.floor(F.abs(hi - lo) + F.lit(1e-10)).try_cast("int")
    steps = F.when(overlong(lo, hi), F.lit(0)).otherwise(steps)
    first = F.when(lo <= hi, lo).otherwise(lo - steps)
    slope = F.try_divide(value_hi - value_lo, steps.cast("double"))

    def cell(at):
        filled = value_lo + slope * at
        if single_value:
            filled = F.when(steps == 0, value_lo).otherwise(filled)
        fits = ~overlong(lo, hi)
        return F.struct(F.when(fits, first + at).alias(step), F.when(fits, filled).alias(value))

    return F.transform(F.sequence(F.lit(0), steps), cell)


def expand_range(
    df: DataFrame, lo: str, hi: str, value_lo: str, value_hi: str, out_step: str, out_value: str,
    single_value: bool = False,
) -> DataFrame:
    """One row per step from lo to hi, in place; rows with a missing bound are dropped."""
    bounds = [F.col(c) for c in (lo, hi, value_lo, value_hi)]
    kept = [c for c in df.columns if c not in (out_step, out_value)]
    return inlined(df, kept, range_cells(*bounds, out_step, out_value, single_value))


def building_ranges(df: DataFrame, single_value: bool = False) -> DataFrame:
    """Text `beds` and `rent` to numbers: buildings by range, units as they are.

    One pass over the rows; where `is_bldg` is unknown the row is dropped.
    """
    sides = {}
    for name in ("rent", "beds"):
        for end, number in zip(("lower", "upper"), split_range(F.col(name))):
            sides[f"{name}_{end}"] = F.when(F.col("is_bldg"), number)
    split = df.withColumns(sides)
    ranges = range_cells(
        F.col("beds_lower"), F.col("beds_upper"), F.col("rent_lower"), F.col("rent_upper"),
        "beds", "rent", single_value)
    single = F.struct(parse_number(F.col("beds")).alias("beds"),
                      parse_number(F.col("rent")).alias("rent"))
    cells = F.when(F.col("is_bldg"), ranges).when(~F.col("is_bldg"), F.array(single))
    kept = [c for c in split.columns if c not in ("beds", "rent")]
    return inlined(split, kept, cells)


def unpivot_sizes(
    df: DataFrame, prices: Mapping[float, Column], step: str = "beds", value: str = "rent"
) -> DataFrame:
    """One row per size whose price is present; the prices are expressions over the row."""
    cells = F.array(*[
        F.struct(F.lit(float(n)).alias(step), price.alias(value)) for n, price in prices.items()
    ])
    kept = [c for c in df.columns if c not in (step, value)]
    present = F.filter(cells, lambda cell: cell[value].isNotNull())
    return inlined(df, kept, present)


def offers_in_text(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Array of (beds, rent text) out of a building's price list, the first offer per size.

    One look at the text finds all offers, whatever the number of sizes.
    """
    sizes = F.array(*[F.lit(s) for s in fixed.ZILLOW_SIZES])
    pattern = F.lit(fixed.ZILLOW_OFFER)

    def offer(size, i):
        return F.struct(
            (F.array_position(sizes, size) - 1).cast("double").alias("beds"),
            F.get("_rents", i).alias("rent"),
            (F.array_position("_sizes", size) == i + 1).alias("first"))

    found = df.withColumns({
        "_sizes": F.regexp_extract_all(text, pattern, F.lit(2)),
        "_rents": F.regexp_extract_all(text, pattern, F.lit(1)),
    })
    offers = F.filter(F.transform("_sizes", offer), lambda o: o["first"] & (o["beds"] >= 0))
    return found.withColumn(out, F.transform(
        offers, lambda o: F.struct(o["beds"], o["rent"]))).drop("_sizes", "_rents")


def size_cells(columns: Sequence[str] = fixed.PADMAPPER_SIZES) -> Column:
    """Array of (beds, inv, rent) out of one text column per size, for sizes with a count.

    Texts are elements of an array, so that each is cleaned once and not once per mention.
    """
    beds = F.array(*[parse_number(F.lit(c)) for c in columns])
    texts = F.transform(
        F.array(*[F.col(c) for c in columns]), lambda text: replace_all(text, fixed.PADMAPPER_INVENTORY_NOISE))

    def cell(text, i):
        return F.struct(
            F.get(beds, i).alias("beds"),
            parse_number(piece_or_empty(text, " RENT", 2, 1)).alias("inv"),
            replace_all(piece_or_empty(text, " RENT ", 2, 2), r"\$|,").alias("rent"),
        )

    return F.filter(F.transform(texts, cell), lambda x: x["inv"].isNotNull())


def inventory_by_size(df: DataFrame, columns: Sequence[str] = fixed.PADMAPPER_SIZES) -> DataFrame:
    """Count and rent text per bedroom size out of one text column per size.

    The columns are dropped, `beds`, `inv` and `rent` take their place; sizes without
    a count give no row. Both values come from one text, so no pivot is needed.
    """
    kept = [c for c in df.columns if c not in (*columns, "beds", "inv", "rent")]
    return inlined(df, kept, size_cells(columns))


def pivot_inventory(
    df: DataFrame, ids: Sequence[str], var: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Long to wide with the column names given, so no extra job looks them up.

    One aggregate and one shuffle, where `pivot` takes two. Equal cells collapse; of
    several values for one cell the smallest is kept, which combines before the shuffle.
    """
    cells = [F.min(F.when(F.col(var) == n, F.col(value))).alias(n) for n in names]
    return df.groupBy(*ids).agg(*cells)


def harmonize_union(parts: Sequence[DataFrame], schema: StructType | None = None) -> DataFrame:
    """Stack tables by column name, missing columns as NULL, cast to one schema if given."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is None:
        return stacked
    return stacked.select(*[
        (F.col(f.name) if f.name in stacked.columns else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schema
    ])


def name_and_address(text: Column) -> tuple[Column, Column]:
    """Building name and address around a bar."""
    return tuple(trim_space(piece_or_empty(text, r"\|", 2, k)) for k in (1, 2))
