"""The four sites kept in one table: Forrent.com, Homes.com, Realtor.com, Rent.com.

`clean_fields` types all four in one scan; each site's plan filters first, so that
only its rows are read, and then applies the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentloom import fixed_values as fixed
from rentloom.functions.dates import scraped_at
from rentloom.functions.text import (
    extract, number_in, parse_number, replace_all, replace_first_text, studio_as_zero,
)
from rentloom.operators.dedupe import keep_first
from rentloom.operators.reshape import building_ranges, overlong, sentinel_to_null, split_range
from rentloom.operators.stats import share_of_total
from rentloom.plans import quirks
from rentloom.sources.tables import site_scan

DEDUPE_KEYS = ("beds", "baths", "sqft", "rent", "address")
ORDER = ("scraped_time", "bedrooms", "availablity")


def _missing(kind: str = "double") -> Column:
    return F.lit(None).cast(kind)


def _homes(fixes) -> dict[str, Column]:
    text = F.col("bedrooms")
    beds = number_in(studio_as_zero(text), fixed.HOMES_BEDS)
    if quirks.STUDIO_BEDS in fixes:
        beds = F.coalesce(beds, F.when(text.contains("Studio"), F.lit(0.0)))
    area = replace_all(text, ",") if quirks.FIRST_COMMA in fixes else replace_first_text(text, ",")
    return {
        "is_bldg": F.col("rent").contains("+"),
        "rent": parse_number(F.col("rent")),
        "beds": beds,
        "baths": number_in(text, fixed.HOMES_BATHS),
        "sqft": number_in(area, fixed.HOMES_SQFT),
    }


def _realtor(fixes) -> dict[str, Column]:
    return {
        "is_bldg": F.col("bedrooms").contains("-"),
        "rent": parse_number(F.col("rent")),
        "beds": parse_number(studio_as_zero(F.col("bedrooms"))),
        "baths": _missing(),
        "sqft": _missing(),
    }


def _rent(fixes) -> dict[str, Column]:
    text = studio_as_zero(F.col("bedrooms"))
    if quirks.SHORT_BEDS in fixes:
        beds = parse_number(text)
    else:
        beds = number_in(text, fixed.RENT_BEDS)
    return {**_realtor(fixes), "beds": beds}


def _forrent(fixes) -> dict[str, Column]:
    """Numbers of a unit ad; a building's range is read later."""
    unit = ~F.col("bedrooms").contains("-")
    return {
        "is_bldg": F.col("bedrooms").contains("-"),
        "rent": F.when(unit, parse_number(F.col("rent"))),
        "beds": F.when(unit, parse_number(studio_as_zero(F.col("bedrooms")))),
        "baths": _missing(),
        "sqft": _missing(),
    }


RULES = {
    fixed.SITE_FORRENT: _forrent,
    fixed.SITE_HOMES: _homes,
    fixed.SITE_REALTOR: _realtor,
    fixed.SITE_RENT: _rent,
}


def dated(df: DataFrame) -> DataFrame:
    """Scrape time as a timestamp, and its day."""
    stamp = scraped_at(F.col("scraped_time"))
    return df.withColumns({"scraped_time": stamp, "date": stamp.cast("date")})


def clean_fields(extra_markets: DataFrame, fixes=frozenset()) -> DataFrame:
    """Rows of all four sites with typed rent, beds, baths, sqft and building flag, in one scan."""
    fixes = quirks.checked(fixes)
    rules = {site: rule(fixes) for site, rule in RULES.items()}

    def by_site(name: str) -> Column:
        out = F.when(F.lit(False), next(iter(rules.values()))[name])
        for site, rule in rules.items():
            out = out.when(F.col("website") == site, rule[name])
        return out

    fields = ("is_bldg", "rent", "beds", "baths", "sqft")
    typed = {**{f"raw_{c}": F.col(c) for c in ("rent", "bedrooms")}, **{f: by_site(f) for f in fields}}
    known = extra_markets.where(F.col("website").isin(*RULES))
    return known.withColumns(typed)


def parse_failures(cleaned: DataFrame) -> DataFrame:
    """Per site, how many texts gave no number, and how many ranges were too long to expand."""
    def lost(raw: str, value: str) -> Column:
        return F.count(F.when(F.col(raw).isNotNull() & F.col(value).isNull(), 1))

    return cleaned.groupBy("website").agg(
        F.count(F.lit(1)).alias("n_rows"),
        lost("raw_rent", "rent").alias("no_rent"),
        lost("raw_bedrooms", "beds").alias("no_beds"),
        F.count(F.when(overlong(*split_range(studio_as_zero(F.col("raw_bedrooms")))), 1)).alias("overlong"),
    )


def _typed_site(extra_markets: DataFrame, site: str, fixes, order) -> DataFrame:
    """Scan, type, blank sentinels, and keep one ad per address and size."""
    rows = dated(site_scan(extra_markets, site)).withColumns(RULES[site](fixes))
    rows = sentinel_to_null(rows).withColumnRenamed("location_identifier", "address")
    return keep_first(rows, DEDUPE_KEYS, [*order, "is_bldg"])


def homes(extra_markets: DataFrame, fixes=frozenset(), order=ORDER) -> DataFrame:
    priced = extra_markets.where(F.col("rent") != fixed.HOMES_NO_RENT)
    return _typed_site(priced, fixed.SITE_HOMES, quirks.checked(fixes), order)


def realtor(extra_markets: DataFrame, fixes=frozenset(), order=ORDER) -> DataFrame:
    rows = _typed_site(extra_markets, fixed.SITE_REALTOR, quirks.checked(fixes), order)
    return rows.withColumn("address", replace_first_text(F.col("address"), "\n", " "))


def rent(extra_markets: DataFrame, fixes=frozenset(), order=ORDER) -> DataFrame:
    units = extract(F.col("availablity"), fixed.RENT_UNITS)
    rows = extra_markets.withColumn("availablity", units)
    rows = _typed_site(rows, fixed.SITE_RENT, quirks.checked(fixes), order)
    return rows.withColumn("address", replace_first_text(F.col("address"), "\n", " "))


def forrent_ads(extra_markets: DataFrame, order=ORDER) -> DataFrame:
    """One ad per address and size; beds and rent are still text, as they may be ranges."""
    rows = dated(site_scan(extra_markets, fixed.SITE_FORRENT)).withColumns({
        "is_bldg": F.col("bedrooms").contains("-"),
        "beds": studio_as_zero(F.col("bedrooms")),
        "baths": _missing(),
        "sqft": _missing(),
    })
    rows = sentinel_to_null(rows).withColumnRenamed("location_identifier", "address")
    return keep_first(rows, DEDUPE_KEYS, order)


def forrent(extra_markets: DataFrame, fixes=frozenset(), order=ORDER) -> DataFrame:
    """Unit ads as they are; building ads as one row per bedroom count with interpolated rent."""
    fixes = quirks.checked(fixes)
    return building_ranges(
        forrent_ads(extra_markets, order), single_value=quirks.SINGLE_SIZE in fixes)


def distinct_ads(extra_markets: DataFrame, fixes=frozenset()) -> DataFrame:
    """website and is_bldg of one ad per address and size of all four sites, in one scan and one
    shuffle: every column is typed by its row's site. Sizes and rents of Forrent.com are texts, as
    they may be ranges, and so are keys of their own."""
    forrent = F.col("website") == fixed.SITE_FORRENT
    priced = (F.col("website") != fixed.SITE_HOMES) | (F.col("rent") != fixed.HOMES_NO_RENT)
    units = F.when(F.col("website") == fixed.SITE_RENT, extract(F.col("availablity"), fixed.RENT_UNITS)).otherwise(
        F.col("availablity"))
    typed = clean_fields(dated(extra_markets.where(priced)), fixes).withColumns({
        **{c: F.when(~forrent, F.col(c)) for c in ("beds", "rent")},
        "text_beds": F.when(forrent, studio_as_zero(F.col("raw_bedrooms"))),
        "text_rent": F.when(forrent, F.col("raw_rent")),
        "availablity": units,
    })
    rows = sentinel_to_null(typed).withColumnRenamed("location_identifier", "address")
    keys = ["website", *DEDUPE_KEYS, "text_beds", "text_rent"]
    return keep_first(rows, keys, [*ORDER, "is_bldg"]).select("website", "is_bldg")


def building_share(extra_markets: DataFrame) -> DataFrame:
    """Ads and their part of a site's ads by building flag, per site, after its dedupe."""
    return share_of_total(distinct_ads(extra_markets), ["website", "is_bldg"], within=["website"])
