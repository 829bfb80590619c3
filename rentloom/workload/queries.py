"""One registered query per operator, site and output table: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentloom import fixed_values as fixed
from rentloom.functions import text as tx
from rentloom.functions.geo import albers_5070, url_coordinates, url_county
from rentloom.operators import dedupe, enrich, joins, reshape, spatial, stats
from rentloom.plans import (
    apartments, craigslist, extra_markets, gosection8, padmapper, stacked, tables, trulia, zillow,
)
from rentloom.plans.county import county_table, flat
from rentloom.session import shared_folder
from rentloom.sources import files, schemas
from rentloom.sources.tables import apartments_scan, distinct_of, parquet_table, site_scan
from rentloom.workload import inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
#: Cells of the county table that serves several sites.
CELL_METRES = 20_000.0


def query(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


def _county(spark, folder) -> DataFrame:
    return county_table(
        inputs.raw_county(spark, folder), inputs.raw_state(spark, folder),
        inputs.raw_cbsa(spark, folder))


def _stored_county(spark, folder) -> DataFrame:
    """Written once where several sites are located with it."""
    return files.land(_county(spark, folder), shared_folder(spark))


def _outlines(spark, folder) -> DataFrame:
    """All counties with outlines in degrees, in or out of the metros."""
    return inputs.raw_county(spark, folder).select("namelsad", "geometry")


# --- sources and sinks ------------------------------------------------------

@query
def scan_filter(spark, folder):
    return apartments_scan(inputs.geocoded(spark, folder))


@query
def scan_by_site(spark, folder):
    rows = site_scan(inputs.extra_markets(spark, folder), fixed.SITE_HOMES)
    return rows.select("website", "rent", "bedrooms")


@query
def csv_roundtrip(spark, folder):
    path = shared_folder(spark)
    raw = inputs.zillow(spark, folder)
    files.write_csv(raw, path, header=False)
    return files.read_headerless(spark, path, schemas.ZILLOW)


@query
def csv_schema_drift(spark, folder):
    """Records with nine and with ten fields mixed in one file."""
    path = shared_folder(spark)
    raw = inputs.trulia(spark, folder)

    def line(names):
        quoted = [F.concat(F.lit('"'), F.coalesce(F.col(n), F.lit("")), F.lit('"')) for n in names]
        return F.concat_ws(",", *quoted)

    early = [n for n in schemas.TRULIA if n != "container"]
    lines = F.when(F.col("container").isNull(), line(early)).otherwise(line(schemas.TRULIA))
    raw.select(lines.alias("value")).write.text(path)
    return files.read_trulia(spark, path, schemas.TRULIA)


# --- joins ------------------------------------------------------------------

@query
def county_dim(spark, folder):
    return _county(spark, folder).drop("geometry")


@query
def semi_county(spark, folder):
    rows = inputs.gosection8(spark, folder).select("container", "url", "rent")
    return joins.semi(rows, flat(_county(spark, folder)), "container")


@query
def natural_left_join(spark, folder):
    rows = inputs.gosection8(spark, folder).select("url", "container", "rent")
    return joins.natural_left(rows, flat(_county(spark, folder)))


@query
def null_safe_join(spark, folder):
    customer = parquet_table(spark, folder, "customer")
    keyed = customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    names = keyed.select("segment").distinct().withColumn(
        "label", F.coalesce(F.lower("segment"), F.lit("none given")))
    return joins.null_safe_left(keyed, names, ["segment"])


@query
def distinct_dim(spark, folder):
    return distinct_of(_county(spark, folder), "cbsafp", "metro_name")


# --- cleaning ---------------------------------------------------------------

@query
def clean_listing_fields(spark, folder):
    cleaned = extra_markets.clean_fields(inputs.extra_markets(spark, folder))
    return cleaned.select(
        "website", "raw_rent", "raw_bedrooms", "is_bldg", "rent", "beds", "baths", "sqft")


@query
def parse_failures(spark, folder):
    cleaned = extra_markets.clean_fields(inputs.extra_markets(spark, folder))
    return extra_markets.parse_failures(cleaned)


@query
def sentinel_to_null(spark, folder):
    rows = inputs.extra_markets(spark, folder)
    return reshape.sentinel_to_null(rows, trim=True).select(
        "website", "scraped_time", "rent", "location_identifier")


@query
def range_split(spark, folder):
    rows = site_scan(inputs.extra_markets(spark, folder), fixed.SITE_FORRENT)
    sizes = reshape.split_range(tx.studio_as_zero(F.col("bedrooms")))
    rents = reshape.split_range(F.col("rent"))
    return rows.select(
        "bedrooms", "rent", sizes[0].alias("beds_lower"), sizes[1].alias("beds_upper"),
        rents[0].alias("rent_lower"), rents[1].alias("rent_upper"))


@query
def listing_dates(spark, folder):
    return craigslist.listing_dates(inputs.craigslist(spark, folder)).select(
        "post_id", "date", "month", "year", "time")


@query
def listings_per_month(spark, folder):
    return craigslist.rows_per_month(
        craigslist.listing_dates(inputs.craigslist(spark, folder)))


@query
def scrape_times(spark, folder):
    rows = extra_markets.dated(inputs.extra_markets(spark, folder))
    return rows.groupBy("website", "scraped_time", "date").agg(F.count(F.lit(1)).alias("n"))


@query
def normalize_addresses(spark, folder):
    """Match-ready address key, ZIP and unit-free address of every ad and post."""
    ads = inputs.zillow(spark, folder).select(
        "url", tx.drop_unit(F.col("address")).alias("address"),
        F.lit(None).cast("string").alias("zip5"))
    posts = inputs.texts(spark, folder).select(
        F.col("address1").alias("url"),
        tx.with_short_zip(F.col("listing_text")).alias("address"),
        tx.zip5(F.col("listing_text")).alias("zip5"))
    units = inputs.trulia(spark, folder).select(
        "url",
        tx.joined(", ", tx.piece_or_empty(F.col("line_1"), " #", 2, 1), F.col("line_2"))
        .alias("address"),
        F.lit(None).cast("string").alias("zip5"))
    return ads.union(posts).union(units)


@query
def locate_by_url(spark, folder):
    """County by the code in a link, and coordinates by a map link."""
    by_code = inputs.trulia(spark, folder).select(
        "url", url_county(F.col("url")).alias("fips"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"))
    lat, lng = url_coordinates(F.col("gmaps_url"))
    by_map = inputs.craigslist(spark, folder).select(
        "url", F.lit(None).cast("string").alias("fips"), lat.alias("lat"), lng.alias("lng"))
    county = flat(_county(spark, folder)).select("fips", "namelsad")
    return joins.natural_left(by_code.union(by_map), county)


# --- relational core --------------------------------------------------------

@query
def dedupe_keep_first(spark, folder):
    rows = parquet_table(spark, folder, "orders")
    return dedupe.keep_first(rows, ["o_custkey", "o_orderpriority"], ["o_totalprice", "o_orderkey"])


@query
def dedupe_latest(spark, folder):
    rows = parquet_table(spark, folder, "orders")
    return dedupe.keep_latest(
        rows, ["o_custkey", "o_orderpriority"], "o_orderdate", ["o_orderkey"])


@query
def building_unit_split(spark, folder):
    rows = site_scan(inputs.extra_markets(spark, folder), fixed.SITE_FORRENT)
    buildings, units = reshape.split_building_unit(rows, F.col("bedrooms").contains("-"))
    return reshape.harmonize_union([
        buildings.select(F.lit("building").alias("kind"), "bedrooms", "rent"),
        units.select(F.lit("unit").alias("kind"), "bedrooms",
                     tx.parse_number(F.col("rent")).alias("unit_rent")),
    ])


@query
def building_share(spark, folder):
    return extra_markets.building_share(inputs.extra_markets(spark, folder))


@query
def harmonize_union(spark, folder):
    a = parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("rent"))
    b = parquet_table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("beds"), F.col("s_suppkey").alias("id"))
    return reshape.harmonize_union([a, b])


@query
def rent_bounds(spark, folder):
    return tables.usable(inputs.listings(spark, folder))


@query
def bed_class(spark, folder):
    rows = inputs.listings(spark, folder)
    halves = rows.withColumn("beds", F.col("beds") - F.when(F.col("inv") > 40, 0.5).otherwise(0.0))
    out = halves.withColumn("cat_beds", tx.bedroom_class(F.col("beds")))
    return out.groupBy("beds", "cat_beds").agg(F.count(F.lit(1)).alias("n"))


# --- reshape ----------------------------------------------------------------

@query
def bed_range_expand(spark, folder):
    rows = inputs.ads(spark, folder).where("is_range").select(
        "ad", *[F.col(c).cast("double").alias(c) for c in ("b", "b2", "r", "r2")])
    return reshape.expand_range(rows, "b", "b2", "r", "r2", "beds", "rent").select(
        "ad", "beds", "rent")


@query
def unpivot_rent(spark, folder):
    """Five columns of rent by size, most of them empty, to one row per rent."""
    rows = inputs.ads(spark, folder).where("is_range")
    wide = {
        n: F.when(F.col("q") % 5 >= n, (F.col("r") + 300 * n).cast("double")) for n in range(5)}
    return reshape.unpivot_sizes(rows.select("ad", "q", "r"), wide).select("ad", "beds", "rent")


@query
def offers_by_size(spark, folder):
    rows = inputs.zillow(spark, folder).where(F.col("rent").isNull())
    return zillow.by_size(rows).select("url", "beds", "rent")


@query
def inventory_by_size(spark, folder):
    rows = inputs.padmapper(spark, folder).where(F.col("rent").contains("+"))
    out = reshape.inventory_by_size(rows.select("url", *fixed.PADMAPPER_SIZES))
    return out.select("url", "beds", "inv", "rent")


@query
def pivot_inventory(spark, folder):
    """Long (var, value) cells of inventory and rent back to one row per ad and size."""
    rows = inputs.padmapper(spark, folder).where(F.col("rent").contains("+"))
    sizes = reshape.inventory_by_size(rows.select("url", *fixed.PADMAPPER_SIZES))
    long = sizes.select("url", "beds", F.col("inv").cast("string").alias("inv"), "rent").unpivot(
        ["url", "beds"], ["inv", "rent"], "var", "value")
    return reshape.pivot_inventory(long, ["url", "beds"], "var", "value", ["inv", "rent"])


# --- quantiles --------------------------------------------------------------

@query
def weighted_quantiles(spark, folder):
    rows = inputs.listings(spark, folder)
    return stats.weighted_quantiles(rows, ["cbsafp", "source", "beds"], "rent", "inv")


# --- spatial ----------------------------------------------------------------

@query
def albers_project(spark, folder):
    lat, lng = url_coordinates(F.col("gmaps_url"))
    x, y = albers_5070(lng, lat)
    return inputs.craigslist(spark, folder).select(
        "post_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query
def point_in_polygon(spark, folder):
    lat, lng = url_coordinates(F.col("gmaps_url"))
    points = inputs.craigslist(spark, folder).select("post_id", lng.alias("x"), lat.alias("y"))
    return spatial.point_in_polygon(points, _outlines(spark, folder), cell_size=0.5).select(
        "post_id", "namelsad")


# --- look-ups ---------------------------------------------------------------

@query
def geocode_enrich(spark, folder):
    rows = inputs.ads(spark, folder).select(
        "ad", F.when(F.col("d") > 0, inputs.text(
            F.col("l_partkey"), " bell st, ", F.col("n_name"))).alias("address"))
    return enrich.enrich_distinct(
        rows, ["address"], inputs.address_book(spark, folder),
        normalize=lambda c: F.upper(tx.one_line(c)))


@query
def provider_enrich(spark, folder):
    """Addresses through an outside look-up, here a small rule that knows no address of one nation.
    The second call finds all but a few addresses in the table of the first."""
    def gazetteer(keys):
        number = keys["address"].str.extract(r"^([0-9]+)", expand=False).astype("float64")
        known = number.notna() & ~keys["address"].str.endswith(", NATION_7", na=False)
        return keys[known].assign(X=number[known] / 100 - 120, Y=number[known] % 50)

    rows = inputs.ads(spark, folder).select(
        "ad", "d", F.when(F.col("d") > 0, inputs.text(F.col("l_partkey"), " bell st, ", F.col("n_name"))).alias("address"))
    store = shared_folder(spark)

    def located(part):
        return enrich.enrich_distinct(
            part, ["address"], provider=gazetteer, schema="address string, X double, Y double", store=store,
            normalize=lambda c: F.upper(tx.one_line(c)))

    first = located(rows.where("d < 9"))
    return first.union(located(rows.where("d >= 9"))).drop("d")


@query
def reverse_geocode(spark, folder):
    customers = parquet_table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("x"),
        (F.col("c_custkey") % 2503 * 4.0).alias("y"))
    places = parquet_table(spark, folder, "supplier").select(
        F.col("s_name").alias("address"), F.col("s_acctbal").alias("x"),
        (F.col("s_suppkey") % 101 * 97.0).alias("y"))
    return enrich.enrich_nearest(customers, "x", "y", places, max_distance=900.0).select(
        "c_custkey", "rev_address", F.round("rev_distance", 6).alias("rev_distance"))


@query
def geoparse(spark, folder):
    return enrich.geoparse(
        inputs.texts(spark, folder), "listing_text", schemas.GEOPARSE_FIELDS,
        inputs.parsed_lookup(spark, folder))


# --- sites ------------------------------------------------------------------

@query
def site_apartments(spark, folder):
    return apartments.build(inputs.geocoded(spark, folder), flat(_county(spark, folder))).select(
        "cbsafp", "fips", "namelsad", "beds", "baths", "sqft", "rent_mid", "geo_address")


@query
def site_forrent(spark, folder):
    return extra_markets.forrent(inputs.extra_markets(spark, folder)).select(
        "address", "is_bldg", "beds", "rent", "beds_lower", "beds_upper", "rent_lower",
        "rent_upper")


@query
def site_homes(spark, folder):
    return extra_markets.homes(inputs.extra_markets(spark, folder)).select(
        "address", "beds", "baths", "sqft", "rent")


@query
def site_realtor(spark, folder):
    return extra_markets.realtor(inputs.extra_markets(spark, folder)).select(
        "address", "beds", "rent")


@query
def site_rent(spark, folder):
    return extra_markets.rent(inputs.extra_markets(spark, folder)).select(
        "address", "beds", "rent")


def _craigslist(spark, folder, county):
    return craigslist.build(inputs.craigslist(spark, folder), county)


@query
def site_craigslist(spark, folder):
    return _craigslist(spark, folder, _county(spark, folder)).select(
        "post_id", "date", "beds", "baths", "sqft", "rent", "lat", "lng", "cbsafp", "fips",
        "namelsad", "metro_name")


@query
def site_gosection8(spark, folder):
    return gosection8.build(inputs.gosection8(spark, folder), flat(_county(spark, folder))).select(
        "address", "beds", "baths", "rent", "unit_type", "cbsafp", "fips", "namelsad")


@query
def site_trulia(spark, folder):
    return trulia.build(inputs.trulia(spark, folder), flat(_county(spark, folder))).select(
        "address", "is_bldg", "beds", "baths", "sqft", "rent", "cbsafp", "fips", "namelsad")


@query
def site_zillow(spark, folder):
    return zillow.build(inputs.zillow(spark, folder), flat(_county(spark, folder))).select(
        "address", "bldg_name", "is_bldg", "beds", "sqft", "rent", "cbsafp", "fips", "namelsad")


@query
def site_padmapper(spark, folder):
    located = padmapper.build(
        inputs.padmapper(spark, folder), _county(spark, folder),
        inputs.address_book(spark, folder))
    return located.select("address", "beds", "baths", "rent", "inv", "cbsafp", "fips", "namelsad")


# --- output tables ----------------------------------------------------------

@query
def acs_append(spark, folder):
    return tables.acs_rows(inputs.raw_acs(spark, folder), _county(spark, folder))


def all_listings(spark, folder, county):
    """The numbers of the ads are landed once; the county table, its cells and its size check serve all sites,
    which are deduplicated together."""
    dim = joins.broadcast_if_small(joins.unique_keys(county.drop("geometry"), ["container"]))
    cells = spatial.cell_index(county.drop("container"), CELL_METRES)
    numbers = inputs.numbers(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "ship", "r", "b", "q", "d", "t", "n_nationkey", "n_name",
        "n_regionkey", "r_name")
    base = inputs.spelled(files.land(numbers, shared_folder(spark)))
    located = stacked.located(
        {
            "craigslist": inputs.craigslist(spark, folder), "apartments": inputs.geocoded(spark, folder, base),
            "gosection8": inputs.gosection8(spark, folder, base), "trulia": inputs.trulia(spark, folder, base),
            "zillow": inputs.zillow(spark, folder, base), "padmapper": inputs.padmapper(spark, folder, base),
        },
        dim, cells, inputs.address_book(spark, folder, base), shared_folder(spark), CELL_METRES)
    return tables.classified(located, dim)


@query
def listing_table(spark, folder):
    return all_listings(spark, folder, _stored_county(spark, folder))


@query
def rent_summary(spark, folder):
    """From the raw text of all sites to the final summary, by way of the stored listings."""
    county = _stored_county(spark, folder)
    acs = tables.acs_rows(inputs.raw_acs(spark, folder), county)
    listings = files.land(all_listings(spark, folder, county), shared_folder(spark))
    return tables.rent_summary(listings, acs)
