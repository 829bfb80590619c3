"""Listing-shaped inputs derived from the given tables, whole tables at any scale.

Each line item becomes one ad per site; the ad's numbers are written into text the
way the sites write them, so that the plans have something to read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentloom import fixed_values as fixed
from rentloom.sources.files import first_rows
from rentloom.sources.tables import parquet_table

OTHER_METRO = "16980"
SHIFT_DAYS = 8000


def dealt(scan: DataFrame) -> DataFrame:
    """Rows dealt out to all tasks, as files landed in many parts would be, where the table has
    fewer splits than there are cores; the given tables are one split each."""
    if scan.rdd.getNumPartitions() >= scan.sparkSession.sparkContext.defaultParallelism:
        return scan
    return scan.repartition(int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def money(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def col(name: str) -> Column:
    return F.col(name)


# --- places -----------------------------------------------------------------

def _metro_code(region: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in fixed.METROS]), region + 1)


def raw_county(spark: SparkSession, folder: str) -> DataFrame:
    """One triangular county per nation on a 5 x 5 degree grid; the last five in another metro."""
    k = col("n_nationkey")
    west, south = F.lit(-125.0) + 10.0 * (k % 5), F.lit(25.0) + 5.0 * F.floor(k / 5)

    def corner(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(
        corner(west, south), corner(west + 9.0, south), corner(west, south + 4.5),
        corner(west, south))
    return parquet_table(spark, folder, "nation").select(
        text(col("n_name"), " County").alias("namelsad"),
        F.when(k < 20, _metro_code(col("n_regionkey"))).otherwise(OTHER_METRO).alias("cbsafp"),
        F.lpad((k * 2 + 6001).cast("string"), 5, "0").alias("geoid"),
        F.lpad(col("n_regionkey").cast("string"), 2, "0").alias("statefp"),
        F.array(ring).alias("geometry"),
    )


def raw_state(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "region").select(
        F.lpad(col("r_regionkey").cast("string"), 2, "0").alias("statefp"),
        F.substring("r_name", 1, 2).alias("stusps"))


def raw_cbsa(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "region").select(
        col("r_name").alias("name"), _metro_code(col("r_regionkey")).alias("cbsafp"))


def raw_acs(spark: SparkSession, folder: str) -> DataFrame:
    """Census file: the first five rows are the metros, one for places outside them follows."""
    region = parquet_table(spark, folder, "region")
    rows = region.select("r_name", "r_regionkey").union(
        region.agg(F.lit("Elsewhere"), (F.max("r_regionkey") + 1)))
    return first_rows(rows.orderBy("r_regionkey")).select(
        col("r_name").alias("msa"),
        *[(col("r_regionkey") * 100.0 + 10.0 * p).alias(f"pct_{p}") for p in fixed.PERCENTS])


# --- ads --------------------------------------------------------------------

def ads(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers behind every ad and what is spelled of them."""
    return spelled(numbers(spark, folder))


def numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers behind every ad: rent r, bedrooms b, q, d, t, and the nation it is in."""
    items = dealt(parquet_table(spark, folder, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        col("l_shipdate").cast("date").alias("ship"),
        F.floor(col("l_extendedprice") / 5).alias("r"),
        (col("l_linenumber") - 1).cast("long").alias("b"),
        col("l_quantity").cast("long").alias("q"),
        F.round(col("l_discount") * 100).cast("long").alias("d"),
        F.round(col("l_tax") * 100).cast("long").alias("t"),
    )
    seller = parquet_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nation = parquet_table(spark, folder, "nation")
    region = parquet_table(spark, folder, "region")
    return (
        items.join(seller, col("l_suppkey") == col("s_suppkey"))
        .join(nation, col("s_nationkey") == col("n_nationkey"))
        .join(region, col("n_regionkey") == col("r_regionkey"))
    )


def spelled(numbers: DataFrame) -> DataFrame:
    """What follows from the numbers of an ad alone, so that it need not be stored."""
    return numbers.withColumns({
        "k": col("n_nationkey"),
        "is_range": col("t") >= 5,
        "b2": col("b") + col("q") % 4,
        "r2": col("r") + col("q") * 100,
        "baths": F.when(col("q") % 2 == 0, F.lit("1.5")).otherwise(F.lit("2")),
        "area": col("q") * 30 + 400,
        "container": text(col("n_name"), " County ", F.substring("r_name", 1, 2)),
        "ad": text(col("l_orderkey"), "-", col("l_linenumber"), "-", col("r"), "-", col("q")),
    })


def geocoded(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    k = col("k")
    return (base or ads(spark, folder)).select(
        F.when(col("l_linestatus") == "F", F.lit(fixed.SOURCE_APARTMENTS))
        .otherwise("Elsewhere").alias("source"),
        F.date_add("ship", SHIFT_DAYS).alias("listing_date"),
        F.when(k < 20, _metro_code(col("n_regionkey"))).otherwise(OTHER_METRO).alias("cbsafp"),
        F.lpad((k * 2 + 6001).cast("string"), 5, "0").alias("countyfp"),
        col("b").cast("double").alias("beds"),
        col("baths").cast("double").alias("baths"),
        col("area").cast("double").alias("sqft"),
        col("r").cast("double").alias("rent_mid"),
        text(col("l_partkey"), " Main St").alias("geo_address"),
    )


def extra_markets(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    rows = base or ads(spark, folder)
    b, r, many = col("b"), col("r"), col("is_range")
    website = (
        F.when(col("l_returnflag") == "A", F.lit(fixed.SITE_FORRENT))
        .when(col("l_returnflag") == "N", F.lit(fixed.SITE_HOMES))
        .when(col("l_linestatus") == "F", F.lit(fixed.SITE_REALTOR))
        .otherwise(fixed.SITE_RENT))
    studio = F.when(b == 0, F.lit("Studio"))
    bedrooms = (
        F.when(
            col("website") == fixed.SITE_FORRENT,
            F.when(many, text(F.coalesce(studio, b.cast("string")), " - ", col("b2"), " Beds"))
            .otherwise(F.coalesce(studio, text(b, " Beds"))))
        .when(
            col("website") == fixed.SITE_HOMES,
            F.when(b == 0, F.lit("Studio 1 Bath")).otherwise(text(
                b, " Beds ", col("baths"), " Baths ", F.format_number(col("area"), 0), " Sqft")))
        .when(
            col("website") == fixed.SITE_REALTOR,
            F.when(many, text(b, " - ", b + 2)).otherwise(F.coalesce(studio, b.cast("string"))))
        .otherwise(
            F.when(many, text(b, "-", b + 2, " Beds"))
            .otherwise(F.coalesce(studio, text(b, " Beds")))))
    rent = (
        F.when(
            col("website") == fixed.SITE_FORRENT,
            F.when(many, text(money(r), " - ", money(col("r2")))).otherwise(money(r)))
        .when(
            col("website") == fixed.SITE_HOMES,
            F.when(col("d") == 10, F.lit(fixed.HOMES_NO_RENT))
            .when(many, text(money(r), "+")).otherwise(money(r)))
        .otherwise(text(money(r), "/mo")))
    place = F.when(col("d") == 0, F.lit(fixed.MISSING_ON_SITE)).otherwise(
        text(col("l_partkey"), " Main St\n", col("n_name")))
    return rows.withColumn("website", website).select(
        "website",
        text(col("ship"), F.when(col("q") % 3 == 0, F.lit("T20:04:05-07:00")).otherwise(
            " 03:04:05")).alias("scraped_time"),
        bedrooms.alias("bedrooms"),
        rent.alias("rent"),
        place.alias("location_identifier"),
        text(col("q"), " Units Available now").alias("availablity"),
    )


def craigslist(spark: SparkSession, folder: str) -> DataFrame:
    orders = dealt(parquet_table(spark, folder, "orders"))
    day = F.date_add(col("o_orderdate").cast("date"), SHIFT_DAYS)
    lat, lng = col("o_custkey") * 37 % 2400, col("o_custkey") * 91 % 4900

    def degrees(whole, hundredths, tail):
        return text(whole + F.floor(hundredths / 100), ".",
                    F.lpad((hundredths % 100).cast("string"), 2, "0"), tail)

    place = text(degrees(F.lit(25), lat, "3"), ",-",
                 degrees(F.lit(76), lng, "7"))
    missing = F.lit(None).cast("string")
    return orders.select(
        text(F.date_format(day, "MMM d"), ", 3:04:05 PM").alias("date"),
        F.lit("Home for rent").alias("title"),
        money(F.floor(col("o_totalprice") / 50)).alias("rent"),
        missing.alias("size_stats"), missing.alias("neighborhood"), missing.alias("address"),
        text("https://maps.example.org/maps/search/", place).alias("gmaps_url"),
        text(col("o_orderkey") % 7, "BR").alias("beds"),
        F.when(col("o_orderstatus") == "F", F.lit("1Ba")).when(
            col("o_orderstatus") == "O", F.lit("2Ba")).otherwise("1.5Ba").alias("baths"),
        text(col("o_custkey") % 900 + 400, "\nft\n2").alias("sqft"),
        missing.alias("hu_char"), F.lit("A home.\nCall us.").alias("text"),
        col("o_orderkey").cast("string").alias("post_id"),
        day.cast("string").alias("posted_date"), missing.alias("updated_date"),
        F.lit("all").alias("container"),
        text("https://posts.example.org/", col("o_orderkey")).alias("url"),
        F.lit("1").alias("program_iteration"),
    )


def gosection8(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    sizes = F.when(col("b") == 0, F.lit("Studio\nBed 1 Bath")).otherwise(
        text(col("b"), "\nBed ", col("baths"), " Bath\nHouse"))
    return (base or ads(spark, folder)).select(
        money(col("r")).alias("rent"), sizes.alias("beds_bath"), F.lit("A home.").alias("text"),
        text(col("l_partkey"), " Oak Ave, ", col("n_name")).alias("address"),
        F.lit("now").alias("availability"), "container",
        text("https://section.example.org/", col("ad")).alias("url"),
        F.lit("1").alias("program_iteration"),
    )


def trulia(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    many = col("is_range")
    return (base or ads(spark, folder)).select(
        F.lit("New").alias("tags"),
        F.when(many, text(money(col("r")), " - ", money(col("r2")), "/mo"))
        .otherwise(text(money(col("r")), "/mo")).alias("rent"),
        F.when(many, text(col("b"), "-", col("b2"), "bd"))
        .when(col("b") == 0, F.lit("Studio")).otherwise(text(col("b"), "bd")).alias("beds"),
        text(col("baths"), "ba").alias("baths"),
        text(F.format_number(col("area"), 0), " sqft").alias("sqft"),
        text(col("l_partkey"), " Main St #", col("q")).alias("line_1"),
        text(col("n_name"), ", ", F.substring("r_name", 1, 2)).alias("line_2"),
        F.when(col("l_linestatus") == "O", col("container")).alias("container"),
        text("https://homes.example.org/for_rent/", col("k") * 2 + 6001, "_c/", col("ad"))
        .alias("url"),
        F.lit("1").alias("program_iteration"),
    )


def zillow(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    def offer(i, label):
        return F.when(col("q") % 4 >= i, text(money(col("r") + 300 * i), f"\n{label}"))

    price_list = F.concat_ws("", *[
        offer(i, label) for i, label in enumerate(("Studio", "1 bd", "2 bd", "3 bd"))])
    size = F.when(col("b") == 0, F.lit("Studio")).otherwise(text(col("b"), " bds"))
    many = col("is_range")
    return (base or ads(spark, folder)).select(
        F.when(~many, text(money(col("r")), "/mo")).alias("rent"),
        F.when(many, price_list).otherwise(text(size, "\n1 ba\n", col("area"), "\nsqft"))
        .alias("bedrooms"),
        F.when(many, text("The P", col("l_partkey"), " | ", col("l_partkey"), " Pine St, ", col("n_name")))
        .otherwise(text(col("l_partkey"), " Oak St #3, ", col("n_name"))).alias("address"),
        F.lit("Apartment for rent").alias("unit_type"), "container",
        text("https://listings.example.org/", col("ad")).alias("url"),
        F.lit("1").alias("program_iteration"),
    )


def padmapper(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    """Some buildings also advertise their one-bedroom flat as a unit at the same address: equal
    beds, baths, rent and address, another number of units, and a later link."""
    shared = col("is_range") & (col("d") == 7)

    def offer(i):
        label = "Studios" if i == 0 else f"{i} Bedrooms"
        return F.when(col("is_range") & (col("q") % 5 >= i), text(
            f"{label} ", col("q") + i, " RENT ", money(col("r") + 300 * i), " View"))

    # spelled below the explode, as Java leaves a method that spells all of an ad uncompiled
    short = text("$", F.floor(col("r") / 1000), ".", F.floor(col("r") % 1000 / 100), "K")
    single = F.when(col("is_range"), text(money(col("r")), "+")).when(col("d") == 5, short).otherwise(money(col("r")))
    offers = {c: offer(i) for i, c in enumerate(fixed.PADMAPPER_SIZES)}
    rows = (base or ads(spark, folder)).withColumns({"single": single, **offers}).withColumn("twin", F.explode(
        F.when(shared, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    many = col("is_range") & ~col("twin")

    unit = text(col("l_partkey"), " Bell St #4")
    tower = text("The P", col("l_partkey"))
    street = F.when(shared, text(col("l_partkey"), " Bell St, ")).otherwise("")
    return rows.select(
        F.when(col("twin"), money(col("r") + 300)).otherwise(col("single")).alias("rent"),
        F.when(col("twin"), F.lit("1 Bedroom"))
        .when(col("b") == 0, F.lit("Studio 1 Bathroom"))
        .otherwise(text(col("b"), " Bedroom 1 Bathroom")).alias("bedrooms"),
        F.when(many, text(tower, " ", street, col("n_name"), " info"))
        .otherwise(text(unit, " ", col("n_name"))).alias("name_loc"),
        F.when(many, tower).otherwise(unit).alias("name"),
        *[F.when(~col("twin"), col(c)).alias(c) for c in fixed.PADMAPPER_SIZES],
        F.lit("A home.").alias("text"), "container",
        text("https://map.example.org/", col("ad"), F.when(col("twin"), F.lit("-z")).otherwise("")).alias("url"),
        F.lit("1").alias("program_iteration"),
    )


def address_book(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    """Every Padmapper address once with a point, inside or outside of its nation's county."""
    k = col("k")
    west, south = F.lit(-125.0) + 10.0 * (k % 5), F.lit(25.0) + 5.0 * F.floor(k / 5)
    p = col("l_partkey")
    homes = (base or ads(spark, folder)).select("l_partkey", "k", "n_name").distinct().select(
        text(p, " Bell St, ", col("n_name")).alias("address"),
        (west + (p * 7 % 997) / 100.0 + 0.003).alias("X"),
        (south + (p * 13 % 499) / 100.0 + 0.001).alias("Y"))
    centres = parquet_table(spark, folder, "nation").withColumn("k", col("n_nationkey")).select(
        col("n_name").alias("address"), (west + 3.0).alias("X"), (south + 1.5).alias("Y"))
    return homes.union(centres)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Located rows with whole weights, as all sites together would give them."""
    rows = parquet_table(spark, folder, "lineitem").join(
        parquet_table(spark, folder, "supplier"), col("l_suppkey") == col("s_suppkey")
    ).join(parquet_table(spark, folder, "nation"), col("s_nationkey") == col("n_nationkey"))
    return rows.select(
        _metro_code(col("n_regionkey")).alias("cbsafp"),
        F.lpad((col("n_nationkey") * 2 + 6001).cast("string"), 5, "0").alias("fips"),
        text(col("n_name"), " County").alias("namelsad"),
        (col("l_linenumber") - 1).cast("double").alias("beds"),
        col("l_extendedprice").alias("rent"),
        col("l_quantity").cast("long").alias("inv"),
        col("l_returnflag").alias("source"),
    )


def city_of(name: Column) -> Column:
    """A name of letters alone out of a nation's name."""
    return F.translate(name, "_0123456789", " ABCDEFGHIJ")


def street_of(c: Column) -> Column:
    """Short and very long street names, some with a direction behind them."""
    return text(c + 1, F.when(c % 5 == 0, F.lit(" Martin Luther King Junior Memorial Way S")).when(
        c % 5 == 1, F.lit(" 9th Ave NE")).otherwise(" Main St"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Prose with an address and a nine-digit ZIP somewhere in it, in part twice. Some texts name no
    address, so that just the fields tell it; some fields name no city."""
    customer = parquet_table(spark, folder, "customer").join(
        parquet_table(spark, folder, "nation"), col("c_nationkey") == col("n_nationkey"))
    c = col("c_custkey")
    street = street_of(c)
    zip9 = text(c % 89999 + 10000, "-1234")
    # The city stands behind a colon, in a sentence, or after one.
    opening = F.when(c % 3 == 0, F.lit("Mail: ")).when(c % 3 == 1, F.lit("Sunny home in ")).otherwise(
        "Located near Green Lake. ")
    body = F.when(col("c_mktsegment") == "BUILDING", F.lit("Call us for the address.")).otherwise(
        text("Cosy rooms. Visit ", street, " today.\n", opening, city_of(col("n_name")), ", WA ", zip9, " thanks"))
    rows = customer.select(
        street.alias("address1"), F.lit(None).cast("string").alias("neigh1"),
        F.when(c % 7 != 3, city_of(col("n_name"))).alias("city1"), F.lit("WA").alias("region1"),
        text("https://maps.example.org/maps/search/", c % 50, ".5,-120.25").alias("google_maps_url"),
        body.alias("listing_text"))
    return rows.union(rows.where(col("google_maps_url").contains("/7.5")))


def parsed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer's address with a point; some streets once more under another ZIP, at the
    place of the map link."""
    customer = parquet_table(spark, folder, "customer").join(
        parquet_table(spark, folder, "nation"), col("c_nationkey") == col("n_nationkey"))
    c = col("c_custkey")

    def row(zip_, lng, lat):
        return F.struct(
            text(street_of(c), " ", city_of(col("n_name")), ", WA ", zip_).alias("temp_add"), lng.alias("lng"), lat.alias("lat"))

    first = row(c % 89999 + 10000, c * 0.5, c * 0.25)
    twin = row(c % 89999 + 10001, F.lit(-120.25), (c % 50) + 0.5)
    return customer.select(F.inline(F.when(c % 4 == 0, F.array(first, twin)).otherwise(F.array(first))))
