"""Literal rows per site, with results worked out by hand; each oddity kept and put right."""

import datetime

import pytest

from rentloom import fixed_values as fixed
from rentloom.plans import (
    apartments, craigslist, extra_markets, gosection8, padmapper, quirks, tables, trulia, zillow,
)
from rentloom.plans.county import county_table, flat
from rentloom.sources import schemas

MARKET = ("website", "scraped_time", "bedrooms", "rent", "location_identifier", "availablity")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def market(rows, site, *ads):
    base = {"website": site, "scraped_time": "2020-10-05 10:00:00"}
    return rows(MARKET, *[{**base, **ad} for ad in ads])


def test_forrent_building(rows):
    raw = market(rows, "forrent.com",
                 {"bedrooms": "Studio - 2 Beds", "rent": "$1,000 - $1,400", "location_identifier": "a"})
    assert got(extra_markets.forrent(raw), "beds", "rent") == [(0.0, 1000.0), (1.0, 1200.0), (2.0, 1400.0)]


def test_forrent_single_size(rows):
    raw = market(rows, "forrent.com", {"bedrooms": "1 - 1 Beds", "rent": "$900 - $950"})
    assert got(extra_markets.forrent(raw), "beds", "rent") == [(1.0, None)]
    fixed_up = extra_markets.forrent(raw, fixes={quirks.SINGLE_SIZE})
    assert got(fixed_up, "beds", "rent") == [(1.0, 900.0)]


def test_forrent_unit_sentinel_and_unknown(rows):
    raw = market(
        rows, "forrent.com",
        {"bedrooms": "Studio", "rent": "$1,250", "location_identifier": fixed.MISSING_ON_SITE},
        {"bedrooms": None, "rent": "$1"})
    out = extra_markets.forrent(raw)
    assert got(out, "is_bldg", "beds", "rent", "address") == [(False, 0.0, 1250.0, None)]


def test_forrent_descending_range(rows):
    raw = market(rows, "forrent.com", {"bedrooms": "3 - 1 Beds", "rent": "$900 - $1,100"})
    assert got(extra_markets.forrent(raw), "beds", "rent") == [(1.0, 900.0), (2.0, 1000.0), (3.0, 1100.0)]


def test_homes(rows):
    raw = market(rows, "homes.com",
                 {"rent": "$1,500+", "bedrooms": "2 Beds 1.5 Baths 1,050 Sqft"},
                 {"rent": "$--", "bedrooms": "2 Beds"}, {"rent": None, "bedrooms": "9 Beds"},
                 {"rent": "$700", "bedrooms": "Studio 1 Bath"})
    columns = ("is_bldg", "rent", "beds", "baths", "sqft")
    assert got(extra_markets.homes(raw), *columns) == [
        (False, 700.0, None, 1.0, None), (True, 1500.0, 2.0, 1.5, 1050.0)]
    fixed_up = extra_markets.homes(raw, fixes={quirks.STUDIO_BEDS})
    assert got(fixed_up, *columns)[0] == (False, 700.0, 0.0, 1.0, None)


def test_homes_first_comma(rows):
    raw = market(rows, "homes.com", {"rent": "$1", "bedrooms": "2 Beds, 1 Bath, 1,050 Sqft"})
    assert got(extra_markets.homes(raw), "sqft") == [(50.0,)]
    assert got(extra_markets.homes(raw, fixes={quirks.FIRST_COMMA}), "sqft") == [(1050.0,)]


def test_realtor(rows):
    raw = market(rows, "realtor.com",
                 {"rent": "$1,500/mo", "bedrooms": "1 - 3", "location_identifier": "1 A St\nSeattle"},
                 {"rent": "$900/mo", "bedrooms": "Studio", "location_identifier": "b"})
    assert got(extra_markets.realtor(raw), "address", "is_bldg", "beds", "rent") == [
        ("1 A St Seattle", True, 1.0, 1500.0), ("b", False, 0.0, 900.0)]


def test_rent_needs_three_characters(rows):
    raw = market(rows, "rent.com",
                 {"rent": "$1", "bedrooms": "1-3 Beds", "availablity": "12 Units Available now"},
                 {"rent": "$2", "bedrooms": "2 Beds"})
    assert got(extra_markets.rent(raw), "rent", "beds", "availablity") == [
        (1.0, 1.0, "12 Units Available"), (2.0, None, None)]
    assert got(extra_markets.rent(raw, fixes={quirks.SHORT_BEDS}), "rent", "beds") == [(1.0, 1.0), (2.0, 2.0)]


def test_shared_table_in_one_scan(rows):
    raw = market(rows, "homes.com", {"rent": "$1,500+", "bedrooms": "2 Beds"}).union(
        market(rows, "rent.com", {"rent": "x", "bedrooms": "1-3 Beds"})).union(
        market(rows, "other.com", {"rent": "$5", "bedrooms": "1"}))
    cleaned = extra_markets.clean_fields(raw)
    assert got(cleaned, "website", "rent", "beds", "is_bldg") == [
        ("homes.com", 1500.0, 2.0, True), ("rent.com", None, 1.0, True)]
    assert got(extra_markets.parse_failures(cleaned), "website", "n_rows", "no_rent", "no_beds") == [
        ("homes.com", 1, 0, 0), ("rent.com", 1, 1, 0)]


def test_apartments(spark, county):
    rows = [
        ("Apartments.com", datetime.date(2020, 10, 2), "42660", "53033", 1.0, 1.0, 500.0, 1200.0, "a"),
        ("Apartments.com", datetime.date(2020, 10, 3), "42660", "53033", 1.0, 1.0, 500.0, 1200.0, "a"),
        ("Apartments.com", datetime.date(2020, 9, 30), "42660", "53033", 2.0, 1.0, 500.0, 1200.0, "a"),
        ("Apartments.com", datetime.date(2020, 10, 3), "99999", "53033", 3.0, 1.0, 500.0, 1200.0, "a"),
        ("Other", datetime.date(2020, 10, 3), "42660", "53033", 4.0, 1.0, 500.0, 1200.0, "a"),
    ]
    out = apartments.build(spark.createDataFrame(rows, schemas.GEOCODED), flat(county))
    assert got(out, "listing_date", "fips", "namelsad", "beds", "rent_mid") == [
        (datetime.date(2020, 10, 2), "53033", "King County", 1.0, 1200.0)]


POST = {
    "date": "Oct 15, 3:04:05 PM", "posted_date": "2020-10-15", "beds": "2BR", "baths": "1Ba",
    "sqft": "900\nft\n2", "rent": "$1,850", "gmaps_url": "https://x/maps/search/47.61,-122.33",
    "url": "u1",
}


def test_craigslist(rows, county):
    raw = rows(schemas.CRAIGSLIST, POST, {**POST, "gmaps_url": None}, {**POST, "gmaps_url": "search/10.0,10.0"})
    out = craigslist.build(raw, county)
    assert got(out, "date", "beds", "baths", "sqft", "rent", "lat", "lng", "fips") == [
        (datetime.date(2020, 10, 15), 2.0, 1.0, 900.0, 1850.0, 47.61, -122.33, "53033")]


def test_craigslist_keeps_the_latest(rows, county):
    raw = rows(schemas.CRAIGSLIST, {**POST, "date": "Oct 1, 1:00:00 AM", "url": "u1"},
               {**POST, "date": "Oct 9, 1:00:00 AM", "url": "u2"}, {**POST, "date": None, "url": "u0"})
    assert got(craigslist.build(raw, county), "url") == [("u2",)]


def test_gosection8(rows, county):
    base = {"rent": "$1,100", "address": "1 A St", "container": "King County WA"}
    raw = rows(schemas.GOSECTION8, {**base, "beds_bath": "2\nBed 1.5 Bath\nHouse"},
               {**base, "beds_bath": "Efficiency\nBed 1 Bath"},
               {**base, "beds_bath": "2\nBed 1.5 Bath\nHouse", "container": "Elsewhere"},
               {**base, "beds_bath": "2\nBed 1.5 Bath\nHouse", "container": None})
    assert got(gosection8.build(raw, flat(county)), "beds", "baths", "unit_type", "rent", "fips", "metro_name") == [
        (0.0, 1.0, None, 1100.0, "53033", "Seattle"), (2.0, 1.5, "House", 1100.0, "53033", "Seattle")]


def test_trulia(rows, county):
    unit = {"rent": "$1,500/mo", "beds": "2bd", "baths": "1ba", "sqft": "1,050 sqft",
            "line_1": "12 Main St #4", "line_2": "Seattle, WA", "url": "x/for_rent/6037_c/"}
    raw = rows(schemas.TRULIA, unit, {**unit, "rent": "$1,200 - $1,500/mo", "beds": "1-2bd"},
               {**unit, "beds": "Studio", "line_1": None}, {**unit, "url": "x/for_rent/99999_c/"},
               {**unit, "rent": "$900 - $950/mo", "beds": "3-3bd"})
    out = trulia.build(raw, flat(county))
    columns = ("is_bldg", "beds", "rent", "address", "fips", "sqft")
    address = "12 Main St, Seattle, WA"
    assert got(out, *columns) == sorted([
        (False, 2.0, 1500.0, address, "06037", 1050.0), (True, 1.0, 1200.0, address, "06037", 1050.0),
        (True, 2.0, 1500.0, address, "06037", 1050.0), (True, 3.0, None, address, "06037", 1050.0),
        (False, None, 1500.0, "NA, Seattle, WA", "06037", 1050.0)], key=str)
    right = trulia.build(raw, flat(county), fixes=quirks.ALL)
    assert (False, 0.0, 1500.0, "Seattle, WA", "06037", 1050.0) in got(right, *columns)
    assert (True, 3.0, 900.0, address, "06037", 1050.0) in got(right, *columns)


def test_zillow(rows, county):
    raw = rows(
        schemas.ZILLOW,
        {"bedrooms": "$1,200+\nStudio$1,500\n1 bd$9,900\n12 bd", "address": "The Ann | 1 Pine St, Seattle",
         "container": "King County WA", "unit_type": "Apartment for rent"},
        {"rent": "$1,800/mo", "bedrooms": "2 bds\n1 ba\n900\nsqft", "address": "5 Oak St #3, Seattle",
         "container": "King County WA"},
        {"rent": "$1,800/mo", "bedrooms": "2 bds", "address": "x", "container": "Elsewhere"})
    out = zillow.build(raw, flat(county))
    assert got(out, "is_bldg", "beds", "rent", "sqft", "bldg_name", "address", "unit_type", "fips") == [
        (False, 2.0, 1800.0, 900.0, None, "5 Oak St , Seattle", None, "53033"),
        (True, 0.0, 1200.0, None, "The Ann", "1 Pine St, Seattle", "Apartment", "53033"),
        (True, 1.0, 1500.0, None, "The Ann", "1 Pine St, Seattle", "Apartment", "53033"),
        (True, 12.0, 9900.0, None, "The Ann", "1 Pine St, Seattle", "Apartment", "53033")]


PAD_BUILDING = {"rent": "$1,200+", "name": "The Bell", "name_loc": "The Bell Belltown info",
                "rent_inv_1B": "1 Bedrooms 3 RENT $1,300 View", "bedrooms": "Studio", "url": "u1",
                "container": "King County\nWA"}
PAD_UNIT = {"rent": "$1.5K", "bedrooms": "2 Bedroom 1 Bathroom", "name": "10 Bell St #4",
            "name_loc": "10 Bell St #4 Belltown", "url": "u2", "container": "King County WA"}


def test_padmapper(rows, county):
    raw = rows(schemas.PADMAPPER, PAD_BUILDING, {**PAD_BUILDING, "rent_inv_1B": None,
                                                "rent_inv_0B": "Studios 2 RENT $900 View", "url": "u3"},
               PAD_UNIT, {**PAD_UNIT, "rent": None}, {**PAD_UNIT, "bedrooms": "Studio 1 Bathroom"})
    out = padmapper.typed(raw, county)
    assert got(out, "is_bldg", "beds", "baths", "inv", "rent", "loc", "address") == [
        (False, 2.0, 1.0, 1.0, 1500.0, "10 Bell St #4 Belltown", "10 Bell St, Belltown"),
        (False, None, 1.0, 1.0, 1500.0, "10 Bell St #4 Belltown", "10 Bell St, Belltown"),
        (True, 0.0, None, 2.0, 900.0, "Belltown", "Belltown"),
        (True, 1.0, None, 3.0, 1300.0, "Belltown", "Belltown")]
    right = padmapper.typed(raw, county, fixes={quirks.STUDIO_BEDS})
    assert (False, 0.0) in got(right, "is_bldg", "beds")


def test_padmapper_unit_stands_before_building(rows, county):
    """Equal beds, baths, rent and address: the unit stays, whatever the links' order."""
    unit = {"rent": "$1,300", "bedrooms": "1 Bedroom", "name": "5 Oak St", "name_loc": "5 Oak St Bay",
            "url": "z", "container": "King County WA"}
    tower = {**PAD_BUILDING, "name": "The Oak", "name_loc": "The Oak 5 Oak St, Bay", "url": "a"}
    out = padmapper.typed(rows(schemas.PADMAPPER, tower, unit), county)
    assert got(out, "is_bldg", "inv", "address", "url") == [(False, 1.0, "5 Oak St, Bay", "z")]


def test_zillow_unit_stands_before_building(rows, county):
    building = {"bedrooms": "$1,200\nStudio", "address": "The Ann | 5 Oak St", "url": "a", "container": "King County WA"}
    unit = {"rent": "$1,200", "bedrooms": "Studio", "address": "5 Oak St", "url": "z", "container": "King County WA"}
    out = zillow.build(rows(schemas.ZILLOW, building, unit), flat(county))
    assert got(out, "is_bldg", "bldg_name", "url") == [(False, None, "z")]


def test_results_do_not_depend_on_the_order_of_rows(rows, county, spark):
    """Ads that agree in their keys and differ elsewhere, dealt out in other ways."""
    import random

    rng = random.Random(4)
    pick = rng.choice
    place = "King County WA"
    market = [{
        "website": site, "scraped_time": "2020-01-01 00:00:00", "location_identifier": "a", "availablity": "x",
        "bedrooms": pick(["Studio 1 Bath", "2 Beds 1 Baths"]) if site == "homes.com" else pick(["1 - 2 Beds", "1 Beds"]),
        "rent": pick(["$1,500+", "$1,500"]) if site == "homes.com" else "$1,500 - $1,600"}
        for site in ("homes.com", "realtor.com", "rent.com", "forrent.com") for _ in range(12)]
    names = tuple(market[0])
    cases = [(f, names, market) for f in (
        extra_markets.homes, extra_markets.realtor, extra_markets.rent, extra_markets.forrent)]
    dim = flat(county)
    cases += [
        (lambda r: gosection8.build(r, dim), schemas.GOSECTION8, [
            {"rent": "$900", "beds_bath": f"1\nBed 1 Bath\n{pick(['House', 'Flat', ''])}", "address": "a", "container": place, "url": "u"}
            for _ in range(15)]),
        (lambda r: zillow.build(r, dim), schemas.ZILLOW, [
            {"rent": pick([None, "$900"]), "bedrooms": pick(["$900\nStudio", "Studio"]), "address": pick(["N | a", "M | a", "a"]),
             "container": place, "url": "u", "unit_type": pick(["Flat", "House"])} for _ in range(25)]),
        (lambda r: trulia.build(r, dim), schemas.TRULIA, [
            {"rent": "$900", "beds": "1bd", "line_1": f"a #{pick('123')}", "line_2": "s", "url": "x/for_rent/53033_c/", "tags": pick(["A", "B"])}
            for _ in range(15)]),
        (lambda r: padmapper.typed(r, dim), schemas.PADMAPPER, [
            {**pick([PAD_BUILDING, PAD_UNIT]), "container": place, "url": "u", "text": pick(["s", "t"])} for _ in range(20)]),
    ]
    for build, columns, records in cases:
        found = []
        for parts in (1, 3, 7):
            rng.shuffle(records)
            out = build(rows(columns, *records).repartition(parts))
            found.append(sorted(map(str, out.collect())))
        assert found[0] == found[1] == found[2], build


def test_padmapper_first_building_row_wins_whole(rows, county):
    """A repeated building ad counts once, even where only the repeat names a size."""
    again = {**PAD_BUILDING, "rent_inv_1B": None, "rent_inv_2B": "2 Bedrooms 1 RENT $9 View"}
    raw = rows(schemas.PADMAPPER, PAD_BUILDING, again)
    one = padmapper.typed(raw, county)
    assert one.count() == 1


def test_padmapper_located(rows, county, spark):
    raw = rows(schemas.PADMAPPER, PAD_BUILDING, PAD_UNIT)
    book = spark.createDataFrame(
        [("Belltown", -122.3, 47.6), ("10 Bell St, Belltown", 10.0, 10.0)], "address string, X double, Y double")
    out = padmapper.build(raw, county, book)
    assert got(out, "address", "fips", "cbsafp", "container") == [
        ("Belltown", "53033", "42660", "King County WA")]


def test_county_table(spark):
    county = spark.createDataFrame(
        [("King County", "42660", "53033", "53"), ("Cook County", "16980", "17031", "17"),
         ("Lost County", "38060", "04001", "04")], "namelsad string, cbsafp string, geoid string, statefp string")
    state = spark.createDataFrame([("53", "WA"), ("04", "AZ"), ("17", "IL")], "statefp string, stusps string")
    cbsa = spark.createDataFrame([("Seattle", "42660")], "name string, cbsafp string")
    out = county_table(county, state, cbsa)
    assert got(out, "metro_name", "cbsafp", "namelsad", "fips", "state_abb", "container") == [
        ("Seattle", "42660", "King County", "53033", "WA", "King County WA"),
        (None, "38060", "Lost County", "04001", "AZ", "Lost County AZ")]


def located(spark, *rows):
    return spark.createDataFrame(
        [("42660", "53033", "King County", *r) for r in rows],
        "cbsafp string, fips string, namelsad string, beds double, rent double, inv double")


def test_listing_table_labels(spark, county):
    parts = {"trulia": located(spark, (1.0, 900.0, 1.0), (None, 900.0, 1.0), (1.0, 50.0, 1.0)),
             "padmapper": located(spark, (2.0, 800.0, 7.0)),
             "homes": located(spark, (3.0, 700.0, 1.0))}
    out = tables.listing_table(parts, county)
    assert got(out, "source", "beds", "rent", "inv", "cat_beds", "metro_name") == [
        ("Forrent.com", 2.0, 800.0, 1, "2", "Seattle"), ("Padmapper", 2.0, 800.0, 7, "2", "Seattle"),
        ("Trulia", 1.0, 900.0, 1, "1", "Seattle"), ("homes", 3.0, 700.0, 1, "3", "Seattle")]
    right = tables.listing_table(
        {"padmapper": parts["padmapper"], "forrent": located(spark, (4.0, 600.0, 1.0))},
        county, fixes={quirks.FORRENT_COPY})
    assert got(right, "source", "beds", "inv") == [("Forrent.com", 4.0, 1), ("Padmapper", 2.0, 7)]
    with pytest.raises(ValueError):
        tables.located_parts({"padmapper": parts["padmapper"]}, fixes={quirks.FORRENT_COPY})


def test_rent_bounds_are_open(spark):
    rents = [50.0, 50.01, 14999.99, 15000.0, None, float("nan")]
    out = tables.usable(located(spark, *[(1.0, r, 1.0) for r in rents]))
    assert got(out, "rent") == [(14999.99,), (50.01,)]


def test_acs_and_summary(spark, county):
    acs = spark.createDataFrame(
        [("Seattle", *[100.0 * p for p in fixed.PERCENTS]), ("Nowhere", *[1.0] * 8)],
        "msa string, " + ", ".join(f"pct_{p} double" for p in fixed.PERCENTS))
    census = tables.acs_rows(acs, county)
    listings = tables.listing_table({"trulia": located(spark, (1.0, 900.0, 1.0), (1.0, 1000.0, 1.0))}, county)
    out = tables.rent_summary(listings, census)
    assert out.schema.simpleString() == schemas.SUMMARY.simpleString()
    assert got(out, "source", "cat_beds", "n", "q25", "q75", "iqr") == [
        ("2018 ACS", "2", None, 1.0, 1.0, 0.0), ("2018 ACS", "2", None, 2500.0, 7500.0, 5000.0), ("Trulia", "1", 2, 900.0, 1000.0, 100.0)]


def test_write_outputs(spark, county, tmp_path):
    acs = spark.createDataFrame([("Seattle", *[1.0] * 8)], "msa string, " + ", ".join(
        f"pct_{p} double" for p in fixed.PERCENTS))
    listings = tables.listing_table({"trulia": located(spark, (1.0, 900.0, 1.0), (1.5, 90.0, 1.0))}, county)
    tables.write_outputs(spark, listings, tables.acs_rows(acs, county), str(tmp_path))
    text = spark.read.text(f"{tmp_path}/multisource_summary_table.csv")
    lines = [r.value for r in text.collect()]
    assert any(line.startswith("cbsafp,metro_name,source,cat_beds,n,q5") for line in lines)
    assert any(",2018 ACS,2,NA," in line for line in lines)
    stored = spark.read.option("header", True).csv(f"{tmp_path}/multisource_listing_table.csv")
    assert stored.count() == 2


def test_unknown_fix_is_refused():
    with pytest.raises(ValueError, match="unknown"):
        quirks.checked({"studio"})
