"""What each query must return, as DuckDB SQL over the given tables.

The inputs are numbers written into text. Most oracles compute the expected result
from the numbers, without the text, so they share no parsing with the plans.
"""

from __future__ import annotations

METRO = "list_extract(['42660','38060','37980','17140','41700'], CAST({0} + 1 AS INTEGER))"
PERCENTS = (5, 10, 25, 40, 50, 75, 90, 95)

# Numbers behind every ad, and its county if inside the metros.
ADS = f"""
ads AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS flag, l_linestatus AS status,
         CAST(l_shipdate AS DATE) AS ship,
         CAST(floor(l_extendedprice / 5) AS BIGINT) AS r,
         CAST(l_linenumber - 1 AS BIGINT) AS b,
         CAST(l_quantity AS BIGINT) AS q,
         CAST(round(l_discount * 100) AS BIGINT) AS d,
         round(l_tax * 100) >= 5 AS many,
         n_nationkey AS k, n_name, r_name,
         n_name || ' County ' || substr(r_name, 1, 2) AS container,
         CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber || '-'
           || CAST(floor(l_extendedprice / 5) AS BIGINT) || '-' || CAST(l_quantity AS BIGINT) AS ad,
         CASE WHEN CAST(l_quantity AS BIGINT) % 2 = 0 THEN 1.5::DOUBLE ELSE 2.0::DOUBLE END AS baths,
         CAST(l_quantity * 30 + 400 AS DOUBLE) AS area
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

COUNTY = f"""
county AS (
  SELECT r_name AS metro_name, {METRO.format('n_regionkey')} AS cbsafp,
         n_name || ' County' AS namelsad,
         lpad(CAST(6001 + 2 * n_nationkey AS VARCHAR), 5, '0') AS fips,
         substr(r_name, 1, 2) AS state_abb,
         n_name || ' County ' || substr(r_name, 1, 2) AS container,
         n_nationkey AS k
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20
)"""

# Ads of the shared table with its text columns.
MARKETS = """
markets AS (
  SELECT *, CASE WHEN flag = 'A' THEN 'forrent.com' WHEN flag = 'N' THEN 'homes.com'
                 WHEN status = 'F' THEN 'realtor.com' ELSE 'rent.com' END AS website,
         format('${:,}', r) AS price,
         CASE WHEN d <> 0 THEN l_partkey || ' Main St' END AS street
  FROM ads
)"""

POSTS = """
posts AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) + 8000 AS day, o_orderstatus,
         CAST(o_orderkey % 7 AS DOUBLE) AS beds,
         CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 2.0::DOUBLE
              ELSE 1.5::DOUBLE END AS baths,
         CAST(o_custkey % 900 + 400 AS DOUBLE) AS sqft,
         floor(o_totalprice / 50) AS rent,
         CAST((25 + (o_custkey * 37 % 2400) // 100) || '.'
              || lpad(CAST(o_custkey * 37 % 2400 % 100 AS VARCHAR), 2, '0') || '3' AS DOUBLE) AS lat,
         CAST('-' || (76 + (o_custkey * 91 % 4900) // 100) || '.'
              || lpad(CAST(o_custkey * 91 % 4900 % 100 AS VARCHAR), 2, '0') || '7' AS DOUBLE) AS lng
  FROM orders
)"""

# Albers equal area after Snyder, in the inverse hyperbolic form.
CONE = """
ell AS (SELECT 6378137.0::DOUBLE AS a, sqrt((1 / 298.257222101::DOUBLE) * (2 - 1 / 298.257222101::DOUBLE)) AS e),
bands AS (
  SELECT a, e, id, sin(radians(deg)) AS s, cos(radians(deg)) AS c,
         (1 - e * e) * (sin(radians(deg)) / (1 - e * e * sin(radians(deg)) * sin(radians(deg)))
                        + atanh(e * sin(radians(deg))) / e) AS q
  FROM ell, (VALUES (0, 23.0::DOUBLE), (1, 29.5::DOUBLE), (2, 45.5::DOUBLE)) v(id, deg)
),
wide AS (
  SELECT max(a) AS a, max(e) AS e,
         max(CASE id WHEN 0 THEN q END) AS q0, max(CASE id WHEN 1 THEN q END) AS q1,
         max(CASE id WHEN 2 THEN q END) AS q2,
         max(CASE id WHEN 1 THEN c / sqrt(1 - e * e * s * s) END) AS m1,
         max(CASE id WHEN 2 THEN c / sqrt(1 - e * e * s * s) END) AS m2
  FROM bands
),
cone AS (
  SELECT a, e, (m1 * m1 - m2 * m2) / (q2 - q1) AS n,
         m1 * m1 + (m1 * m1 - m2 * m2) / (q2 - q1) * q1 AS c, q0
  FROM wide
)"""


def albers(lng: str, lat: str) -> tuple[str, str]:
    sine = f"sin(radians({lat}))"
    q = f"((1 - e * e) * ({sine} / (1 - e * e * {sine} * {sine}) + atanh(e * {sine}) / e))"
    rho = f"(a * sqrt(c - n * {q}) / n)"
    turn = f"(n * radians({lng} + 96))"
    return f"{rho} * sin({turn})", f"a * sqrt(c - n * q0) / n - {rho} * cos({turn})"


def _triangles() -> str:
    corners = (("lon0", "lat0"), ("lon0 + 9", "lat0"), ("lon0", "lat0 + 4.5::DOUBLE"))
    planar = [albers(*p) for p in corners]
    flat = ", ".join(f"{x} AS x{i}, {y} AS y{i}" for i, (x, y) in enumerate(planar, 1))
    return f"""
grid AS (
  SELECT n_nationkey AS k, CAST(-125 + 10 * (n_nationkey % 5) AS DOUBLE) AS lon0,
         CAST(25 + 5 * (n_nationkey // 5) AS DOUBLE) AS lat0 FROM nation
),
triangles AS (SELECT k, {flat} FROM grid, cone)"""


TRIANGLES = _triangles()


def inside(x: str, y: str) -> str:
    """Point on the left of, or on, all three edges."""
    sides = [
        f"(x{j} - x{i}) * ({y} - y{i}) - ({x} - x{i}) * (y{j} - y{i}) >= 0"
        for i, j in ((1, 2), (2, 3), (3, 1))
    ]
    return " AND ".join(sides)


CRAIGSLIST = f"""
latest_posts AS (
  SELECT * FROM posts p WHERE NOT EXISTS (
    SELECT 1 FROM posts o
    WHERE (o.beds, o.baths, o.sqft, o.rent, o.lat, o.lng) = (p.beds, p.baths, p.sqft, p.rent, p.lat, p.lng)
      AND CASE WHEN year(o.day) < 2020 AND year(p.day) < 2020 OR o.day = p.day
               THEN CAST(o.o_orderkey AS VARCHAR) < CAST(p.o_orderkey AS VARCHAR)
               ELSE o.day > p.day END)
),
planar_posts AS (SELECT latest_posts.*, {albers('lng', 'lat')[0]} AS px, {albers('lng', 'lat')[1]} AS py
                 FROM latest_posts, cone),
craigslist AS (
  SELECT o_orderkey, day, beds, baths, sqft, rent, lat, lng, cbsafp, fips, namelsad, metro_name
  FROM planar_posts JOIN triangles ON {inside('px', 'py')} JOIN county USING (k)
)"""

APARTMENTS = """
apartments AS (
  SELECT DISTINCT cbsafp, fips, namelsad, CAST(b AS DOUBLE) AS beds, baths, area AS sqft,
         CAST(r AS DOUBLE) AS rent_mid, l_partkey || ' Main St' AS geo_address
  FROM ads JOIN county USING (k)
  WHERE status = 'F' AND ship + 8000 >= DATE '2020-10-01'
)"""

GOSECTION8 = """
gosection8 AS (
  SELECT DISTINCT l_partkey || ' Oak Ave, ' || n_name AS address, CAST(b AS DOUBLE) AS beds,
         CASE WHEN b = 0 THEN 1.0::DOUBLE ELSE baths END AS baths, CAST(r AS DOUBLE) AS rent,
         CASE WHEN b > 0 THEN 'House' END AS unit_type, cbsafp, fips, namelsad
  FROM ads JOIN county USING (k, container)
)"""

TRULIA = """
trulia_ads AS (
  SELECT DISTINCT l_partkey || ' Main St, ' || n_name || ', ' || state_abb AS address,
         many AS is_bldg, CASE WHEN many OR b > 0 THEN b END AS b,
         CASE WHEN many THEN q % 4 END AS span, r, CASE WHEN many THEN 100 * q END AS rise,
         baths, area, cbsafp, fips, namelsad
  FROM ads JOIN county USING (k)
),
trulia AS (
  SELECT address, is_bldg, CAST(b + i AS DOUBLE) AS beds, baths, area AS sqft,
         CASE WHEN span IS NULL THEN CAST(r AS DOUBLE)
              WHEN span > 0 THEN r + CAST(rise AS DOUBLE) / span * i END AS rent,
         cbsafp, fips, namelsad
  FROM trulia_ads, (SELECT unnest([0, 1, 2, 3]) AS i) WHERE i <= coalesce(span, 0)
)"""

ZILLOW = """
zillow AS (
  SELECT DISTINCT
         CASE WHEN many THEN l_partkey || ' Pine St, ' || n_name
              ELSE l_partkey || ' Oak St , ' || n_name END AS address,
         CASE WHEN many THEN 'The P' || l_partkey END AS bldg_name, many AS is_bldg,
         CAST(CASE WHEN many THEN i ELSE b END AS DOUBLE) AS beds,
         CASE WHEN NOT many THEN area END AS sqft, CAST(r + 300 * i AS DOUBLE) AS rent,
         cbsafp, fips, namelsad
  FROM ads JOIN county USING (k, container), (SELECT unnest([0, 1, 2, 3]) AS i)
  WHERE i <= CASE WHEN many THEN q % 4 ELSE 0 END
)"""

PADMAPPER = f"""
pad_rows AS (
  SELECT CASE WHEN many AND d <> 7 THEN n_name ELSE l_partkey || ' Bell St, ' || n_name END AS address,
         many, l_partkey, ads.k,
         CAST(CASE WHEN many THEN i WHEN b > 0 THEN b END AS DOUBLE) AS beds,
         CASE WHEN NOT many THEN 1.0::DOUBLE END AS baths,
         CASE WHEN many THEN CAST(r + 300 * i AS DOUBLE)
              WHEN d = 5 THEN 1000 * CAST((r // 1000) || '.' || (r % 1000 // 100) AS DOUBLE)
              ELSE CAST(r AS DOUBLE) END AS rent,
         CAST(CASE WHEN many THEN q + i ELSE 1 END AS DOUBLE) AS inv, ad, container,
         CASE WHEN many THEN 'The P' || l_partkey ELSE l_partkey || ' Bell St #4' END AS name
  FROM ads JOIN county USING (k, container), (SELECT unnest([0, 1, 2, 3, 4]) AS i)
  WHERE i <= CASE WHEN many THEN q % 5 ELSE 0 END
  UNION ALL
  SELECT l_partkey || ' Bell St, ' || n_name, false, l_partkey, ads.k, 1, NULL,
         CAST(r + 300 AS DOUBLE), 1, ad || '-z', container, l_partkey || ' Bell St #4'
  FROM ads JOIN county USING (k, container) WHERE many AND d = 7
),
-- All unit ads stand before all building ads, and the first of equal ads stays.
pad_first AS (
  SELECT * FROM pad_rows
  QUALIFY row_number() OVER (PARTITION BY beds, baths, rent, address
                             ORDER BY CASE WHEN many THEN 2 ELSE 1 END, ad, container, inv, name) = 1
),
pad_points AS (
  SELECT p.*, CASE WHEN address NOT LIKE '% Bell St, %' THEN lon0 + 3.0 ELSE lon0 + (l_partkey * 7 % 997) / 100.0::DOUBLE + 0.003::DOUBLE END AS px,
         CASE WHEN address NOT LIKE '% Bell St, %' THEN lat0 + 1.5::DOUBLE ELSE lat0 + (l_partkey * 13 % 499) / 100.0::DOUBLE + 0.001::DOUBLE END AS py
  FROM pad_first p JOIN grid USING (k)
),
padmapper AS (
  SELECT address, beds, baths, rent, inv, cbsafp, fips, namelsad
  FROM (SELECT address, beds, baths, rent, inv,
               {albers('px', 'py')[0]} AS ax, {albers('px', 'py')[1]} AS ay
        FROM pad_points, cone) pts
  JOIN triangles ON {inside('ax', 'ay')} JOIN county USING (k)
)"""

LISTINGS = """
listing AS (
  SELECT l.*, CASE WHEN beds IN (0, 1, 2, 3) THEN CAST(CAST(beds AS INTEGER) AS VARCHAR)
                   WHEN beds >= 4 THEN '4+' END AS cat_beds,
         (SELECT max(metro_name) FROM county c WHERE c.cbsafp = l.cbsafp) AS metro_name
  FROM (
    SELECT cbsafp, fips, namelsad, beds, rent, CAST(1 AS BIGINT) AS inv, 'Craigslist' AS source FROM craigslist
    UNION ALL SELECT cbsafp, fips, namelsad, beds, rent_mid, 1, 'Apartments.com' FROM apartments
    UNION ALL SELECT cbsafp, fips, namelsad, beds, rent, 1, 'GoSection8' FROM gosection8
    UNION ALL SELECT cbsafp, fips, namelsad, beds, rent, 1, 'Trulia' FROM trulia
    UNION ALL SELECT cbsafp, fips, namelsad, beds, rent, 1, 'Zillow' FROM zillow
    UNION ALL SELECT cbsafp, fips, namelsad, beds, rent, CAST(inv AS BIGINT), 'Padmapper' FROM padmapper
    UNION ALL SELECT cbsafp, fips, namelsad, beds, rent, 1, 'Forrent.com' FROM padmapper
  ) l
  WHERE beds IS NOT NULL AND rent > 50 AND rent < 15000
)"""

ALL_SITES = (ADS, COUNTY, POSTS, CONE, TRIANGLES, CRAIGSLIST, APARTMENTS, GOSECTION8, TRULIA,
             ZILLOW, PADMAPPER, LISTINGS)

TYPED = f"""
typed AS (
  SELECT {METRO.format('n_regionkey')} AS cbsafp,
         lpad(CAST(6001 + 2 * n_nationkey AS VARCHAR), 5, '0') AS fips,
         n_name || ' County' AS namelsad, CAST(l_linenumber - 1 AS DOUBLE) AS beds,
         l_extendedprice AS rent, CAST(l_quantity AS BIGINT) AS inv, l_returnflag AS source
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

ACS = """
acs AS (
  SELECT DISTINCT metro_name, cbsafp, '2' AS cat_beds, '2018 ACS' AS source,
         CAST(NULL AS BIGINT) AS n, {cells}
  FROM region JOIN county ON metro_name = r_name
)""".format(cells=", ".join(f"r_regionkey * 100.0::DOUBLE + {10 * p} AS q{p}" for p in PERCENTS))


def quantiles(table: str, keys: str, value: str, weight: str) -> str:
    """A value is the p-quantile if it is the least one with enough weight at or below it."""
    cells = ", ".join(
        f"min(CASE WHEN upto * 100 >= total * {p} THEN {value} END) AS q{p}" for p in PERCENTS)
    return f"""
      SELECT {keys}, CAST(max(total) AS BIGINT) AS n, {cells}
      FROM (SELECT {keys}, {value},
                   sum({weight}) OVER (PARTITION BY {keys} ORDER BY {value}
                                       RANGE UNBOUNDED PRECEDING) AS upto,
                   sum({weight}) OVER (PARTITION BY {keys}) AS total
            FROM {table}) w
      GROUP BY {keys}"""


def sql(*parts: str) -> str:
    """Common table expressions, then the query."""
    *tables, last = parts
    return f"WITH {','.join(tables)}\n{last}" if tables else last


# Text of the Zillow, Trulia and GoSection8 files, for the queries that return it.
ZILLOW_TEXT = """
zillow_text AS (
  SELECT CASE WHEN NOT many THEN format('${:,}', r) || '/mo' END AS rent,
         CASE WHEN many THEN
                format('${:,}', r) || chr(10) || 'Studio'
                || CASE WHEN q % 4 >= 1 THEN format('${:,}', r + 300) || chr(10) || '1 bd' ELSE '' END
                || CASE WHEN q % 4 >= 2 THEN format('${:,}', r + 600) || chr(10) || '2 bd' ELSE '' END
                || CASE WHEN q % 4 >= 3 THEN format('${:,}', r + 900) || chr(10) || '3 bd' ELSE '' END
              ELSE CASE WHEN b = 0 THEN 'Studio' ELSE b || ' bds' END || chr(10) || '1 ba'
                   || chr(10) || CAST(area AS BIGINT) || chr(10) || 'sqft' END AS bedrooms,
         CASE WHEN many THEN 'The P' || l_partkey || ' | ' || l_partkey || ' Pine St, ' || n_name
              ELSE l_partkey || ' Oak St #3, ' || n_name END AS address,
         'Apartment for rent' AS unit_type, container,
         'https://listings.example.org/' || ad AS url, '1' AS program_iteration, r, q, b, many,
         l_partkey, n_name
  FROM ads
)"""

FORRENT_TEXT = """
forrent_text AS (
  SELECT *, CASE WHEN b = 0 THEN 'Studio' ELSE CAST(b AS VARCHAR) END AS low,
         CASE WHEN many THEN CASE WHEN b = 0 THEN 'Studio' ELSE CAST(b AS VARCHAR) END || ' - ' || (b + q % 4) || ' Beds'
              WHEN b = 0 THEN 'Studio' ELSE b || ' Beds' END AS bedrooms,
         CASE WHEN many THEN price || ' - ' || format('${:,}', r + 100 * q) ELSE price END AS rent
  FROM markets WHERE website = 'forrent.com'
)"""

POST_TEXT = """
post_place AS (
  SELECT c_custkey, c_mktsegment <> 'BUILDING' AS known,
         (c_custkey + 1) || CASE c_custkey % 5 WHEN 0 THEN ' Martin Luther King Junior Memorial Way S'
                                 WHEN 1 THEN ' 9th Ave NE' ELSE ' Main St' END AS address1,
         translate(n_name, '_0123456789', ' ABCDEFGHIJ') AS town,
         CAST(c_custkey % 89999 + 10000 AS VARCHAR) AS zip,
         CASE c_custkey % 3 WHEN 0 THEN 'Mail: ' WHEN 1 THEN 'Sunny home in '
              ELSE 'Located near Green Lake. ' END AS opening
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
post_text AS (
  SELECT c_custkey, address1, CAST(NULL AS VARCHAR) AS neigh1, town,
         CASE WHEN c_custkey % 7 <> 3 THEN town END AS city1, 'WA' AS region1, known, zip,
         'https://maps.example.org/maps/search/' || c_custkey % 50 || '.5,-120.25' AS google_maps_url,
         CASE WHEN known THEN 'Cosy rooms. Visit ' || address1 || ' today.' || chr(10) || opening
                   || town || ', WA ' || zip || '-1234 thanks'
              ELSE 'Call us for the address.' END AS listing_text
  FROM post_place
)"""

CLEAN = """
  SELECT website,
         CASE website WHEN 'forrent.com' THEN CASE WHEN many THEN price || ' - ' || format('${:,}', r + 100 * q) ELSE price END
              WHEN 'homes.com' THEN CASE WHEN d = 10 THEN '$--' WHEN many THEN price || '+' ELSE price END
              ELSE price || '/mo' END AS raw_rent,
         CASE website
              WHEN 'forrent.com' THEN CASE WHEN many THEN CASE b WHEN 0 THEN 'Studio' ELSE CAST(b AS VARCHAR) END || ' - ' || (b + q % 4) || ' Beds'
                                           WHEN b = 0 THEN 'Studio' ELSE b || ' Beds' END
              WHEN 'homes.com' THEN CASE WHEN b = 0 THEN 'Studio 1 Bath'
                                         ELSE b || ' Beds ' || CASE WHEN q % 2 = 0 THEN '1.5' ELSE '2' END
                                              || ' Baths ' || format('{:,}', CAST(area AS BIGINT)) || ' Sqft' END
              WHEN 'realtor.com' THEN CASE WHEN many THEN b || ' - ' || (b + 2) WHEN b = 0 THEN 'Studio' ELSE CAST(b AS VARCHAR) END
              ELSE CASE WHEN many THEN b || '-' || (b + 2) || ' Beds' WHEN b = 0 THEN 'Studio' ELSE b || ' Beds' END
         END AS raw_bedrooms,
         CASE website WHEN 'homes.com' THEN d <> 10 AND many ELSE many END AS is_bldg,
         CASE WHEN website = 'forrent.com' AND many THEN NULL
              WHEN website = 'homes.com' AND d = 10 THEN NULL ELSE CAST(r AS DOUBLE) END AS rent,
         CASE website WHEN 'forrent.com' THEN CASE WHEN NOT many THEN CAST(b AS DOUBLE) END
              WHEN 'homes.com' THEN CASE WHEN b > 0 THEN CAST(b AS DOUBLE) END
              WHEN 'realtor.com' THEN CAST(b AS DOUBLE)
              ELSE CASE WHEN many THEN CAST(b AS DOUBLE) END END AS beds,
         CASE WHEN website = 'homes.com' THEN CASE WHEN b = 0 THEN 1.0::DOUBLE ELSE baths END END AS baths,
         CASE WHEN website = 'homes.com' AND b > 0 THEN area END AS sqft
  FROM markets"""

SQL: dict[str, str] = {
    "scan_filter": sql(ADS, f"""
        SELECT 'Apartments.com' AS source, ship + 8000 AS listing_date,
               {METRO.format('k % 5')} AS cbsafp,
               lpad(CAST(6001 + 2 * k AS VARCHAR), 5, '0') AS countyfp, CAST(b AS DOUBLE) AS beds,
               baths, area AS sqft, CAST(r AS DOUBLE) AS rent_mid, l_partkey || ' Main St' AS geo_address
        FROM ads WHERE status = 'F' AND ship + 8000 >= DATE '2020-10-01' AND k < 20"""),
    "scan_by_site": sql(ADS, MARKETS, f"""
        SELECT website, raw_rent AS rent, raw_bedrooms AS bedrooms FROM ({CLEAN})
        WHERE website = 'homes.com'"""),
    "csv_roundtrip": sql(ADS, ZILLOW_TEXT, """
        SELECT rent, bedrooms, address, unit_type, container, url, program_iteration FROM zillow_text"""),
    "csv_schema_drift": sql(ADS, """
        SELECT 'New' AS tags,
               format('${:,}', r) || CASE WHEN many THEN format(' - ${:,}', r + 100 * q) ELSE '' END || '/mo' AS rent,
               CASE WHEN many THEN b || '-' || (b + q % 4) || 'bd' WHEN b = 0 THEN 'Studio' ELSE b || 'bd' END AS beds,
               CASE WHEN q % 2 = 0 THEN '1.5ba' ELSE '2ba' END AS baths,
               format('{:,}', CAST(area AS BIGINT)) || ' sqft' AS sqft,
               l_partkey || ' Main St #' || q AS line_1, n_name || ', ' || substr(r_name, 1, 2) AS line_2,
               CASE WHEN status = 'O' THEN container END AS container,
               'https://homes.example.org/for_rent/' || (6001 + 2 * k) || '_c/' || ad AS url,
               '1' AS program_iteration
        FROM ads"""),
    "county_dim": sql(COUNTY, "SELECT * EXCLUDE (k) FROM county"),
    "semi_county": sql(ADS, """
        SELECT container, 'https://section.example.org/' || ad AS url, format('${:,}', r) AS rent
        FROM ads WHERE k < 20"""),
    "natural_left_join": sql(ADS, COUNTY, """
        SELECT 'https://section.example.org/' || ad AS url, ads.container, format('${:,}', r) AS rent,
               metro_name, cbsafp, namelsad, fips, state_abb
        FROM ads LEFT JOIN county ON ads.k = county.k"""),
    "null_safe_join": """
        WITH keyed AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
        names AS (SELECT DISTINCT segment, coalesce(lower(segment), 'none given') AS label FROM keyed)
        SELECT c_custkey, keyed.segment, label
        FROM keyed LEFT JOIN names ON keyed.segment IS NOT DISTINCT FROM names.segment""",
    "distinct_dim": sql(COUNTY, "SELECT cbsafp, metro_name FROM county GROUP BY ALL"),
    "clean_listing_fields": sql(ADS, MARKETS, CLEAN),
    "parse_failures": sql(ADS, MARKETS, f"""
        SELECT website, count(*) AS n_rows, count(*) FILTER (rent IS NULL) AS no_rent,
               count(*) FILTER (beds IS NULL) AS no_beds, CAST(0 AS BIGINT) AS overlong
        FROM ({CLEAN}) GROUP BY website"""),
    "sentinel_to_null": sql(ADS, MARKETS, f"""
        SELECT website, CAST(ship AS VARCHAR) || CASE WHEN q % 3 = 0 THEN 'T20:04:05-07:00'
                                                      ELSE ' 03:04:05' END AS scraped_time,
               CASE website WHEN 'forrent.com' THEN CASE WHEN many THEN price || ' - ' || format('${{:,}}', r + 100 * q) ELSE price END
                    WHEN 'homes.com' THEN CASE WHEN d = 10 THEN '$--' WHEN many THEN price || '+' ELSE price END
                    ELSE price || '/mo' END AS rent,
               street || ' ' || n_name AS location_identifier
        FROM markets"""),
    "range_split": sql(ADS, MARKETS, FORRENT_TEXT, """
        SELECT bedrooms, rent, CAST(b AS DOUBLE) AS beds_lower,
               CASE WHEN many THEN CAST(b + q % 4 AS DOUBLE) END AS beds_upper,
               CAST(r AS DOUBLE) AS rent_lower,
               CASE WHEN many THEN CAST(r + 100 * q AS DOUBLE) END AS rent_upper
        FROM forrent_text"""),
    "listing_dates": sql(POSTS, """
        SELECT CAST(o_orderkey AS VARCHAR) AS post_id,
               CASE WHEN year(day) >= 2020 THEN day END AS date, strftime(day, '%m') AS month,
               CASE WHEN year(day) >= 2020 THEN CAST(year(day) AS VARCHAR) END AS year,
               '3:04:05 PM' AS time FROM posts"""),
    "listings_per_month": sql(POSTS, """
        SELECT CASE WHEN year(day) >= 2020 THEN make_date(year(day), month(day), 1) END AS month_start,
               count(*) AS n FROM posts GROUP BY ALL"""),
    "scrape_times": sql(ADS, MARKETS, """
        SELECT website, CAST(ship + CASE WHEN q % 3 = 0 THEN 1 ELSE 0 END AS DATE) + INTERVAL '3 hours 4 minutes 5 seconds'
                 AS scraped_time, CAST(ship + CASE WHEN q % 3 = 0 THEN 1 ELSE 0 END AS DATE) AS date,
               count(*) AS n FROM markets GROUP BY ALL"""),
    "normalize_addresses": sql(ADS, POST_TEXT, """
        SELECT 'https://listings.example.org/' || ad AS url,
               CASE WHEN many THEN 'The P' || l_partkey || ' | ' || l_partkey || ' Pine St, ' || n_name
                    ELSE l_partkey || ' Oak St , ' || n_name END AS address, CAST(NULL AS VARCHAR) AS zip5
        FROM ads
        UNION ALL
        SELECT address1, replace(listing_text, '-1234', ''), CASE WHEN known THEN zip END FROM post_text
        UNION ALL
        SELECT address1, replace(listing_text, '-1234', ''), CASE WHEN known THEN zip END FROM post_text
        WHERE c_custkey % 50 = 7
        UNION ALL
        SELECT 'https://homes.example.org/for_rent/' || (6001 + 2 * k) || '_c/' || ad,
               l_partkey || ' Main St, ' || n_name || ', ' || substr(r_name, 1, 2), NULL FROM ads"""),
    "locate_by_url": sql(ADS, COUNTY, POSTS, """
        SELECT 'https://homes.example.org/for_rent/' || (6001 + 2 * ads.k) || '_c/' || ad AS url,
               lpad(CAST(6001 + 2 * ads.k AS VARCHAR), 5, '0') AS fips, CAST(NULL AS DOUBLE) AS lat,
               CAST(NULL AS DOUBLE) AS lng, namelsad
        FROM ads LEFT JOIN county ON ads.k = county.k
        UNION ALL
        SELECT 'https://posts.example.org/' || o_orderkey, NULL, lat, lng, NULL FROM posts"""),
    "dedupe_keep_first": """
        SELECT o.* FROM orders o JOIN (
            SELECT o_custkey, o_orderpriority, min((o_totalprice, o_orderkey)) AS least
            FROM orders GROUP BY ALL) f
          ON o.o_custkey = f.o_custkey AND o.o_orderpriority = f.o_orderpriority
         AND (o.o_totalprice, o.o_orderkey) = f.least""",
    "dedupe_latest": """
        SELECT o.* FROM orders o WHERE NOT EXISTS (
            SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey
               AND p.o_orderpriority = o.o_orderpriority
               AND (p.o_orderdate > o.o_orderdate
                    OR p.o_orderdate = o.o_orderdate AND p.o_orderkey < o.o_orderkey))""",
    "building_unit_split": sql(ADS, MARKETS, FORRENT_TEXT, """
        SELECT CASE WHEN many THEN 'building' ELSE 'unit' END AS kind, bedrooms,
               CASE WHEN many THEN rent END AS rent,
               CASE WHEN NOT many THEN CAST(r AS DOUBLE) END AS unit_rent
        FROM forrent_text"""),
    # Of the ads that agree in all numbers and the address a site keeps the earliest; the share
    # is taken of what it keeps.
    "building_share": sql(ADS, MARKETS, """
        SELECT website, is_bldg, count(*) AS n,
               count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY website) AS prop
        FROM (
          SELECT website, many AS is_bldg FROM markets WHERE website <> 'homes.com' OR d <> 10
          QUALIFY row_number() OVER (
            PARTITION BY website, street || n_name, r,
              CASE WHEN website <> 'rent.com' OR many THEN b END,  -- a unit of Rent.com has no size
              CASE WHEN website = 'forrent.com' AND many THEN q END,
              CASE WHEN website = 'homes.com' AND b > 0 THEN q % 2 END,
              CASE WHEN website = 'homes.com' AND b > 0 THEN area END
            ORDER BY CAST(ship + CASE WHEN q % 3 = 0 THEN 1 ELSE 0 END AS DATE),
              CASE WHEN many THEN b || ' - ' || (b + 2) WHEN b = 0 THEN 'Studio' ELSE CAST(b AS VARCHAR) END,
              q || ' ', many) = 1)
        GROUP BY website, is_bldg"""),
    "harmonize_union": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS rent, CAST(NULL AS INTEGER) AS beds
        FROM customer
        UNION ALL SELECT s_suppkey, NULL, NULL, s_nationkey FROM supplier""",
    "rent_bounds": sql(TYPED, "SELECT * FROM typed WHERE rent > 50 AND rent < 15000"),
    "bed_class": sql(TYPED, """
        SELECT beds - CASE WHEN inv > 40 THEN 0.5::DOUBLE ELSE 0 END AS beds,
               CASE WHEN inv > 40 AND beds >= 5 THEN '4+' WHEN inv > 40 THEN NULL
                    WHEN beds >= 4 THEN '4+' ELSE CAST(CAST(beds AS INTEGER) AS VARCHAR) END AS cat_beds,
               count(*) AS n FROM typed GROUP BY ALL"""),
    "bed_range_expand": sql(ADS, """
        SELECT ad, CAST(beds AS DOUBLE) AS beds,
               CASE WHEN q % 4 > 0 THEN r + CAST(100 * q AS DOUBLE) / (q % 4) * (beds - b) END AS rent
        FROM (SELECT *, unnest(generate_series(b, b + q % 4)) AS beds FROM ads WHERE many)"""),
    "unpivot_rent": sql(ADS, """
        SELECT ad, CAST(i AS DOUBLE) AS beds, CAST(r + 300 * i AS DOUBLE) AS rent
        FROM (SELECT *, unnest(generate_series(0, q % 5)) AS i FROM ads WHERE many)"""),
    "offers_by_size": sql(ADS, """
        SELECT 'https://listings.example.org/' || ad AS url, CAST(i AS DOUBLE) AS beds,
               CAST(r + 300 * i AS DOUBLE) AS rent
        FROM (SELECT *, unnest(generate_series(0, q % 4)) AS i FROM ads WHERE many)"""),
    "inventory_by_size": sql(ADS, """
        SELECT 'https://map.example.org/' || ad AS url, CAST(i AS DOUBLE) AS beds,
               CAST(q + i AS DOUBLE) AS inv, CAST(r + 300 * i AS VARCHAR) AS rent
        FROM (SELECT *, unnest(generate_series(0, q % 5)) AS i FROM ads WHERE many)"""),
    "pivot_inventory": sql(ADS, """
        SELECT DISTINCT 'https://map.example.org/' || ad AS url, CAST(i AS DOUBLE) AS beds,
               (q + i) || '.0' AS inv, CAST(r + 300 * i AS VARCHAR) AS rent
        FROM (SELECT *, unnest(generate_series(0, q % 5)) AS i FROM ads WHERE many)"""),
    "weighted_quantiles": sql(TYPED, quantiles("typed", "cbsafp, source, beds", "rent", "inv")),
    "albers_project": sql(POSTS, CONE, f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS post_id, round({albers('lng', 'lat')[0]}, 3) AS x,
               round({albers('lng', 'lat')[1]}, 3) AS y FROM posts, cone"""),
    "point_in_polygon": sql(POSTS, """
        SELECT CAST(o_orderkey AS VARCHAR) AS post_id, n_name || ' County' AS namelsad
        FROM posts LEFT JOIN nation
          ON lng >= -125 + 10 * (n_nationkey % 5) AND lat >= 25 + 5 * (n_nationkey // 5)
         AND (lng - (-125 + 10 * (n_nationkey % 5))) / 9
             + (lat - (25 + 5 * (n_nationkey // 5))) / 4.5::DOUBLE <= 1"""),
    "geocode_enrich": sql(ADS, """
        SELECT ad, CASE WHEN d > 0 THEN l_partkey || ' bell st, ' || n_name END AS address,
               CASE WHEN d > 0 THEN -125 + 10 * (k % 5) + (l_partkey * 7 % 997) / 100.0::DOUBLE + 0.003::DOUBLE END AS "X",
               CASE WHEN d > 0 THEN 25 + 5 * (k // 5) + (l_partkey * 13 % 499) / 100.0::DOUBLE + 0.001::DOUBLE END AS "Y"
        FROM ads"""),
    "provider_enrich": sql(ADS, """
        SELECT ad, CASE WHEN d > 0 THEN l_partkey || ' bell st, ' || n_name END AS address,
               CASE WHEN d > 0 AND n_name <> 'NATION_7' THEN l_partkey / 100.0::DOUBLE - 120 END AS "X",
               CASE WHEN d > 0 AND n_name <> 'NATION_7' THEN CAST(l_partkey % 50 AS DOUBLE) END AS "Y"
        FROM ads"""),
    "reverse_geocode": """
        WITH pts AS (SELECT c_custkey, c_acctbal AS x, c_custkey % 2503 * 4.0::DOUBLE AS y FROM customer),
        places AS (SELECT upper(s_name) AS name, s_acctbal AS x, s_suppkey % 101 * 97.0::DOUBLE AS y FROM supplier),
        pairs AS (
          SELECT c_custkey, name, sqrt((p.x - a.x) * (p.x - a.x) + (p.y - a.y) * (p.y - a.y)) AS dist
          FROM pts p JOIN places a ON abs(p.x - a.x) <= 900 AND abs(p.y - a.y) <= 900),
        best AS (SELECT c_custkey, min((dist, name)) AS m FROM pairs WHERE dist <= 900 GROUP BY c_custkey)
        SELECT pts.c_custkey, m[2] AS rev_address, round(m[1], 6) AS rev_distance
        FROM pts LEFT JOIN best USING (c_custkey)""",
    # Where the text names no place, the fields do; the ZIP is then that of the look-up's address, of
    # two the one at the map link.
    "geoparse": sql(POST_TEXT, """
        SELECT address1, neigh1, city1, region1, google_maps_url, listing_text, address1 AS match_address,
               CASE WHEN placed THEN town || ', WA ' || code END AS match_address2,
               address1 || ' ' || CASE WHEN placed THEN town || ', WA ' || code ELSE 'NA' END AS temp_add,
               CASE WHEN twin THEN -120.25::DOUBLE WHEN placed THEN c_custkey * 0.5::DOUBLE END AS lng,
               CASE WHEN twin THEN c_custkey % 50 + 0.5::DOUBLE WHEN placed THEN c_custkey * 0.25::DOUBLE END AS lat
        FROM (SELECT *, known OR city1 IS NOT NULL AS placed, NOT known AND city1 IS NOT NULL AND c_custkey % 4 = 0 AS twin,
                     CASE WHEN NOT known AND c_custkey % 4 = 0 THEN CAST(CAST(zip AS INTEGER) + 1 AS VARCHAR) ELSE zip END AS code
              FROM post_text)"""),
    "site_apartments": sql(ADS, COUNTY, APARTMENTS, "SELECT * FROM apartments"),
    "site_forrent": sql(ADS, MARKETS, """
        SELECT address, many AS is_bldg, CAST(b + i AS DOUBLE) AS beds,
               CASE WHEN NOT many THEN CAST(r AS DOUBLE)
                    WHEN span > 0 THEN r + CAST(rise AS DOUBLE) / span * i END AS rent,
               CASE WHEN many THEN CAST(b AS DOUBLE) END AS beds_lower,
               CASE WHEN many THEN CAST(b + span AS DOUBLE) END AS beds_upper,
               CASE WHEN many THEN CAST(r AS DOUBLE) END AS rent_lower,
               CASE WHEN many THEN CAST(r + rise AS DOUBLE) END AS rent_upper
        FROM (SELECT DISTINCT street || chr(10) || n_name AS address, many, b, r,
                     CASE WHEN many THEN q % 4 END AS span, CASE WHEN many THEN 100 * q END AS rise
              FROM markets WHERE website = 'forrent.com'),
             (SELECT unnest([0, 1, 2, 3]) AS i)
        WHERE i <= coalesce(span, 0)"""),
    "site_homes": sql(ADS, MARKETS, f"""
        SELECT DISTINCT street || chr(10) || n_name AS address,
               CASE WHEN b > 0 THEN CAST(b AS DOUBLE) END AS beds,
               CASE WHEN b = 0 THEN 1.0::DOUBLE ELSE baths END AS baths,
               CASE WHEN b > 0 THEN area END AS sqft, CAST(r AS DOUBLE) AS rent
        FROM markets WHERE website = 'homes.com' AND d <> 10"""),
    "site_realtor": sql(ADS, MARKETS, """
        SELECT DISTINCT street || ' ' || n_name AS address, CAST(b AS DOUBLE) AS beds,
               CAST(r AS DOUBLE) AS rent
        FROM markets WHERE website = 'realtor.com'"""),
    "site_rent": sql(ADS, MARKETS, """
        SELECT DISTINCT street || ' ' || n_name AS address,
               CASE WHEN many THEN CAST(b AS DOUBLE) END AS beds, CAST(r AS DOUBLE) AS rent
        FROM markets WHERE website = 'rent.com'"""),
    "site_craigslist": sql(COUNTY, POSTS, CONE, TRIANGLES, CRAIGSLIST, """
        SELECT CAST(o_orderkey AS VARCHAR) AS post_id, CASE WHEN year(day) >= 2020 THEN day END AS date,
               beds, baths, sqft, rent, lat, lng, cbsafp, fips, namelsad, metro_name
        FROM craigslist"""),
    "site_gosection8": sql(ADS, COUNTY, GOSECTION8, "SELECT * FROM gosection8"),
    "site_trulia": sql(ADS, COUNTY, TRULIA, "SELECT * FROM trulia"),
    "site_zillow": sql(ADS, COUNTY, ZILLOW, "SELECT * FROM zillow"),
    "site_padmapper": sql(
        ADS, COUNTY, CONE, TRIANGLES, PADMAPPER, "SELECT * FROM padmapper"),
    "acs_append": sql(COUNTY, ACS, "SELECT * FROM acs"),
    "listing_table": sql(*ALL_SITES, "SELECT * FROM listing"),
    "rent_summary": sql(*ALL_SITES, ACS, f"""
        SELECT cbsafp, metro_name, source, cat_beds, n, {', '.join(f'q{p}' for p in PERCENTS)},
               q75 - q25 AS iqr
        FROM ({quantiles('listing', 'cbsafp, metro_name, source, cat_beds', 'rent', 'inv')}
              UNION ALL BY NAME SELECT * FROM acs)"""),
}
