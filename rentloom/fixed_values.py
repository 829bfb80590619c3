"""Values that results depend on, stated once.

Every pattern is a Java regular expression as Spark's regexp functions read it.
"""

# --- fixed values -----------------------------------------------------------

# Metro areas (CBSA codes) the tables cover.
METROS = ("42660", "38060", "37980", "17140", "41700")

# Text a scraper writes when a page lacks the field.
MISSING_ON_SITE = "not available on this site"

# Rent placeholder of homes.com.
HOMES_NO_RENT = "$--"

# Month abbreviations, January first.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Rents outside this open interval are taken for errors.
RENT_ABOVE = 50
RENT_BELOW = 15000

# Percentiles of the summary table.
PERCENTS = (5, 10, 25, 40, 50, 75, 90, 95)

# First listing day read from the structured table.
FIRST_LISTING_DATE = "2020-10-01"

# Labels of the rows in the output tables.
SOURCE_APARTMENTS = "Apartments.com"
SOURCE_CRAIGSLIST = "Craigslist"
SOURCE_FORRENT = "Forrent.com"
SOURCE_GOSECTION8 = "GoSection8"
SOURCE_PADMAPPER = "Padmapper"
SOURCE_TRULIA = "Trulia"
SOURCE_ZILLOW = "Zillow"
SOURCE_ACS = "2018 ACS"

# Names of the written tables.
LISTING_FILE = "multisource_listing_table"
SUMMARY_FILE = "multisource_summary_table"

# Sites that share one table, told apart by its website column.
SITE_FORRENT = "forrent.com"
SITE_HOMES = "homes.com"
SITE_REALTOR = "realtor.com"
SITE_RENT = "rent.com"

# Blanks that trimming removes: control blanks and all Unicode separators.
BLANKS = (
    "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Numbers in free text: comma groups digits, point is the decimal mark.
NUMBER = r"-?[0-9][0-9,]*([.][0-9]*)?|-?[.][0-9]+"

# Bedrooms, bathrooms and area in listing headlines.
HOMES_BEDS = r"[0-9-.]{1,5} Bed[s]{0,1}"
HOMES_BATHS = r"[0-9-.]{1,5} Bath[s]{0,1}"
HOMES_SQFT = r"[0-9-+]{1,6} Sqft"
RENT_BEDS = r"[0-9-]{3} Beds"
RENT_UNITS = r"[0-9]{1,3} Units Available"
GOSECTION8_STUDIO = r"Studio|Efficiency"
GOSECTION8_BEDS = r"[0-9]\nBed"
GOSECTION8_BATHS = r"[0-9.]{1,3} Bath"
TRULIA_BEDS = r"[0-9-]{1,3}bd"
TRULIA_RENT_NOISE = r"/mo|\$"
ZILLOW_OFFER = r"\$([0-9,]{3,6})\+{0,1}\n(Studio|[0-9]+ bd)"
ZILLOW_SQFT = r"[0-9,]{3,6}\nsqft"
ZILLOW_SIZES = ("Studio", "1 bd", "2 bd", "3 bd", "4 bd", "5 bd", "6 bd",
                "7 bd", "8 bd", "9 bd", "10 bd", "11 bd", "12 bd")
PADMAPPER_BEDS = r"[0-9]{1,2} Bedroom"
PADMAPPER_BATHS = r"[0-9]{1,2} Bathroom"
PADMAPPER_INVENTORY_NOISE = r"Studios |[1-4] Bedrooms | View"
PADMAPPER_SIZES = ("rent_inv_0B", "rent_inv_1B", "rent_inv_2B", "rent_inv_3B", "rent_inv_4B")

# Dates in Craigslist posts.
POST_YEAR = r"202[0-9]"
POST_TIME = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2} A{0,1}P{0,1}M"
UTC_OFFSET = r"(?<=[0-9]) ?(?:Z|[+-][0-9]{2}:?[0-9]{2})$"

# Addresses.
AFTER_HASH = r"(?<=#)(.*?)(?=,)"
AFTER_UNIT = r"(?<=UNIT)(.*?)(?=,)"
UNIT_LEFTOVER = r"UNIT,|#,"
UNIT_MARK = r"#|UNIT|APT"
ZIP = r"(?<!\d)\d{5}(?:[ -]\d{4})?\b"
URL_COORDINATES = "search/"
# Rows of the census file that count.
ACS_ROWS = 5
URL_COUNTY = "for_rent/"

# Conus Albers equal area (EPSG:5070) on the GRS 80 ellipsoid.
ALBERS_MAJOR_AXIS = 6378137.0
ALBERS_INVERSE_FLATTENING = 298.257222101
ALBERS_PARALLELS = (29.5, 45.5)
ALBERS_ORIGIN = (23.0, -96.0)

# --- end of fixed values ----------------------------------------------------
