"""The canonical catalogue record and the fixed values the library works with."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names and defaults of the record, as results have them today -----------

CANONICAL = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("availability", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)

#: What a missing text value becomes when a source is conformed.
TEXT_DEFAULTS = {"title": "", "availability": "", "source": "unknown"}

#: Header names of raw book files and the canonical columns they feed.
BOOK_FILE_COLUMNS = {
    "book_title": "title",
    "book_author": "availability",
    "year_of_publication": "rating",
}

PEOPLE_DOCUMENT = T.StructType(
    [
        T.StructField("number", T.IntegerType()),
        T.StructField(
            "people",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("craft", T.StringType()),
                        T.StructField("name", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# --- fixed values: must equal the results users get today ---------------------------------

PIPELINE_VERSION = "1.0.0"

SOURCES = ("web", "csv", "sql")

DEFAULT_AVAILABILITY = "Unknown"
DEFAULT_PRICE = 0.0
IN_STOCK_PHRASE = "in stock"

# price < bound -> label; the last label takes everything else
PRICE_BOUNDS = (10, 30, 60)
PRICE_LABELS = ("low", "medium", "high", "premium")

# the second price scale, with a label of its own for missing prices
ALT_PRICE_BOUNDS = (10, 25)
ALT_PRICE_LABELS = ("low", "medium", "high")
ALT_PRICE_MISSING = "unknown"

# rating >= floor -> label
RATING_GRADES = ((4, "excellent"), (3, "good"), (2, "average"))
RATING_OTHERWISE = "poor"

RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

SHARE_LINK_ID = r"/d/([a-zA-Z0-9_-]+)"
DIRECT_DOWNLOAD = "https://drive.google.com/uc?export=download&id="

PERSON_MESSAGE = "%s is currently in space flying on the %s! %s"
GREETING = "Hello! :)"

# rows served when a people document cannot be read
FALLBACK_PEOPLE_NUMBER = 12
FALLBACK_PEOPLE = (
    ("ISS", "Oleg Kononenko"),
    ("ISS", "Nikolai Chub"),
    ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"),
    ("ISS", "Michael Barratt"),
    ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"),
    ("ISS", "Butch Wilmore"),
    ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"),
    ("Tiangong", "Li Cong"),
    ("Tiangong", "Ye Guangfu"),
)

# --- fixed values: what pandas and Python treat as missing text and as white space ---------

NA_TEXT = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
