"""Vocabularies, lookup tables, patterns and formats.

These are data, not logic. They have to be exactly what they are for the
results to come out right, so they are stated here plainly and together.
"""

# --- label vocabulary and the three human orders of an address -------------

STANDARD_ORDERS = (
    ("house_number", "road", "city", "city_district", "state_district", "state",
     "postcode", "house", "level", "unit", "po_box", "country"),
    ("house", "house_number", "po_box", "road", "city", "city_district",
     "state_district", "state", "postcode", "level", "unit", "country"),
    ("house", "level", "unit", "po_box", "house_number", "road", "city",
     "city_district", "state_district", "state", "postcode", "country"),
)

EXTENDED_ORDERS = (
    ("house_number", "road", "near", "city", "suburb", "city_district",
     "state_district", "state", "postcode", "house", "level", "unit", "po_box",
     "country_region", "country", "lon", "lat", "id", "hash"),
    ("house", "house_number", "po_box", "road", "near", "city", "suburb",
     "house_number", "city_district", "state_district", "state", "postcode",
     "level", "unit", "country_region", "country", "lon", "lat", "id", "hash"),
    ("house", "level", "unit", "po_box", "house_number", "road", "near", "city",
     "suburb", "city_district", "state_district", "state", "postcode",
     "country_region", "country", "lon", "lat", "id", "hash"),
)

ORDERS = {"standard": STANDARD_ORDERS, "extended": EXTENDED_ORDERS}

# An order never grows beyond this many entries while labels are duplicated.
MAX_ORDER_SIZE = 20

# Order used when the text is built from a fixed list of columns.
PLAIN_ORDER = ("unit", "house_number", "road", "postcode", "city")

# Label names shown for that order.
PLAIN_LABELS = ("UNIT", "House_number", "Street", "Postcode", "City")

LABELS = STANDARD_ORDERS[0]

# --- source headers --------------------------------------------------------

# Positional header of an address file and the label of each position.
FILE_HEADER = ("LON", "LAT", "NUMBER", "STREET", "UNIT", "CITY", "DISTRICT",
               "REGION", "POSTCODE", "ID", "HASH")
FILE_LABELS = ("lon", "lat", "house_number", "road", "unit", "city",
               "state_district", "state", "postcode", "id", "hash")

# Header name to label; an empty label drops the column. Looked up without
# regard to case, blanks and underscores.
HEADER_LABELS = {
    "LAT": "",
    "LON": "",
    "NUMBER": "house_number",
    "HOUSE_NUMBER": "house_number",
    "STREET": "road",
    "ROAD": "road",
    "UNIT": "unit",
    "CITY": "city",
    "DISTRICT": "",
    "REGION": "state",
    "STATE": "state",
    "POSTCODE": "postcode",
    "COUNTRY": "country",
    "ID": "",
    "HASH": "",
}

# Geocoder components that are kept.
COMPONENTS = ("house_number", "road", "unit", "city", "state", "postcode", "country")

# Columns the plain format drops, and how it renames the others.
PLAIN_DROPPED = ("LON", "LAT", "HASH", "ID", "DISTRICT", "REGION")
PLAIN_RENAMED = {"NUMBER": "house_number", "STREET": "road", "UNIT": "unit",
                 "CITY": "city", "POSTCODE": "postcode"}

# A file name matching this names no city.
GENERIC_FILE_NAME = "[0-9]|country|province|state|wide"
FILE_NAME_NOISE = ("city_of_", "municipality_of_")
AREA_FILE_NAMES = ("countrywide", "statewide")

# --- text formats ----------------------------------------------------------

TOKEN_SEPARATORS = " _"
DOCSTART = "-DOCSTART- -X- -X- O"
ANNOTATION_TYPE = "named_entity"
PIECE_TAG = "[X]"
OUTSIDE_TAG = "O"
DEFAULT_POS = "NN"
ENTITY_MARK = "<Entity"

# --- text classification ---------------------------------------------------

HANDLE_OR_URL = "@[A-Za-z0-9_]+|https?://[^ ]+"
WWW = "www.[^ ]+"
NEGATIONS = {
    "isn't": "is not",
    "aren't": "are not",
    "wasn't": "was not",
    "weren't": "were not",
    "haven't": "have not",
    "hasn't": "has not",
    "hadn't": "had not",
    "won't": "will not",
    "wouldn't": "would not",
    "don't": "do not",
    "doesn't": "does not",
    "didn't": "did not",
    "can't": "can not",
    "couldn't": "could not",
    "shouldn't": "should not",
    "mightn't": "might not",
    "mustn't": "must not",
}
NOT_LETTER_OR_BLANK = "[^A-Za-z ]"
MESSAGE_COLUMNS = ("sentiment", "id", "date", "query_string", "user", "text")
VOCABULARY_SIZE = 5460
MIN_DOC_FREQ = 5
MAX_NGRAM = 3
MAX_ITERATIONS = 100

# --- sampling and batching -------------------------------------------------

TRAIN_SHARE = 0.8
VALIDATION_SHARE = 0.2
SPLIT_SEED = 24
MESSAGE_TRAIN_SHARE = 0.99
MESSAGE_SEED = 42
LENGTH_BUCKETS = (5, 10, 20, 50)
