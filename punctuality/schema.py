"""Column names, types and default parameters of the flights table.

Every operator takes its column names as arguments; the values here are only the
defaults, so the same operators serve any table of records with delays and causes.
"""

# The 49 columns of the source file, in file order.
FLIGHT_SCHEMA = """
    airline_id INT, FL_DATE STRING, OP_UNIQUE_CARRIER STRING, OP_CARRIER_FL_NUM STRING,
    ORIGIN_AIRPORT_ID INT, ORIGIN STRING, ORIGIN_CITY_NAME STRING, ORIGIN_STATE_ABR STRING,
    ORIGIN_STATE_FIPS INT, ORIGIN_STATE_NM STRING, ORIGIN_WAC INT,
    DEST_AIRPORT_ID INT, DEST STRING, DEST_CITY_NAME STRING, DEST_STATE_ABR STRING,
    DEST_STATE_FIPS INT, DEST_STATE_NM STRING, DEST_WAC INT,
    CRS_DEP_TIME INT, DEP_TIME INT, DEP_DELAY FLOAT, DEP_DELAY_NEW FLOAT, DEP_DEL15 FLOAT,
    DEP_DELAY_GROUP INT, DEP_TIME_BLK STRING,
    CRS_ARR_TIME INT, ARR_TIME INT, ARR_DELAY FLOAT, ARR_DEL15 FLOAT,
    ARR_DELAY_GROUP INT, ARR_TIME_BLK STRING,
    CANCELLED FLOAT, CANCELLATION_CODE STRING, DIVERTED FLOAT,
    CRS_ELAPSED_TIME FLOAT, ACTUAL_ELAPSED_TIME FLOAT, AIR_TIME FLOAT, FLIGHTS FLOAT,
    DISTANCE FLOAT, DISTANCE_GROUP INT,
    CARRIER_DELAY FLOAT, WEATHER_DELAY FLOAT, NAS_DELAY FLOAT, SECURITY_DELAY FLOAT,
    LATE_AIRCRAFT_DELAY FLOAT,
    DEP_DELAY_OVER15 FLOAT, ARR_DELAY_OVER15 FLOAT, TOTAL_DELAY FLOAT, ANY_DELAY FLOAT
"""

# The columns that the analyses and the model read.
NEEDED_COLUMNS = (
    "CANCELLED", "ARR_DELAY", "DEP_DELAY",
    "OP_UNIQUE_CARRIER", "ORIGIN", "ORIGIN_CITY_NAME", "DEST",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY",
    "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "DISTANCE", "FL_DATE",
)

# What tells one flight from another in the source file.
FLIGHT_KEY = (
    "FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME",
)

# A record lacking any of these is not analysed.
REQUIRED_COLUMNS = ("ARR_DELAY", "DEP_DELAY", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST")

# Measures kept in single precision after cleaning.
FLOAT_MEASURES = ("ARR_DELAY", "DEP_DELAY", "DISTANCE")

# Cause column -> name of its total in the results.
CAUSES = {
    "LATE_AIRCRAFT_DELAY": "Late_Aircraft_Error",
    "CARRIER_DELAY": "Carrier_Error",
    "NAS_DELAY": "NAS_Error",
    "WEATHER_DELAY": "Weather_Error",
    "SECURITY_DELAY": "Security_Error",
}

# Name of a total -> its display name.
CAUSE_LABELS = {
    "Late_Aircraft_Error": "Late Aircraft",
    "Carrier_Error": "Carrier",
    "NAS_Error": "NAS",
    "Weather_Error": "Weather",
    "Security_Error": "Security",
}

ORIGIN_KEYS = ("ORIGIN", "ORIGIN_CITY_NAME")

# Thresholds (both strict) and report sizes.
MIN_FLIGHTS = 50_000
LATE_MINUTES = 15
TOP_K = 10

# Model settings.
SAMPLE_FRACTION = 0.05
SPLIT_WEIGHTS = (0.7, 0.3)
SEED = 42
TREE_DEPTH = 10
