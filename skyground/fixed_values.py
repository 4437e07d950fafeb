"""Thresholds, tables and word lists the results depend on.

All are defaults of operator parameters; change them there, not here.
"""

# Geometry and time
EARTH_RADIUS_M = 6_371_000.0
DEDUP_RADIUS_M = 1_006.0
DEDUP_WINDOW_S = 21_600
JOIN_RADIUS_M = 10_000.0
JOIN_LOOKBACK_S = 172_800
JOIN_LOOKAHEAD_S = 21_600

# Scoring and serving
MIN_FRP_MW = 1.0
FRP_SATURATION_MW = 300.0
SOURCES_SATURATION = 3.0
HIGH_CONFIDENCE = "h"
OTHER_CONFIDENCE_FACTOR = 0.8
TIME_DECAY_H = 54.0
SERVING_MIN_SCORE = 0.002
DISPLAY_SCALE = 1000.0
JITTER_STEP_DEG = 0.001
JITTER_CENTRE_DEG = 0.0045

# Feed rules
LOW_CONFIDENCE = ("l", "low")
GEO_PRECISION_OK = (1, 2)
STRIKE_SUB_TYPES = ("Air/drone strike", "Shelling/artillery/missile attack")
REPORT_EVENT_TYPE = "Explosions/Remote violence"
REPORT_COUNTRIES = (
    "Ukraine", "Russia", "Israel", "Palestine", "Syria", "Iraq", "Yemen", "Lebanon", "Iran",
    "Turkey", "Saudi Arabia", "Jordan", "Kuwait", "Bahrain", "Qatar", "Oman",
    "United Arab Emirates",
)

# Request planning
MAX_DAYS_PER_REQUEST = 5
ARCHIVE_AFTER_DAYS = 10
ARCHIVE_PRODUCTS = ("VIIRS_SNPP_SP", "VIIRS_NOAA20_SP")
RECENT_PRODUCTS = ("VIIRS_SNPP_NRT", "VIIRS_NOAA20_NRT")

# Country boxes (code, min_lat, max_lat, min_lon, max_lon)
COUNTRY_BOXES = (
    ("UP", 44.0, 52.5, 22.0, 40.5),
    ("RS", 41.0, 82.0, 19.0, 180.0),
    ("IS", 29.0, 33.5, 34.0, 36.0),
    ("GZ", 31.2, 31.6, 34.2, 34.6),
    ("WE", 31.3, 32.6, 34.8, 35.6),
    ("SY", 32.5, 37.5, 35.5, 42.5),
    ("IZ", 29.0, 38.0, 38.5, 48.5),
    ("YM", 12.0, 19.0, 42.5, 55.0),
    ("LE", 33.0, 34.7, 35.0, 36.7),
    ("IR", 25.0, 40.0, 44.0, 64.0),
    ("TU", 35.8, 42.5, 25.5, 44.5),
    ("QA", 24.5, 26.5, 50.5, 51.7),
    ("KU", 28.5, 30.2, 46.5, 48.5),
    ("SA", 16.0, 32.0, 34.5, 55.5),
    ("BA", 25.5, 26.5, 50.3, 50.8),
    ("MU", 16.5, 26.5, 52.0, 60.0),
    ("JO", 29.0, 33.5, 34.5, 39.5),
    ("AE", 22.5, 26.0, 51.0, 56.5),
)

# Region boxes (label, west, south, east, north)
REGION_BOXES = (
    ("Eastern Europe / Russia", 19.0, 41.0, 180.0, 82.0),
    ("Middle East", 25.0, 12.0, 64.0, 43.0),
)

# display
COLOUR_HIGH = "#c0392b"
COLOUR_OTHER = "#d68910"
MISSING_TEXT = "—"
SOURCE_SEPARATOR = " · "
RANGE_SEPARATOR = " – "
