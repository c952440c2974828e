"""Thresholds, labels, word lists, patterns and lookup tables."""

# Magnitude ladder (upper bound exclusive, label).
MAGNITUDE_STEPS = [
    (2.0, "micro"),
    (4.0, "minor"),
    (5.0, "light"),
    (6.0, "moderate"),
    (7.0, "strong"),
    (8.0, "major"),
]
MAGNITUDE_TOP = "great"
UNKNOWN = "unknown"

# Latitude bands.
POLAR_LATITUDE = 60.0
TROPIC_LATITUDE = 23.5
BAND_ARCTIC = "Arctic"
BAND_ANTARCTIC = "Antarctic"
BAND_NORTH = "Northern Temperate"
BAND_TROPICAL = "Tropical"
BAND_SOUTH = "Southern Temperate"
BAND_UNKNOWN = "Unknown"

# Title keywords by severity, first match wins.
TITLE_SEVERITY = [
    ("major", ["major", "large"]),
    ("minor", ["minor", "small"]),
    ("moderate", ["moderate"]),
]

# Words that mark a volcano title as relevant.
ERUPTION_WORDS = ["eruption", "volcanic", "volcano"]

# Indicator value and year categories.
VALUE_STEPS = [(100.0, "Low"), (1000.0, "Medium")]
VALUE_NEGATIVE = "Negative"
VALUE_ZERO = "Zero"
VALUE_TOP = "High"
YEAR_STEPS = [(2018, "Early Period"), (2021, "Mid Period")]
YEAR_TOP = "Recent Period"
FIRST_YEAR = 2015
LAST_YEAR = 2025

# Quality flags.
FLAG_MISSING = "Missing Value"
FLAG_NEGATIVE = "Negative Value"
FLAG_NO_INDICATOR = "Missing Indicator"
FLAG_VALID = "Valid"
QUALITY_SCORE = 0.95
PIPELINE_VERSION = "1.0"
INDICATOR_SOURCE = "world_bank_api"
DEFAULT_SOURCE = "World Bank"
OTHER_CATEGORY = "Other"

# Requested entities and indicators.
ENTITIES = ["MX", "ID", "GR", "TR", "CN", "JP", "US", "CL", "RU", "IN"]
INDICATOR_LABELS = {
    "NY.GDP.MKTP.CD": "GDP (current US$)",
    "NY.GDP.MKTP.KD.ZG": "GDP Growth (annual %)",
    "FP.CPI.TOTL.ZG": "Inflation, Consumer Prices (annual %)",
    "EN.POP.DNST": "Population Density",
}
INDICATOR_CATEGORIES = {
    "NY.GDP.MKTP.CD": "Economic",
    "NY.GDP.MKTP.KD.ZG": "Economic",
    "FP.CPI.TOTL.ZG": "Economic",
    "EN.POP.DNST": "Demographic",
}

# Country names for the batch panel, and the wider set used by the map.
COUNTRY_NAMES = {
    "AF": "Afghanistan",
    "AR": "Argentina",
    "CL": "Chile",
    "CN": "China",
    "GR": "Greece",
    "HN": "Honduras",
    "ID": "Indonesia",
    "IN": "India",
    "IR": "Iran",
    "JP": "Japan",
    "MX": "Mexico",
    "NI": "Nicaragua",
    "NP": "Nepal",
    "PH": "Philippines",
    "PK": "Pakistan",
    "RU": "Russia",
    "TJ": "Tajikistan",
    "TO": "Tonga",
    "TR": "Turkey",
    "US": "United States",
}
MAP_COUNTRY_NAMES = {
    **COUNTRY_NAMES,
    "AU": "Australia",
    "BR": "Brazil",
    "CA": "Canada",
    "DE": "Germany",
    "FR": "France",
    "GB": "United Kingdom",
    "IT": "Italy",
    "KR": "South Korea",
    "SA": "Saudi Arabia",
    "ZA": "South Africa",
}

# Case-insensitive name patterns of aggregates and of the regions offered.
# "states" and "Africa" also match United States and South Africa; that is intended parity.
AGGREGATE_PATTERN = (
    "Africa|Asia|Europe|America|Caribbean|Pacific|World|income|dividend|states|area|"
    "Union|IDA|IBRD|HIPC|fragile|conflict"
)
IMPORTANT_PATTERN = (
    "World|European Union|Euro area|Arab World|East Asia|South Asia|"
    "Sub-Saharan Africa|Latin America"
)
ALL_CODE = "ALL"
ALL_LABEL = "All Countries"
REGION_SUFFIX = " (Region)"

# Map styles. The severity words differ from the magnitude ladder's.
SEVERITY_SIZE = {"low": 8, "moderate": 15, "high": 22, "critical": 30, "unknown": 12}
SEVERITY_SIZE_DEFAULT = 12
SEVERITY_COLOUR = {
    "critical": "#800000",
    "high": "#cc0000",
    "medium": "#ff6600",
    "low": "#00ff00",
    "unknown": "#cccccc",
}
SEVERITY_COLOUR_DEFAULT = "#cccccc"
# Age in minutes (upper bound inclusive) and marker colour.
RECENCY_STEPS = [(10, "#ff0000"), (30, "#ff6600"), (60, "#ff9900")]
RECENCY_TOP = "#00ff00"
QUAKE_OPACITY = 0.7
VOLCANO_SIZE = 12
VOLCANO_COLOUR = "#FF8C00"
VOLCANO_OPACITY = 0.8
HIGHLIGHT_MAGNITUDE = 5.0

# Feed and snapshot settings.
FEED_HOURS = 24
FEED_MIN_MAGNITUDE = 2.5
RECENT_EVENTS = 20
FIRST_ENTITIES = 20
SNAPSHOTS_KEPT = 5
RETENTION_HOURS = 168
POLL_INTERVAL = "5 minutes"
RETRY_SECONDS = 60
