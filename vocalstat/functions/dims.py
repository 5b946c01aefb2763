"""Dimension lists and lookup maps.

FIXED VALUES: labels, orders and maps below must equal the published ones
(they fix row/column order of the demographic tables, the reason order, the
domain names and the version/date pairs). Listed in natural order.
"""

NODATA = "nodata"
OTHER = "other"
TOTAL = "TOTAL"

# fixed values: dataset versions and their release dates (parallel lists)
VERSIONS = ["1", "3", "4", "5.1", "6.1", "7.0", "8.0", "9.0", "10.0", "11.0",
            "12.0", "13.0", "14.0", "15.0", "16.1", "17.0", "18.0", "19.0",
            "20.0", "21.0"]
VERSION_DATES = ["2019-02-25", "2019-06-24", "2019-12-10", "2020-06-22",
                 "2020-12-11", "2021-07-21", "2022-01-19", "2022-04-27",
                 "2022-07-04", "2022-09-21", "2022-12-07", "2023-03-09",
                 "2023-06-23", "2023-09-08", "2023-12-06", "2024-03-15",
                 "2024-06-14", "2024-09-13", "2024-12-06", "2025-03-14"]

# fixed values: buckets and splits
MAIN_BUCKETS = ["validated", "invalidated", "other"]
ALL_CLIPS = "clips"
TRAINING_SPLITS = ["train", "dev", "test"]
# fixed values: splitting algorithms, first one labels the text-corpus bucket rows
ALGORITHMS = ["s1", "s5", "s99", "v1", "vw", "vx"]

# fixed values: gender columns, and the newer labels mapped back to them
GENDERS = ["male", "female", "other", NODATA]
GENDERS_EXTENDED = ["male_masculine", "female_feminine", "intersex",
                    "transgender", "non-binary", "do_not_wish_to_say", NODATA]
GENDER_BACKMAP = {
    "male_masculine": "male",
    "female_feminine": "female",
    "intersex": "other",
    "transgender": "other",
    "non-binary": "other",
    "do_not_wish_to_say": "other",
}

# fixed values: age rows
AGES = ["teens", "twenties", "thirties", "fourties", "fifties", "sixties",
        "seventies", "eighties", "nineties", NODATA]

# fixed values: sentence domains (output order) and old-to-current label map
DOMAINS = ["agriculture_food", "automotive_transport", "finance", "general",
           "healthcare", "history_law_government", "language_fundamentals",
           "media_entertainment", "nature_environment", "news_current_affairs",
           "service_retail", "technology_robotics"]
DOMAIN_MAP = {
    "agriculture": "agriculture_food",
    "automotive": "automotive_transport",
    "food_service_retail": "service_retail",
    **{d: d for d in DOMAINS},
}

# fixed values: report reasons kept by name; everything else is OTHER
REPORT_REASONS = ["offensive-language", "grammar-or-spelling",
                  "different-language", "difficult-pronounce"]
REPORT_REASONS_ALL = REPORT_REASONS + [OTHER]

# fixed values: audio quality thresholds
LOW_SNR_THRESHOLD = 0.0
LOW_POWER_THRESHOLD = 1e-06

# fixed values: first version with usable sentence ids; versions without durations
SENTENCE_ID_FROM = "17.0"
NO_DURATION_VERSIONS = ["1"]

# separators used only when arrays are written as text (sinks)
SEP_COL = "#"
SEP_ROW = "|"
SEP_ALGO = "|"


def version_ordinal(ver: str) -> int:
    """Position of a version label in VERSIONS (ordinal compare, never float)."""
    return VERSIONS.index(ver)


def release_dir(ver: str) -> str:
    """Release directory name of a version: early ones carry no date."""
    if ver in ("1", "2", "3"):
        return f"cv-corpus-{ver}"
    return f"cv-corpus-{ver}-{VERSION_DATES[VERSIONS.index(ver)]}"


def version_column(ver: str) -> str:
    """Column name of a version in the support matrix, e.g. ``v16_1``."""
    return "v" + ver.replace(".", "_")

# Version labels of audio specs that were stored as numbers, and their real labels.
SPEC_VERSION_FIX = {
    "5.099999904632568": "5.1", "6.099999904632568": "6.1", "7": "7.0", "8": "8.0", "9": "9.0", "10": "10.0",
    "11": "11.0", "12": "12.0", "13": "13.0", "14": "14.0", "15": "15.0", "16.100000381469727": "16.1",
    "17": "17.0", "18": "18.0", "19": "19.0", "20": "20.0",
}
