"""Fixed lookup tables used to label report rows.

Every table here is a literal with a known, small row count, so broadcasting
it is always safe.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adinsight.sources.local import local_table

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference report's lookups exactly
# (matching is case-sensitive).
# ---------------------------------------------------------------------------

# Day of week, 0 = Sunday.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# Report order of days.
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
WEEKEND = ["Saturday", "Sunday"]

# Raw device type -> device class.
DEVICE_CLASSES = [
    ("pc & other devices", "pc"),
    ("pc or unknown", "pc"),
    ("pc", "pc"),
    ("mobile", "phone"),
    ("phone", "phone"),
    ("Phone", "phone"),
    ("tablet", "tablet"),
    ("Tablet", "tablet"),
]

# Country spellings kept for a request's time zone (geo reports only).
COUNTRIES = [
    ("AEST", "australia"),
    ("AEST", "AU"),
    ("AEST", "Australia"),
    ("NZST", "new zealand"),
    ("NZST", "NZ"),
    ("NZST", "New Zealand"),
]

# Australia: region spelling -> short name (lower case and title case).
AU_REGIONS = [
    ("australian capital territory", "ACT"),
    ("new south wales", "NSW"),
    ("northern territory", "NT"),
    ("queensland", "QLD"),
    ("south australia", "SA"),
    ("tasmania", "TAS"),
    ("victoria", "VIC"),
    ("western australia", "WA"),
    ("Australian Capital Territory", "ACT"),
    ("New South Wales", "NSW"),
    ("Northern Territory", "NT"),
    ("Queensland", "QLD"),
    ("South Australia", "SA"),
    ("Tasmania", "TAS"),
    ("Victoria", "VIC"),
    ("Western Australia", "WA"),
]
AU_CODES = [
    ("ACT", "01"), ("NSW", "02"), ("NT", "03"), ("QLD", "04"),
    ("SA", "05"), ("TAS", "06"), ("VIC", "07"), ("WA", "08"),
]

# New Zealand: lower-cased region -> display name.
NZ_REGIONS = [
    ("northland", "Northland"),
    ("auckland", "Auckland"),
    ("waikato", "Waikato"),
    ("bay of plenty", "Bay Of Plenty"),
    ("gisborne", "Gisborne"),
    ("hawkes bay", "Hawke's Bay"),
    ("hawke's bay", "Hawke's Bay"),
    ("taranaki", "Taranaki"),
    ("manawatu-wanganui", "Manawatu-Wanganui"),
    ("wellington", "Wellington"),
    ("tasman", "Tasman"),
    ("nelson", "Nelson"),
    ("marlborough", "Marlborough"),
    ("west coast", "West Coast"),
    ("canterbury", "Canterbury"),
    ("otago", "Otago"),
    ("southland", "Southland"),
]
NZ_CODES = [
    ("Northland", "01"), ("Auckland", "02"), ("Waikato", "03"),
    ("Bay Of Plenty", "04"), ("Gisborne", "05"), ("Hawke's Bay", "06"),
    ("Taranaki", "07"), ("Manawatu-Wanganui", "08"), ("Wellington", "09"),
    ("Tasman", "10"), ("Nelson", "11"), ("Marlborough", "12"),
    ("West Coast", "13"), ("Canterbury", "14"), ("Otago", "15"),
    ("Southland", "16"),
]

# Time zones whose region names are lower-cased before the lookup.
LOWERCASE_REGION_ZONES = ["NZST"]

# ---------------------------------------------------------------------------


_LOCK = threading.RLock()


def _cached(spark: SparkSession, key, build) -> DataFrame:
    """Lookup frames are immutable literals: build each once per session."""
    with _LOCK:
        cache = spark.__dict__.setdefault("_adinsight_lookups", {})
        if key not in cache:
            cache[key] = build()
        return cache[key]


def days(spark: SparkSession) -> DataFrame:
    return _cached(spark, "days", lambda: _build_days(spark))


def _build_days(spark: SparkSession) -> DataFrame:
    """``dw`` (0 = Sunday) -> ``day_name``, ``day_order`` (Monday = 1)."""
    rows = [(i, name, DAY_ORDER.index(name) + 1) for i, name in enumerate(DAY_NAMES)]
    schema = T.StructType([
        T.StructField("dw", T.IntegerType(), False),
        T.StructField("day_name", T.StringType(), False),
        T.StructField("day_order", T.IntegerType(), False),
    ])
    return local_table(spark, rows, schema)


def day_set(spark: SparkSession, names: list[str]) -> DataFrame:
    return _cached(spark, ("day_set", tuple(names)), lambda: _build_day_set(spark, names))


def _build_day_set(spark: SparkSession, names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("day_name", T.StringType(), False)])
    return local_table(spark, [(n,) for n in names], schema)


def device_classes(spark: SparkSession) -> DataFrame:
    return _cached(spark, "device_classes", lambda: _build_device_classes(spark))


def _build_device_classes(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("device_type", T.StringType(), False),
        T.StructField("device_types", T.StringType(), False),
    ])
    return local_table(spark, DEVICE_CLASSES, schema)


def countries(spark: SparkSession) -> DataFrame:
    return _cached(spark, "countries", lambda: _build_countries(spark))


def _build_countries(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("timezone", T.StringType(), False),
        T.StructField("de_country_name", T.StringType(), False),
    ])
    return local_table(spark, COUNTRIES, schema)


def region_codes(spark: SparkSession) -> DataFrame:
    return _cached(spark, "region_codes", lambda: _build_region_codes(spark))


def _build_region_codes(spark: SparkSession) -> DataFrame:
    """(timezone, region_key) -> (regions, region_code), both countries.

    The two-step lookup of the reports (spelling -> name -> code) is folded
    into one table.  ``region_key`` is the raw region for AEST and the
    lower-cased region for NZST (see ``LOWERCASE_REGION_ZONES``).
    """
    au_code = dict(AU_CODES)
    nz_code = dict(NZ_CODES)
    rows = [("AEST", k, v, au_code[v]) for k, v in AU_REGIONS]
    rows += [("NZST", k, v, nz_code[v]) for k, v in NZ_REGIONS]
    schema = T.StructType([
        T.StructField("timezone", T.StringType(), False),
        T.StructField("region_key", T.StringType(), False),
        T.StructField("regions", T.StringType(), False),
        T.StructField("region_code", T.StringType(), False),
    ])
    return local_table(spark, rows, schema)


def lookup(df: DataFrame) -> DataFrame:
    """Broadcast hint for a fixed lookup (row count known, tens of rows)."""
    return F.broadcast(df)
