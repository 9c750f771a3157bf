"""The eleven report sheets.

Each function takes its extract (one row per request and grain, complete
cases already applied) and returns the sheet for every request in it:
``request_id``, the sheet's dimensions and the eight metric columns, plus
helper columns starting with ``_`` used only for ordering.  ``finish``
applies the sheet order and drops the helpers.

Every re-aggregation is a plain grouped sum, so rows are summed before they
are shuffled, and every share joins its scope's totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.functions.columns import size_label
from adinsight.operators.extract import resum
from adinsight.operators.labels import (
    keep_days, label_days, label_device_class, label_regions, lower_city)
from adinsight.operators.metrics import METRIC_COLUMNS, with_metrics
from adinsight.sources import dims

# The threshold (in percent) a site's impression share must
# exceed, and the first hour kept on the time-of-day sheets (hours 0-6 are
# left out).
SITE_SHARE_THRESHOLD = 0.01
FIRST_HOUR_EXCLUDED_UPTO = 6

# The sheet names, in report order.
SHEET_NAMES = [
    "TOD_Weekday", "TOD_Weekend", "DOW", "Site_Domains", "Device_type",
    "Device_Os", "Browser", "Creative_Size", "City_Region", "Regions",
    "City_postal_code",
]

SHEET_DIMS = {
    "TOD_Weekday": ["day_hour"],
    "TOD_Weekend": ["day_hour"],
    "DOW": ["day_name"],
    "Site_Domains": ["site_domain"],
    "Device_type": ["device_types"],
    "Device_Os": ["device_types", "os_name"],
    "Browser": ["device_types", "browser_name"],
    "Creative_Size": ["size"],
    "City_Region": ["city", "regions", "region_code"],
    "Regions": ["regions", "region_code"],
    "City_postal_code": ["city", "regions", "region_code", "postal_code"],
}


# The order of every sheet, once: ascending keys, numbers before texts.  Shares
# sort descending through their negative.
_SHARE_DOWN = "-Percentage_Impression_share"
SHEET_ORDERS: dict[str, tuple[list[str], list[str]]] = {
    "TOD_Weekday": (["day_hour"], []),
    "TOD_Weekend": (["day_hour"], []),
    "DOW": (["_day_order"], []),
    "Site_Domains": ([_SHARE_DOWN], ["site_domain"]),
    "Device_type": ([], ["device_types"]),
    "Device_Os": ([], ["device_types", "os_name"]),
    "Browser": ([], ["device_types", "browser_name"]),
    "Creative_Size": (["_width", "_height"], []),
    "City_Region": ([_SHARE_DOWN], ["city", "regions", "region_code"]),
    "Regions": ([], ["region_code"]),
    "City_postal_code": ([_SHARE_DOWN], ["city", "regions", "region_code", "postal_code"]),
}
_NUMBERS, _TEXTS = 2, 4  # the most of either kind that any sheet has
SORT_COLUMNS = [f"_o{i + 1}" for i in range(_NUMBERS + _TEXTS)]


def sort_keys(name: str) -> list[str]:
    """The sheet's order as SQL expressions of the shared ``SORT_COLUMNS`` (unused ones null).

    Every sheet of a report can thus be numbered in one sort by ranges of the
    same columns that ``finish`` orders a single sheet by.
    """
    numbers, texts = SHEET_ORDERS[name]
    slots = [(numbers[i] if i < len(numbers) else "NULL", "double") for i in range(_NUMBERS)]
    slots += [(texts[i] if i < len(texts) else "NULL", "string") for i in range(_TEXTS)]
    return [f"CAST({e} AS {t}) AS {c}" for (e, t), c in zip(slots, SORT_COLUMNS)]


def sheet_columns(name: str) -> list[str]:
    return ["request_id", *SHEET_DIMS[name], *METRIC_COLUMNS]


def finish(sheet: DataFrame, name: str, order: bool = True) -> DataFrame:
    """Order rows (request, then the sheet order) and drop helper columns."""
    if order:
        sheet = sheet.selectExpr("*", *sort_keys(name)).orderBy("request_id", *SORT_COLUMNS)
    return sheet.select(*sheet_columns(name))


def _resummed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy("request_id", *keys).agg(*resum())


# --- time of day / day of week (one extract: request, day_hour, dw) --------

def _tod(tod: DataFrame, days: list[str]) -> DataFrame:
    hours = label_days(tod).filter(F.col("day_hour") > FIRST_HOUR_EXCLUDED_UPTO)
    return with_metrics(_resummed(keep_days(hours, days), ["day_hour"]), ["day_hour"])


def tod_weekday(tod: DataFrame) -> DataFrame:
    """Hours 7-23 on Monday-Friday."""
    return _tod(tod, dims.WEEKDAYS)


def tod_weekend(tod: DataFrame) -> DataFrame:
    """R2: hours 7-23 on Saturday and Sunday."""
    return _tod(tod, dims.WEEKEND)


def dow(tod: DataFrame) -> DataFrame:
    """Day of week, all hours."""
    g = _resummed(label_days(tod), ["day_name", "day_order"])
    return with_metrics(g, ["day_name"], extra=["day_order AS _day_order"])


# --- site domains -----------------------------------------------------------

def site_domains(site: DataFrame) -> DataFrame:
    """Shares over all domains, then only domains above the threshold."""
    m = with_metrics(site, ["site_domain"])
    return m.filter(F.col("Percentage_Impression_share") > SITE_SHARE_THRESHOLD)


# --- system: device, OS, browser, creative size -----------------------------

def device_type(device: DataFrame) -> DataFrame:
    """Device class."""
    return with_metrics(_resummed(label_device_class(device), ["device_types"]), ["device_types"])


def _within_class(ext: DataFrame, dim: str) -> DataFrame:
    g = _resummed(label_device_class(ext), ["device_types", dim])
    return with_metrics(g, ["device_types", dim], share_by=("request_id", "device_types"))


def device_os(os_ext: DataFrame) -> DataFrame:
    """Device class and OS; shares within each device class."""
    return _within_class(os_ext, "os_name")


def browser(browser_ext: DataFrame) -> DataFrame:
    """Device class and browser; shares within each device class."""
    return _within_class(browser_ext, "browser_name")


def creative_size(size: DataFrame) -> DataFrame:
    """Creative size label ``<width>x<height>``."""
    s = size.withColumn("size", size_label("width", "height"))
    return with_metrics(s, ["size"], extra=["width AS _width", "height AS _height"])


# --- geo: city / region / postcode (extracts carry the request timezone) ----

def _geo(ext: DataFrame, keys: list[str]) -> DataFrame:
    g = _resummed(label_regions(lower_city(ext)), keys)
    m = with_metrics(g, keys, totals_from=ext)
    # Unmapped regions count in the shares and are dropped afterwards.
    return m.filter(F.col("city").isNotNull() & F.col("regions").isNotNull())


def city_region(city: DataFrame) -> DataFrame:
    """City and region; shares include unmapped regions."""
    return _geo(city, ["city", "regions", "region_code"])


def regions(city: DataFrame) -> DataFrame:
    """Region; unmapped regions dropped before the shares."""
    labelled = label_regions(city).filter(F.col("regions").isNotNull())
    return with_metrics(_resummed(labelled, ["regions", "region_code"]), ["regions", "region_code"])


def city_postcode(postcode: DataFrame) -> DataFrame:
    """City, region and postcode; shares include unmapped regions."""
    return _geo(postcode, ["city", "regions", "region_code", "postal_code"])
