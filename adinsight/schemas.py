"""Explicit schemas: nothing in the engine is inferred."""

from pyspark.sql import types as T

MEASURES_RAW = ("impressions", "clicks", "pcconversions", "pvconversions")
MEASURES = ("impressions", "clicks", "conversions")

# Columns every fact table carries for scoping.
_SCOPE_FIELDS = [
    T.StructField("dt", T.DateType()),
    T.StructField("advertiser_id", T.LongType()),
    T.StructField("insertion_order_id", T.LongType()),
    T.StructField("pixel_id", T.LongType()),
]
_MEASURE_FIELDS = [T.StructField(m, T.LongType()) for m in MEASURES_RAW]

PLACEMENT_HOUR = T.StructType(
    _SCOPE_FIELDS
    + [T.StructField("day_hour", T.IntegerType()),
       T.StructField("time_zone_name", T.StringType())]
    + _MEASURE_FIELDS)

INVENTORY = T.StructType(
    _SCOPE_FIELDS + [T.StructField("site_domain", T.StringType())] + _MEASURE_FIELDS)

SYSTEM = T.StructType(
    _SCOPE_FIELDS
    + [T.StructField("device_type", T.StringType()),
       T.StructField("os_name", T.StringType()),
       T.StructField("browser_name", T.StringType()),
       T.StructField("width", T.IntegerType()),
       T.StructField("height", T.IntegerType())]
    + _MEASURE_FIELDS)

GEO = T.StructType(
    _SCOPE_FIELDS
    + [T.StructField("de_city", T.StringType()),
       T.StructField("de_region_name", T.StringType()),
       T.StructField("de_country_name", T.StringType()),
       T.StructField("postal_code", T.StringType())]
    + _MEASURE_FIELDS)

FACT_SCHEMAS = {
    "placement_hour": PLACEMENT_HOUR,
    "inventory": INVENTORY,
    "system": SYSTEM,
    "geo": GEO,
}

# The request control table as it arrives: every cell is text, plus the
# sheet row that keeps the sheet order.
FROM_COL = "From_Date(YYYY-MM-DD)"
TO_COL = "To_Date(YYYY-MM-DD)"
REQUEST_RAW = T.StructType([
    T.StructField("sheet_row", T.IntegerType()),
    T.StructField("Advertiser_ID", T.StringType()),
    T.StructField("Insertion_Order_ID", T.StringType()),
    T.StructField("Conversion_Pixel_ID", T.StringType()),
    T.StructField("Segment_Pixel_ID", T.StringType()),
    T.StructField(FROM_COL, T.StringType()),
    T.StructField(TO_COL, T.StringType()),
    T.StructField("Timezone", T.StringType()),
    T.StructField("Insight_Flag", T.StringType()),
    T.StructField("To_email_address", T.StringType()),
])
