"""The request control table: read, parse, select pending, claim.

One row per report request.  Every step is a DataFrame transform so any
number of requests can be served in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight import schemas
from adinsight.functions.columns import id_list, missing_to_null
from adinsight.operators.rownum import number_rows

# The flag text that marks a pending request (substring,
# case-sensitive) and the text written back once a request is served.
PENDING_MARK = "Yes"
CLAIMED_FLAG = "No"


def read_requests(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A request table from outside, columns found by name.

    A text table is read by its header, cells with line breaks included: every
    column but ``sheet_row`` must be there and no other may be.  Without
    ``sheet_row`` (an exported sheet) rows are numbered in file order from 1.
    """
    names = schemas.REQUEST_RAW.fieldNames()
    if fmt == "csv":
        # Line breaks in cells: a file is read in one piece, as a sheet's size allows.
        raw = (spark.read.option("header", True).option("enforceSchema", False)
               .option("multiLine", True).option("escape", '"').csv(path))
    else:
        raw = spark.read.format(fmt).load(path)
    unknown = [c for c in raw.columns if c not in names]
    missing = [c for c in names[1:] if c not in raw.columns]
    if unknown or missing:
        raise ValueError(f"request table {path}: unknown columns {unknown}, missing columns {missing}")
    if "sheet_row" not in raw.columns:
        raw = number_rows(raw.withColumn("_place", F.monotonically_increasing_id()).withColumn("_table", F.lit(0)),
                          ["_table"], [F.col("_place")], "sheet_row")
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schemas.REQUEST_RAW])


def check_identity(raw: DataFrame) -> None:
    """Fail if a request has no ``sheet_row`` or shares it with another.

    Reports, mails and claims go by this number, so two requests under one
    would receive each other's figures.
    """
    bad = raw.groupBy("sheet_row").agg(F.count(F.lit(1)).alias("n")) \
             .filter("n > 1 OR sheet_row IS NULL").limit(10).collect()
    if bad:
        raise ValueError(f"request rows without a number of their own: {sorted(str(r['sheet_row']) for r in bad)}")


def is_pending(flag: str = "Insight_Flag"):
    """Flag contains the pending mark; NULL counts as not pending."""
    return F.coalesce(F.col(flag).contains(PENDING_MARK), F.lit(False))


def parse_requests(raw: DataFrame) -> DataFrame:
    """Typed request rows.

    ``advertiser_ids`` etc. are distinct ``ARRAY<BIGINT>``; NULL means the
    parameter was not given (no filter); ``advertiser_list`` and the other
    ``_list`` columns keep repeats, for the report's name and mail.  Dates are inclusive.  A request
    without a usable advertiser list or date range gets ``status = invalid``
    and matches no fact row.
    """
    from_dt = F.try_to_date(missing_to_null(schemas.FROM_COL), "yyyy-MM-dd")
    to_dt = F.try_to_date(missing_to_null(schemas.TO_COL), "yyyy-MM-dd")
    adv = id_list("Advertiser_ID")
    parsed = raw.select(
        F.col("sheet_row").cast("bigint").alias("request_id"),
        F.col("sheet_row"),
        adv.alias("advertiser_ids"),
        id_list("Insertion_Order_ID").alias("io_ids"),
        id_list("Conversion_Pixel_ID").alias("conv_pixel_ids"),
        id_list("Segment_Pixel_ID").alias("seg_pixel_ids"),
        id_list("Advertiser_ID", distinct=False).alias("advertiser_list"),
        id_list("Insertion_Order_ID", distinct=False).alias("io_list"),
        id_list("Conversion_Pixel_ID", distinct=False).alias("conv_pixel_list"),
        id_list("Segment_Pixel_ID", distinct=False).alias("seg_pixel_list"),
        from_dt.alias("from_dt"),
        to_dt.alias("to_dt"),
        missing_to_null("Timezone").alias("timezone"),
        F.col("Insight_Flag").alias("flag"),
        is_pending().alias("pending"),
        F.trim(F.col("To_email_address")).alias("to_email"),
    )
    valid = (F.coalesce(F.size("advertiser_ids") > 0, F.lit(False))
             & F.col("from_dt").isNotNull() & F.col("to_dt").isNotNull())
    return parsed.withColumn(
        "status", F.when(valid, F.lit("ok")).otherwise(F.lit("invalid")))


def pending(parsed: DataFrame) -> DataFrame:
    """Requests waiting to be served."""
    return parsed.filter(F.col("pending"))


def first_only(parsed_pending: DataFrame) -> DataFrame:
    """Only the earliest pending request in sheet order (one per run)."""
    return parsed_pending.orderBy("sheet_row").limit(1)


def claim(raw: DataFrame, served: DataFrame) -> DataFrame:
    """New version of the control table with served rows flagged done.

    ``served`` holds ``request_id`` of requests whose report was written.  The
    result keeps every row and column of ``raw``; only the flag changes.
    """
    done = served.select(F.col("request_id").alias("_served")).distinct()
    joined = raw.join(done, raw["sheet_row"].cast("bigint") == done["_served"], "left")
    return joined.select(*[
        F.when(F.col("_served").isNotNull(), F.lit(CLAIMED_FLAG))
         .otherwise(F.col("Insight_Flag")).alias("Insight_Flag")
        if c == "Insight_Flag" else F.col(c)
        for c in raw.columns
    ])
