"""The request fixture used by tests, the bench and the registered queries.

Control-table rows covering the request semantics: id lists with pipes,
optional insertion orders and pixels, AU / NZ / other time zones, a repeated
advertiser id, a missing advertiser and three rows that are not pending.  Three
requests, one per time zone, take every advertiser over every date, so that
every row of every fact flows through the operators (geo rows of countries
without a zone aside); the first of them comes first, so the one-request mode
finds rows in all four facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adinsight import schemas
from adinsight.sources.local import local_table

# (sheet_row, Advertiser_ID, Insertion_Order_ID, Conversion_Pixel_ID,
#  Segment_Pixel_ID, From, To, Timezone, Insight_Flag, To_email_address)
REQUEST_ROWS = [
    (0, "0|1|2|3|4|5|6|7|8|9", "NA", "NA", "NA", "1990-01-01", "2030-12-31", "AEST", "Yes", "q0@example.com"),
    (1, "1|2", "NA", "1", "NA", "2024-01-03", "2024-01-25", "AEST", "Yes", "q1@example.com"),
    (2, "3|4|5", "3|13|14", "NA", "7", "2024-01-01", "2024-01-31", "NZST", "Yes", "q2@example.com"),
    (3, "1|2", "NA", "1", "NA", "1996-01-01", "1999-12-31", "AEST", "Yes", "q3@example.com"),
    (4, "3", "3|8|13", "NA", "NA", "1995-01-01", "2001-12-31", "NZST", "Yes, urgent", "q4@example.com"),
    (5, "1", "NA", "NA", "NA", "1995-01-01", "2001-12-31", "UTC", "Yes", "q5@example.com"),
    (6, "1|1", "NA", "NA", "NA", "1995-01-01", "2001-12-31", "AEST", "Yes", "q6@example.com"),
    (7, "NA", "NA", "NA", "NA", "1995-01-01", "2001-12-31", "AEST", "Yes", "q7@example.com"),
    (8, "2", "NA", "NA", "NA", "1995-01-01", "2001-12-31", "AEST", "No", "q8@example.com"),
    (9, "2", "NA", "NA", "NA", "1995-01-01", "2001-12-31", "AEST", "yes", "q9@example.com"),
    (10, "2", "NA", "NA", "NA", "1995-01-01", "2001-12-31", "AEST", None, "q10@example.com"),
    (11, "0|1|2|3|4|5|6|7|8|9", "NA", "NA", "NA", "1990-01-01", "2030-12-31", "NZST", "Yes", "q11@example.com"),
    (12, "0|1|2|3|4|5|6|7|8|9", "NA", "NA", "NA", "1990-01-01", "2030-12-31", "UTC", "Yes", "q12@example.com"),
]


def request_table(spark: SparkSession, rows=None) -> DataFrame:
    return local_table(spark, rows if rows is not None else REQUEST_ROWS, schemas.REQUEST_RAW)
