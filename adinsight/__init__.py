"""Campaign insight reports on Spark.

Report requests (advertiser, optional insertion orders and conversion pixels,
date range, time zone) are scoped against delivery fact tables, aggregated and
labelled for every pending request in one Spark job, producing eleven report
sheets.  Everything is DataFrame code; there are no UDFs.
"""

from adinsight.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
