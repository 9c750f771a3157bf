"""Small literal tables as local relations.

``spark.sql`` with an inline ``VALUES`` list and bound parameters gives a
``LocalTableScan``: the rows live in the plan, the optimizer knows their exact
size, and broadcasting them needs no Spark job.  Used for the fixed lookups
and control-table fixtures only.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Parameter binding of ``spark.sql`` is not relied on to be thread-safe: all
# literal tables are created under one lock.
_LOCK = threading.RLock()


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    with _LOCK:
        return _local_table(spark, rows, schema)


def _local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    names = schema.fieldNames()
    if not rows:
        return spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    args: dict[str, object] = {}
    tuples = []
    for i, row in enumerate(rows):
        cells = []
        for j, (v, f) in enumerate(zip(row, schema.fields)):
            t = f.dataType.simpleString()
            if v is None:
                cells.append(f"CAST(NULL AS {t})")
            else:
                key = f"p{i}_{j}"
                args[key] = v
                cells.append(f"CAST(:{key} AS {t})")
        tuples.append("(" + ", ".join(cells) + ")")
    cols = ", ".join(f"`{n}`" for n in names)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(tuples)} AS t({cols})", args=args)
