"""Column expressions.  Every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a cell holding this text means "no value" (the request sheet
# writes missing cells as NA).
MISSING = "NA"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: str | Column) -> Column:
    """Trimmed text, NULL when empty or ``NA``."""
    t = F.trim(_col(c))
    return F.when((t == F.lit("")) | (t == F.lit(MISSING)), F.lit(None)).otherwise(t)


def id_list(c: str | Column, distinct: bool = True) -> Column:
    """Pipe- or comma-separated id text -> distinct ``ARRAY<BIGINT>``.

    NULL / NA stays NULL ("no filter").  Tokens that are not integers are
    dropped, so a list of only bad tokens becomes an empty array, which
    matches nothing.  Duplicates are removed (the list is a set test) unless ``distinct``
    is off.
    """
    text = missing_to_null(c)
    tokens = F.split(F.regexp_replace(text, r"\|", ","), ",")
    ids = F.transform(tokens, lambda t: F.trim(t).try_cast("bigint"))
    ids = F.filter(ids, lambda x: x.isNotNull())
    return F.array_distinct(ids) if distinct else ids


def ratio_sql(num: str, den: str) -> str:
    """SQL text of ``num * 100 / den`` in percent, 0 when ``den`` is 0.

    The product stays integral and exact; one division in double follows.
    """
    return (f"CASE WHEN {den} = 0 THEN CAST(0 AS DOUBLE) "
            f"ELSE ({num} * 100) / CAST({den} AS DOUBLE) END")


def size_label(width: str | Column, height: str | Column) -> Column:
    """Creative size label ``<width>x<height>``."""
    return F.concat(_col(width).cast("string"), F.lit("x"), _col(height).cast("string"))


def day_of_week(dt: str | Column) -> Column:
    """Day of week with 0 = Sunday (Spark's ``dayofweek`` has 1 = Sunday)."""
    return (F.dayofweek(_col(dt)) - 1).cast("int")
