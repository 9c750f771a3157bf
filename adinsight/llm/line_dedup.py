"""Line dedup by distinct-site spread: HyperLogLog sketches per line, exact counts near the threshold.

A line that occurs on ``min_sites`` sites or more is boilerplate; every
occurrence but the first goes.  Each line hash gets a HyperLogLog sketch of its
sites; sketches merge by aggregation, so a line found on every page is one
sketch per task before the shuffle.  Where the estimate is too near the
threshold to trust, the sites of the line are counted exactly.

Only DataFrame functions are used.

Defined results: lines are compared without blanks at their ends, and blank
lines are never removed; a row without a site (null) adds none; a null text
stays null and an empty one empty; the first occurrence is that of the smallest
(doc_id, text hash, line number), nulls last, and equal rows both count as
first; a document may lose all its lines and is kept with an empty text; an
empty table gives an empty result; all other columns are carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sites from which a line is boilerplate.
MIN_SITES = 10
#: log2 of the registers of a sketch.
LG_K = 10
#: An estimate this many standard errors from the threshold is trusted.
ERRORS = 4
#: Shares that the rows of one line are dealt into when they meet the boilerplate lines.
SALTS = 16
BLANKS = " \t\r\x0b\x0c"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """``doc, site, pos, line``: one row per line with a word; ``line`` is its hash."""
    return (docs.select(_doc_key().alias("doc"), F.col(site).cast("string").alias("site"),
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .withColumn("line", _bare("line")).filter("line <> ''")
            .withColumn("line", F.xxhash64("line")))


def _doc_key() -> Column:
    """What rows are told apart by; sorts nulls last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("id"),
                    F.xxhash64("text").alias("text"))


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """``line`` (hash) of every line on at least ``min_sites`` distinct sites."""
    lines = _lines(docs, site).filter("site IS NOT NULL")
    spread = ERRORS * 1.04 / (1 << LG_K) ** 0.5
    sketched = (lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
                .select("line", F.hll_sketch_estimate("sketch").alias("sites"))
                .filter(F.col("sites") >= min_sites * (1 - spread)))
    sure = sketched.filter(F.col("sites") > min_sites * (1 + spread)).select("line")
    near = sketched.filter(F.col("sites") <= min_sites * (1 + spread)).select("line")
    # At most one row per line and site meets the near lines.
    exact = (lines.select("line", "site").distinct().join(near, "line", "left_semi")
             .groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites).select("line"))
    return sure.unionByName(exact)


def remove_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """``docs`` (doc_id, text, ``site`` and others) without repeats of boilerplate lines.

    Adds ``n_lines`` and ``n_removed`` in place of columns of these names.
    """
    lines = _lines(docs, site).select("line", "doc", "pos").withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))

    def met(few: DataFrame) -> DataFrame:
        """Lines in ``few`` (one row a line), dealt by salt as well: a line may be in every document."""
        return lines.join(few.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)]))),
                          ["line", "salt"])

    first = (met(spread_lines(docs, min_sites, site)).groupBy("line", "salt").agg(F.min(F.struct("doc", "pos")).alias("first"))
             .groupBy("line").agg(F.min("first").alias("first")))
    removed = (met(first)
               .filter(~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("pos") == F.col("first.pos"))))
               .groupBy("doc").agg(F.collect_list("pos").alias("removed")).withColumnRenamed("doc", "key"))

    carried = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), _doc_key().alias("doc"),
                       F.split("text", "\n").alias("lines"))
    joined = rows.join(removed, rows["doc"].eqNullSafe(removed["key"]), "left")
    all_at = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1))
    # ``lines`` is a column of the join here, so taking one by its place is cheap.
    kept = F.transform(F.array_except(all_at, "removed"), lambda p: F.get("lines", p))
    out = {c: F.col("row").getField(c).alias(c) for c in carried}
    out["text"] = F.array_join(F.when(F.col("removed").isNull(), F.col("lines")).otherwise(kept), "\n").alias("text")
    return joined.select(
        *[out[c] for c in docs.columns if c in out],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
