"""Scoping: which fact rows belong to which request.

``scope`` gives the fact rows of each request, ``request_sums`` their sums at a
grain.  All requests are matched in one equi-join on the advertiser id.

**Overlapping requests.**  ``request_sums`` cuts the requested days into disjoint
segments at every date on which a request begins or ends, and sums the fact once
per (advertiser, insertion order, pixel, zone, segment, grain) before any request
is joined.  Requests never cut through a segment, so the sums of the segments
they cover are exactly theirs: N requests for the same rows read and sum these
rows once.  Columns that no request filters by are not part of the key.

**Ahead of the join** a fact row passes: the smallest and largest advertiser id
and the requested days as intervals (pushed into the scan), a join with the
calendar of requested days (which prunes the partitions of a fact stored by
``dt``), and a Bloom filter of the requested advertiser ids.  The joins that
follow stay the exact test.

**Join choice by counted rows.**  The sizes of all request-side tables are counted
when the bounds are made; a table is broadcast if its rows fit under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise joined by sorting both
sides, where adaptive execution splits an advertiser that holds a large part of
the facts.  Estimates from compressed files play no part.  Calendar and Bloom
filter are left out where they may not be broadcast: they only narrow the scan.

**Tasks by counted rows.**  A sum meets several requests, so the join gives more
groups than a task that is sized by the bytes it reads should hold.  The sums are
therefore dealt to tasks by their keys, one for every ``TASK_ROWS`` rows of the
fact that they may have come from.

**Optional id lists** are bitmaps: one long for each request and 64 consecutive
ids, of which the bit of an id is tested.  Requests with and without a list are
matched apart, so a batch without lists has no such join.  Before the sums, ids
that the same requests list become one class, and those in no list none, so an id
column adds to the key only what the requests tell apart.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adinsight.operators.extract import measure_sums, resum
from adinsight.operators.snapshot import Scratch, snapshot
from adinsight.sources import dims

# The scan filter holds at most this many date intervals; beyond it those with
# the shortest gaps are merged, which only widens what is read.
MAX_INTERVALS = 64

# Bytes that a row of a broadcast relation takes in memory, counted generously:
# request keys; list words, calendar days and filter words.
KEY_BYTES, WORD_BYTES = 128, 48

# Bloom filter: the fewest and the most words of 64 bits, the ids a word is
# meant for, and the bits an id sets in its word.
FILTER_WORDS_LEAST, FILTER_WORDS_MOST = 1 << 10, 1 << 20
FILTER_IDS_PER_WORD, FILTER_BITS = 4, 4

# Fact rows whose sums, if none of them meet, one task joins to the requests.  A shuffle
# into more than 200 tasks (spark.shuffle.sort.bypassMergeThreshold) sorts its rows in
# memory, on top of the sums they come from; at this size that begins at 400 million rows.
TASK_ROWS = 2_000_000

# A block of ids that no list holds: where a null id is looked up.
NO_BLOCK = -(1 << 63)


# --- the request side ---------------------------------------------------------

def valid(requests: DataFrame) -> DataFrame:
    return requests.filter("status = 'ok'")


def request_keys(requests: DataFrame) -> DataFrame:
    """One row per (valid request, distinct advertiser id), without lists."""
    return valid(requests).select(
        F.col("request_id").alias("r_request_id"),
        F.explode(F.array_distinct("advertiser_ids")).alias("r_advertiser_id"),
        F.col("from_dt").alias("r_from_dt"),
        F.col("to_dt").alias("r_to_dt"),
        F.col("timezone").alias("r_timezone"),
        F.col("io_ids").isNotNull().alias("r_has_io"),
        F.col("conv_pixel_ids").isNotNull().alias("r_has_pixel"),
    )


def list_ids(requests: DataFrame, column: str, *always: int) -> DataFrame:
    """(request, id) of the list ``column``, with the ids that are ``always`` in it."""
    extra = F.array(*[F.lit(x).cast("bigint") for x in always]).cast("array<bigint>")
    return valid(requests).filter(F.col(column).isNotNull()).select(
        F.col("request_id").alias("v_request_id"), F.explode(F.array_union(F.col(column), extra)).alias("id"))


def id_classes(ids: DataFrame) -> DataFrame:
    """``id, cls``: ids that the same requests list are one class, named by its smallest id."""
    alike = ids.groupBy("id").agg(F.array_sort(F.collect_set("v_request_id")).alias("in"))
    return alike.join(alike.groupBy("in").agg(F.min("id").alias("cls")), "in").select("id", "cls")


def bitmaps(ids: DataFrame) -> DataFrame:
    """(request, id) as one long per request and 64 consecutive ids."""
    bit = F.expr("shiftleft(1L, int(id & 63))")
    return ids.groupBy("v_request_id", F.shiftright("id", 6).alias("v_block")).agg(F.bit_or(bit).alias("v_bits"))


def calendar(requests: DataFrame) -> DataFrame:
    """``day, segment``: every requested day and the first day of its segment.

    Between two dates on which a request begins or ends all days are alike, so
    the window below sees at most one row per such date, however many requests
    there are.
    """
    spans = valid(requests).filter("from_dt <= to_dt").select("from_dt", "to_dt")
    turns = (spans.select(F.col("from_dt").alias("day"), F.lit(1).alias("step"))
             .unionAll(spans.select(F.date_add("to_dt", 1), F.lit(-1)))
             .groupBy("day").agg(F.sum("step").alias("step")))
    by_day = Window.orderBy("day")
    segments = turns.select("day", F.sum("step").over(by_day).alias("open"), F.lead("day").over(by_day).alias("next"))
    return segments.filter("open > 0").select(
        F.explode(F.sequence("day", F.date_sub("next", 1))).alias("day"), F.col("day").alias("segment"))


# --- bounds ---------------------------------------------------------------------

def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; not positive where nothing may be broadcast."""
    value = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", value).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


def fits(spark: SparkSession, rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= broadcast_limit(spark)


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for the join that its counted size allows."""
    return df.hint("broadcast" if fits(df.sparkSession, rows, row_bytes) else "merge")


@dataclass(frozen=True)
class ScanBounds:
    """What is known of a batch of requests before a fact is read; ``ids`` is None if none can match."""

    ids: tuple[int, int] | None
    intervals: tuple[tuple[date, date], ...]
    n_keys: int = 0
    n_io: int = 0
    n_pixel: int = 0
    #: (has an insertion order list, has a pixel list) of the valid requests.
    kinds: frozenset[tuple[bool, bool]] = frozenset()
    n_days: int = 0
    days: DataFrame | None = field(default=None, compare=False)
    keys: DataFrame | None = field(default=None, compare=False)

    def column(self, dates: bool = True) -> Column:
        """The part that is pushed into a scan: id range and date intervals."""
        if self.ids is None:
            return F.lit(False)
        out = F.col("advertiser_id").between(*self.ids)
        if dates:
            days = [F.col("dt").between(F.lit(lo), F.lit(hi)) for lo, hi in self.intervals]
            out = out & (reduce(Column.__or__, days) if days else F.lit(False))
        return out

    def filter_words(self, spark: SparkSession) -> int:
        """Words of the Bloom filter: as many as the ids want and a broadcast allows; 0 for none."""
        want = max(FILTER_WORDS_LEAST, min(FILTER_WORDS_MOST, self.n_keys // FILTER_IDS_PER_WORD))
        most = broadcast_limit(spark) // WORD_BYTES
        return 0 if most < FILTER_WORDS_LEAST else 1 << (min(want, most).bit_length() - 1)


def merged(hulls: list[tuple[date, date]], most: int = MAX_INTERVALS) -> tuple[tuple[date, date], ...]:
    """Disjoint intervals over ``hulls``; at most ``most`` of them."""
    out: list[tuple[date, date]] = []
    for lo, hi in sorted(hulls):
        if out and lo <= out[-1][1] + timedelta(days=1):
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    if len(out) > most:
        gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1], reverse=True)
        starts = [0, *sorted(gaps[:most - 1]), len(out)]
        out = [(out[a][0], out[z - 1][1]) for a, z in zip(starts, starts[1:])]
    return tuple(out)


def scan_bounds(requests: DataFrame, scratch: Scratch | None = None) -> ScanBounds:
    """Bounds and sizes of all requests.

    The calendar is written once, for every fact to read.  The requested days
    come back as one hull per calendar month, so the rows that reach the driver
    are bounded by the calendar, not by the requests.
    """
    has_io, has_pixel = F.col("io_ids").isNotNull(), F.col("conv_pixel_ids").isNotNull()
    row = valid(requests).agg(
        F.min(F.array_min("advertiser_ids")).alias("lo"), F.max(F.array_max("advertiser_ids")).alias("hi"),
        F.sum(F.size(F.array_distinct("advertiser_ids"))).alias("keys"),
        F.sum(F.when(has_io, F.size("io_ids"))).alias("io"),
        F.sum(F.when(has_pixel, F.size("conv_pixel_ids") + 1)).alias("pixel"),
        F.collect_set(F.struct(has_io.alias("io"), has_pixel.alias("pixel"))).alias("kinds")).first()
    if row["lo"] is None:
        return ScanBounds(None, ())
    days = snapshot(calendar(requests), scratch)
    hulls = days.groupBy(F.trunc("day", "month")).agg(
        F.min("day").alias("lo"), F.max("day").alias("hi"), F.count(F.lit(1)).alias("n")).collect()
    return ScanBounds(
        (row["lo"], row["hi"]), merged([(r["lo"], r["hi"]) for r in hulls]), row["keys"], row["io"] or 0, row["pixel"] or 0,
        frozenset((k["io"], k["pixel"]) for k in row["kinds"]), sum(r["n"] for r in hulls), days, request_keys(requests))


# --- ahead of the join ----------------------------------------------------------

def _word(n: int, column: str) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(1)), F.lit(n))


def _mask(column: str) -> Column:
    """The bits that an id sets in its word: six bits of a second hash give the place of each."""
    h = F.xxhash64(column, F.lit(2))
    bits = []
    for k in range(FILTER_BITS):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return reduce(Column.bitwiseOR, bits)


def id_filter(keys: DataFrame, words: int) -> DataFrame:
    """Bloom filter of the requested advertiser ids, one row per word that has a bit."""
    return (keys.select("r_advertiser_id").distinct()
            .groupBy(_word(words, "r_advertiser_id").alias("i_word")).agg(F.bit_or(_mask("r_advertiser_id")).alias("i_bits")))


def candidates(fact: DataFrame, bounds: ScanBounds, dates: bool = True, segments: bool = False) -> DataFrame:
    """Fact rows that may belong to a request; with ``segments`` a column ``segment`` instead of ``dt``."""
    spark = fact.sparkSession
    out = fact.filter(bounds.column(dates))
    if bounds.ids is None:
        return out.withColumnRenamed("dt", "segment") if segments else out
    words = bounds.filter_words(spark)
    if words:
        seen = F.broadcast(id_filter(bounds.keys, words))
        out = out.join(seen, _word(words, "advertiser_id") == F.col("i_word")) \
                 .filter(F.col("i_bits").bitwiseAND(_mask("advertiser_id")) == _mask("advertiser_id")) \
                 .drop("i_word", "i_bits")
    if dates and fits(spark, bounds.n_days, WORD_BYTES):
        # The literal bound is implied; it tells Spark that the calendar is worth pruning by.
        days = bounds.days.filter(F.col("day") >= F.lit(bounds.intervals[0][0])) if bounds.intervals else bounds.days
        out = out.join(F.broadcast(days), F.col("dt") == F.col("day")).drop("day")
        return out.drop("dt") if segments else out.drop("segment")
    return out.withColumnRenamed("dt", "segment") if segments else out


# --- matching -------------------------------------------------------------------

def _block(column: str) -> Column:
    """Block of 64 ids; a null id gets one that no list has (so that nothing is inferred about nulls)."""
    return F.coalesce(F.shiftright(column, 6), F.lit(NO_BLOCK).cast("bigint"))


def _tested(column: str) -> Column:
    """Whether the bit of the id is set in the word of its block (nothing is inferred about nulls here either)."""
    return F.expr(f"shiftright(v_bits, int(coalesce({column}, 0L) & 63)) & 1") == 1


def _listed(rows: DataFrame, words: DataFrame, n: int, column: str) -> DataFrame:
    """Rows whose ``column`` is in the list of their request."""
    words = sized(words, n, WORD_BYTES)
    return rows.join(words, (F.col("r_request_id") == F.col("v_request_id")) & (_block(column) == F.col("v_block"))) \
               .filter(_tested(column)).drop("v_request_id", "v_block", "v_bits")


def _listed_or_free(rows: DataFrame, words: DataFrame, n: int, column: str, has_list: str) -> DataFrame:
    """Rows whose request has no list, or whose ``column`` is in it, from one pass over ``rows``."""
    words = sized(words, n, WORD_BYTES)
    met = rows.join(words, F.col(has_list) & (F.col("r_request_id") == F.col("v_request_id"))
                    & (_block(column) == F.col("v_block")), "left")
    return met.filter(~F.col(has_list) | F.coalesce(_tested(column), F.lit(False))).drop("v_request_id", "v_block", "v_bits")


def _condition(day: str, zone: str | None, dates: bool) -> Column:
    cond = F.col("advertiser_id") == F.col("r_advertiser_id")
    if dates:
        cond = cond & (F.col(day) >= F.col("r_from_dt")) & (F.col(day) <= F.col("r_to_dt"))
    if zone:
        cond = cond & (F.col(zone) == F.col("r_timezone"))
    return cond


def _zoned(fact: DataFrame, match_timezone: bool, match_country: bool) -> tuple[DataFrame, str | None]:
    """The fact with the column that must equal a request's time zone, and that column's name.

    Each spelling of a country belongs to one zone, so the lookup adds no rows;
    rows of other countries go.
    """
    if match_country:
        zones = dims.lookup(dims.countries(fact.sparkSession)).select(
            F.col("de_country_name").alias("z_country"), F.col("timezone").alias("z_timezone"))
        return fact.join(zones, F.col("de_country_name") == F.col("z_country")).drop("z_country"), "z_timezone"
    return fact, "time_zone_name" if match_timezone else None


def scope(fact: DataFrame, requests: DataFrame, *, match_timezone: bool = False,
          match_country: bool = False, apply_io: bool = True,
          apply_pixel: bool = True, apply_dates: bool = True,
          bounds: ScanBounds | None = None) -> DataFrame:
    """Fact rows in scope of each request, plus ``request_id``.

    ``match_timezone``: the fact's ``time_zone_name`` must equal the request's
    time zone (time-of-day fact).  ``match_country``: the fact's
    ``de_country_name`` must be one of the spellings of the request time
    zone's country (geo fact); a request whose zone has no country gets no
    rows.  The result then also carries the request ``timezone``.

    ``apply_*`` switch off single optional predicates; they exist so each
    predicate can be exercised on its own.  ``bounds`` (from ``scan_bounds``)
    may be passed in to share them between facts.  A pixel list also keeps
    pixel 0.
    """
    bounds = bounds if bounds is not None else scan_bounds(requests)
    rows, zone = _zoned(candidates(fact, bounds, apply_dates), match_timezone, match_country)
    out = rows.join(sized(request_keys(requests), bounds.n_keys, KEY_BYTES), _condition("dt", zone, apply_dates))
    if apply_io and any(io for io, _ in bounds.kinds):
        out = _listed_or_free(out, bitmaps(list_ids(requests, "io_ids")), bounds.n_io, "insertion_order_id", "r_has_io")
    if apply_pixel and any(pixel for _, pixel in bounds.kinds):
        out = _listed_or_free(out, bitmaps(list_ids(requests, "conv_pixel_ids", 0)), bounds.n_pixel, "pixel_id", "r_has_pixel")
    return out.select(F.col("r_request_id").alias("request_id"), *[F.col(f"`{c}`") for c in fact.columns],
                      *([F.col("r_timezone").alias("timezone")] if match_country else []))


#: The optional lists: column of the fact, of the requests, the ids always in it, and the place in ``ScanBounds.kinds``.
LISTS = (("insertion_order_id", "io_ids", (), 0), ("pixel_id", "conv_pixel_ids", (0,), 1))


def segment_sums(fact: DataFrame, requests: DataFrame, grain: list[str], bounds: ScanBounds, *, match_timezone: bool = False,
                 match_country: bool = False) -> tuple[DataFrame, dict[str, DataFrame], str | None]:
    """Measure sums per advertiser, class of each listed id, zone, segment and ``grain``: once for all requests.

    Also returns the bitmaps of the lists by id column, over classes, and the name
    of the zone column, if there is one.  Classes are looked up in a broadcast
    table; where the lists are too long for that, each id is its own class.
    """
    rows, zone = _zoned(candidates(fact, bounds, segments=True), match_timezone, match_country)
    lists = {}
    for column, of, always, k in LISTS:
        if any(kind[k] for kind in bounds.kinds):
            ids = list_ids(requests, of, *always)
            if fits(fact.sparkSession, (bounds.n_io, bounds.n_pixel)[k], WORD_BYTES):
                classes = id_classes(ids)
                rows = (rows.join(F.broadcast(classes), F.col(column) == F.col("id"), "left")
                        .withColumn(column, F.col("cls")).drop("id", "cls"))
                ids = ids.join(classes, "id").select("v_request_id", F.col("cls").alias("id"))
            lists[column] = bitmaps(ids)
    keys = ["advertiser_id", *lists, *([zone] if zone else []), "segment"]
    return dealt(rows.groupBy(*keys, *grain).agg(*measure_sums()), [*keys, *grain], fact, bounds), lists, zone


def dealt(sums: DataFrame, keys: list[str], fact: DataFrame, bounds: ScanBounds) -> DataFrame:
    """``sums`` dealt evenly, by all their keys, to as many tasks as the rows of the fact ask for.

    All kinds of requests read the one exchange, so the sums are made once for them.
    """
    tasks = -(-fact.filter(bounds.column()).count() // TASK_ROWS) if bounds.ids else 1
    return sums.repartition(tasks, *keys) if tasks > 1 else sums


def request_sums(fact: DataFrame, requests: DataFrame, grain: list[str], *, match_timezone: bool = False,
                 match_country: bool = False, bounds: ScanBounds | None = None) -> DataFrame:
    """Measure sums of each request at ``grain`` (``request_id``, with ``match_country`` also ``timezone``).

    The same as summing ``scope``, but the fact is summed by segment first and
    only these sums meet the requests.  Requests of one kind (with or without
    either list) are matched together, all from the same sums.
    """
    bounds = bounds if bounds is not None else scan_bounds(requests)
    sums, lists, zone = segment_sums(fact, requests, grain, bounds, match_timezone=match_timezone, match_country=match_country)
    matched = None
    for has_io, has_pixel in product((False, True), repeat=2):
        if (has_io, has_pixel) not in bounds.kinds and (bounds.kinds or has_io or has_pixel):
            continue
        keys = request_keys(requests.filter((F.col("io_ids").isNotNull() == has_io)
                                            & (F.col("conv_pixel_ids").isNotNull() == has_pixel)))
        out = sums.join(sized(keys, bounds.n_keys, KEY_BYTES), _condition("segment", zone, True))
        if has_io:
            out = _listed(out, lists["insertion_order_id"], bounds.n_io, "insertion_order_id")
        if has_pixel:
            out = _listed(out, lists["pixel_id"], bounds.n_pixel, "pixel_id")
        out = out.select(F.col("r_request_id").alias("request_id"),
                         *([F.col("r_timezone").alias("timezone")] if match_country else []), *grain,
                         "impressions", "clicks", "conversions")
        matched = out if matched is None else matched.unionAll(out)
    return matched.groupBy("request_id", *(["timezone"] if match_country else []), *grain).agg(*resum())
