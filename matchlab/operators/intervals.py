"""Lookup in validity periods by key and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Days from 0001-01-01 to 1970-01-01, and a power of two above all dates' day numbers.
_FIRST, _LEVELS = 719162, 22


def _day(c: str) -> Column:
    return F.unix_date(F.col(c)) + _FIRST


def _pieces(first: Column, last: Column) -> Column:
    """The at most 2 * 22 aligned stretches of 2^k days that a period consists of, as (k, number)."""
    def level(k: int):
        lo, hi = F.shiftright(first + (1 << k) - 1, k), F.shiftright(last + 1, k)
        def one(use, number):
            return F.when((lo < hi) & use, F.struct(F.lit(k).alias("k"), number.alias("p")))
        return [one(lo % 2 == 1, lo), one(hi % 2 == 1, hi - 1)]
    return F.filter(F.array(*[x for k in range(_LEVELS + 1) for x in level(k)]), lambda x: x.isNotNull())


def latest_period(points: DataFrame, periods: DataFrame, keys: list[str], date: str, start: str, end: str, value: str) -> DataFrame:
    """One row for each distinct (keys, date) of ``points`` that lies in a period
    of its key: ``keys``, ``date`` and the ``value`` of that period (both ends
    included, null: open). Of several, the one that began last counts, then the
    greatest value. Periods with an end before their start, null keys and null
    dates match nothing.

    A period is cut into aligned stretches of 2^k days (dyadic intervals), at most
    44; of each stretch the winning period stays (map-side aggregation). A date lies
    in one stretch of each of the 23 lengths, so every lookup is 23 equality
    joins' worth of rows, however many periods a key has, and nothing of a key is
    held in one row or task."""
    first = F.when(F.col(start).isNull(), F.lit(0)).otherwise(_day(start))
    last = F.when(F.col(end).isNull(), F.lit((1 << _LEVELS) - 1)).otherwise(_day(end))
    cut = periods.select(*keys, first.alias("_f"), last.alias("_l"), F.col(value).alias("_v")).where("_f <= _l")
    cut = cut.select(*keys, "_f", "_v", F.inline(_pieces(F.col("_f"), F.col("_l"))))
    winners = cut.groupBy(*keys, "k", "p").agg(F.max(F.struct("_f", "_v")).alias("_w"))
    asked = points.select(*keys, date).where(F.col(date).isNotNull()).distinct()
    known = periods.select(*keys).distinct()
    asked = asked.join(known, keys, "left_semi").select(*keys, date, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.shiftright(_day(date), k).alias("p"))
                                                                                       for k in range(_LEVELS + 1)])).alias("_s"))
    asked = asked.select(*keys, date, "_s.k", "_s.p")
    return asked.join(winners, [*keys, "k", "p"]).groupBy(*keys, date).agg(F.max("_w").alias("_w")).select(*keys, date, F.col("_w._v").alias(value))
