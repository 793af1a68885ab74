"""Work on one key's rows in many tasks: sorted ranges and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchlab.session import materialize


def ranged(df: DataFrame, order: list, partitions: int | None = None, name: str = "ranges") -> DataFrame:
    """``df`` range-partitioned on ``order`` and written once, with the range's
    number in ``_range``: ranges follow each other in ``order`` and hold about
    as many rows each, whatever the values look like. (A key's rows with all
    order columns equal stay together.)"""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    parted = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return materialize(parted.withColumn("_range", F.spark_partition_id()), name)


def running_total(df: DataFrame, group: list[str], order: str, amount: str, out: str,
                  descending: bool = False, inclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Running sum of ``amount`` in ``order`` within each ``group``, for any
    number of rows per group: a window over (group, range) of ``ranged`` rows,
    plus the totals of the group's earlier ranges, from a table with one row
    per (group, range). With ``inclusive`` ties are summed together (RANGE
    semantics); otherwise only strictly earlier rows count."""
    o = F.col(order).desc() if descending else F.col(order).asc()
    r = ranged(df, [*group, o], partitions, "running_total")
    key = [*group, "_range"]
    totals = r.groupBy(*key).agg(F.sum(amount).alias("_t"))
    wg = (Window.partitionBy(*group) if group else Window).orderBy("_range")     # a group's ranges only
    totals = totals.select(*key, F.coalesce(F.sum("_t").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    run = F.sum(amount).over(Window.partitionBy(*key).orderBy(o).rangeBetween(Window.unboundedPreceding, 0))
    if not inclusive:   # strictly before: drop the rows tied with this one
        run = run - F.sum(amount).over(Window.partitionBy(*key, order))
    return r.join(totals, on=key, how="inner").select(*df.columns, (F.col("_before") + run).alias(out))


def positions(df: DataFrame, group: list[str], order: list[str], out: str, size: str | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` with each row's place in its group (from 1, by ``order``, which
    tells a group's rows apart) and, if ``size`` is given, the group's number
    of rows: places within (group, range) plus the counts of earlier ranges."""
    r = ranged(df, [*group, *order], partitions, "positions")
    part = [*group, "_range"]
    counts = r.groupBy(*part).agg(F.count(F.lit(1)).alias("_c"))
    of_group = Window.partitionBy(*group) if group else Window.partitionBy()     # one row a range
    before = F.coalesce(F.sum("_c").over(of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(c).alias(f"{c}_") for c in part], before.alias("_b"), F.sum("_c").over(of_group).alias("_all"))
    place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in part]
    j = r.withColumn("_place", place).join(counts, same)
    return j.select(*df.columns, (F.col("_b") + F.col("_place")).alias(out), *([F.col("_all").alias(size)] if size else []))
