"""JDBC source and sink.

Writes are parallel (one connection per partition, ``numPartitions``
caps it) and batched; reads are split on a numeric column when bounds
are given, and filters/column pruning of the DataFrame are pushed into
the remote query by Spark's JDBC source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", num_partitions: int | None = None,
               batch_size: int = 1000, truncate: bool = True) -> None:
    """Replace (or append to) a table. ``truncate`` keeps the
    table definition on overwrite where the database allows it."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).option("truncate", str(truncate).lower()))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    """A table (``table``) or a query (``query``; read as a derived table,
    so that it can be split, too). With ``partition_column`` the read is
    split into ``num_partitions`` ranges between the bounds, which are asked
    for in one query (min and max) if they aren't given. Without it one task
    reads everything, which ``num_partitions=1`` has to confirm."""
    source = f"({query}) q" if query is not None else table

    def reader(dbtable):
        r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size)).option("dbtable", dbtable)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return r

    if partition_column is None:
        if num_partitions != 1:
            raise ValueError("partition_column is needed to read in parallel; num_partitions=1 reads in one task")
        return reader(source).load()
    if lower_bound is None or upper_bound is None:
        lo, hi = reader(f"(SELECT min({partition_column}) lo, max({partition_column}) hi FROM {source}) b").load().first()
        lower_bound, upper_bound = (lo if lower_bound is None else lower_bound), (hi if upper_bound is None else upper_bound)
        if lower_bound is None:     # no rows
            return reader(source).load()
    return (reader(source).option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions or 8))).load()
