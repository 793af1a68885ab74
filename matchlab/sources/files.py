"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

# text fields are written and read verbatim (no blank trimming), so
# padded names survive a round trip and the cleaning step trims them
_CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """S01 (fixed schema) / S02 (``infer=True``). With ``corrupt_col`` the
    fixed-schema read is PERMISSIVE and keeps unparsable lines in that
    column instead of failing."""
    r = spark.read.options(**_CSV_OPTS)
    if schema is not None and not infer:
        if corrupt_col:
            schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
            r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_CSV_OPTS).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S04."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, mode: str = "overwrite") -> None:
    """S05 + L10: overwrite a parquet table. No ``coalesce(1)``: every task
    writes its own file. ``partition_by`` (e.g. a year column) gives
    partition pruning to later date filters; rows are range-partitioned on
    (partition columns, ``sort_within``), so a year holding a third of the
    rows is split over many tasks by its sampled date ranges (never one
    task per year), and each task writes few files with sorted rows (good
    min/max statistics for row-group pruning) without a global sort."""
    out = df
    order = list(partition_by or []) + list(sort_within or [])
    if partition_by:
        out = out.repartitionByRange(*[F.col(c) for c in order])
    if order:
        out = out.sortWithinPartitions(*order)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_counted(df: DataFrame, path: str, name: str = "rows", **kw) -> DataFrame:
    """S05 + S11: write, counting the rows on the write path with ``observe``
    (no second scan of the source), read the table back and return
    (table_name, rows_written, rows_read, status). Range partitioning samples
    its input, which would run and count it twice, so with ``partition_by``
    the counted rows are written to the scratch folder first."""
    spark = df.sparkSession
    from matchlab.session import discard, materialize_counted
    staged, written = materialize_counted(df, f"staged_{name}")
    write_table(staged, path, **kw)
    discard(staged)
    back = read_parquet(spark, path)
    return back.agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit(name).alias("table_name"), F.lit(written).cast("bigint").alias("rows_written"),
        "rows_read",
        F.when(F.col("rows_read") == F.lit(written), "PASS").otherwise("FAIL").alias("status"))


def write_ordered(df: DataFrame, path: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Files that follow each other in ``order`` (range partitions, sorted
    inside; with an id as last column a hot date spreads over several files), and
    below ``path`` a table of them, which is returned: ``file`` (number, from
    0), ``path``, ``first``, ``last`` (keys), ``n_rows``, ``before`` (rows in
    earlier files), ``follows`` (not before the last key of the file before). One
    row a file is taken from the files themselves."""
    cols = [F.col(c) for c in order]
    parted = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    parted.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    key = F.struct(*order)
    files = spark.read.schema(df.schema).parquet(path).groupBy(F.input_file_name().alias("path")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy().orderBy("first", "last", "path")         # one row a file
    files = files.select((F.row_number().over(w) - 1).alias("file"), "path", "first", "last", "n_rows",
                         F.coalesce(F.sum("n_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                         F.coalesce(F.lag("last").over(w) <= F.col("first"), F.lit(True)).alias("follows"))
    files.coalesce(1).write.mode("overwrite").parquet(f"{path}/_files")        # Spark's readers skip names with an underscore
    return spark.read.parquet(f"{path}/_files")


def read_ordered(spark: SparkSession, path: str, order: list[str], position: str = "position") -> DataFrame:
    """What ``write_ordered`` wrote, with each row's place (from 1) in the
    order over all files: its place in its own file after the rows of the files
    before. Files that don't follow each other raise ValueError."""
    files = spark.read.parquet(f"{path}/_files")
    if not files.where("NOT follows").isEmpty():
        raise ValueError(f"the files of {path} don't follow each other")
    rows = spark.read.parquet(path).withColumn("_path", F.input_file_name())
    place = F.row_number().over(Window.partitionBy("_path").orderBy(*order))
    return rows.withColumn("_n", place).join(files.select(F.col("path").alias("_path"), "before"), "_path").select(
        *[c for c in rows.columns if c != "_path"], (F.col("before") + F.col("_n")).alias(position))


def content_sums(df: DataFrame) -> list:
    """Aggregates that tell tables of different content apart, whatever the
    order of rows: the number of rows and the sums of two 64-bit hashes of each row
    (each column with a mark for null, so that nulls in different places differ)."""
    marked = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    two = [F.xxhash64(F.lit(seed), *marked).cast("decimal(38,0)") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).alias(f"h{i}") for i, h in enumerate(two)]]


def write_verified(df: DataFrame, path: str, name: str = "rows", **kw) -> DataFrame:
    """S05 + S11: write, and compare what is read back with what was written by
    content: (table_name, rows_written, rows_read, same_content, status). The
    sums are taken on the write path (``observe``) and in one scan of the table."""
    from pyspark.sql import Observation

    from matchlab.session import discard, materialize
    obs = Observation(f"content_{name}")
    staged = materialize(df.observe(obs, *content_sums(df)), f"staged_{name}")
    written = obs.get
    write_table(staged, path, **kw)
    discard(staged)
    return compare_content(df.sparkSession, path, name, written, df.columns)


def compare_content(spark: SparkSession, path: str, name: str, written: dict, columns: list[str]) -> DataFrame:
    back = read_parquet(spark, path).select(*columns)
    n, same = F.col("n") == written["n"], F.lit(True)
    for h in ("h0", "h1"):
        same = same & (F.col(h) == F.lit(written[h]).cast("decimal(38,0)"))
    return back.agg(*content_sums(back)).select(
        F.lit(name).alias("table_name"), F.lit(written["n"]).cast("bigint").alias("rows_written"), F.col("n").alias("rows_read"),
        same.alias("same_content"), F.when(n & same, "PASS").otherwise("FAIL").alias("status"))


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first n rows (in ``order_by`` order when given)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows (position, column_name, data_type, nullable)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
