"""Reading tables by name, and materializing models as views or tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables:
    """Parquet tables of one directory, read lazily by attribute or key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """Batch scan of a bronze table; Delta is a format name away where its jar is present."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_since(spark: SparkSession, path: str, first_ingestion_date, fmt: str = "parquet") -> DataFrame:
    """Incremental scan: only ingestion-date folders from the given day on are listed and read."""
    return read_table(spark, path, fmt).filter(
        F.col("ingestion_date") >= F.lit(first_ingestion_date).cast("date")
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared table layout; missing columns become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_build_time(df: DataFrame, column: str = "built_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty Parquet table with the declared columns unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def publish_view(df: DataFrame, name: str) -> None:
    """Staging models stay virtual."""
    df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, name: str) -> None:
    """Gold models are rebuilt in full and carry their build time."""
    with_build_time(df).write.mode("overwrite").format("parquet").saveAsTable(name)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table, counted in a single job."""
    counts: Iterable[DataFrame] = (
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)


def presence(tables: dict[str, DataFrame]) -> DataFrame:
    """Whether each table holds at least one row; reads no more than one row per table."""
    probes = (
        df.limit(1)
        .agg((F.count(F.lit(1)) > 0).alias("has_rows"))
        .select(F.lit(name).alias("table_name"), "has_rows")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, probes)


def file_freshness(
    tables: dict[str, DataFrame], now=None, max_age_hours: float = 2.0
) -> DataFrame:
    """Age of the newest file of each file-backed table against a freshness limit.

    Reads one row per record; listed_freshness reads one per file.
    """
    newest = (
        df.agg(F.max("_metadata.file_modification_time").alias("newest_file")).select(
            F.lit(name).alias("table_name"), "newest_file"
        )
        for name, df in tables.items()
    )
    return _aged(newest, now, max_age_hours)


def listed_freshness(
    spark: SparkSession,
    paths: dict[str, str],
    now=None,
    max_age_hours: float = 2.0,
    pattern: str = "*.parquet",
    partition: str | None = None,
) -> DataFrame:
    """file_freshness from the listing of each table's folder: no file is opened.

    With ``partition`` (a partition column that grows with time, as the ingestion date)
    only the files of the newest value count and are listed as rows.  A folder without
    files has no newest file and is not fresh.
    """

    def newest(name: str, path: str) -> DataFrame:
        # The content column is not selected, so files are listed but not read.
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        if partition:
            latest = files.agg(F.max(partition)).scalar()
            files = files.filter(F.col(partition) == latest)
        return files.agg(F.max("modificationTime").alias("newest_file")).select(
            F.lit(name).alias("table_name"), "newest_file"
        )

    return _aged((newest(name, path) for name, path in paths.items()), now, max_age_hours)


def _aged(newest: Iterable[DataFrame], now, max_age_hours: float) -> DataFrame:
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    age = (F.unix_timestamp(moment) - F.unix_timestamp("newest_file")) / 3600.0
    return (
        reduce(DataFrame.unionByName, newest)
        .withColumn("age_hours", age)
        .withColumn("is_fresh", F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False)))
    )
