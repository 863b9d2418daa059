"""Tables of a stream whose outputs belong together: one folder per micro-batch, committed at once.

A micro-batch writes its folder ``batch_id=N`` in every output, and last its row in ``commits``.
Readers see the batches that have that row, so outputs of one batch appear together or not at all;
a batch that is retried after a failure replaces its folders and its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.sources.folders import exists, numbered_folders

COMMITS = "commits"
BATCH = "batch_id"


def write_batch(df: DataFrame, root: str, table: str, batch_id: int, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{root}/{table}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, root: str, table: str, schema: T.StructType | str) -> DataFrame:
    """All committed rows of one output, with their batch_id; empty before the first commit.

    The schema is given, so a table to which no batch has sent rows yet can be read too.
    """
    columns = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    columns = T.StructType([f for f in columns.fields if f.name != BATCH]).add(BATCH, "long")
    if not exists(spark, f"{root}/{table}") or not numbered_folders(spark, f"{root}/{COMMITS}", BATCH):
        return spark.createDataFrame([], columns)
    committed = spark.read.parquet(f"{root}/{COMMITS}").select(BATCH)
    return spark.read.schema(columns).parquet(f"{root}/{table}").join(committed, BATCH, "left_semi")
