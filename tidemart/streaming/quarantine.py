"""Ingestion that keeps every record: good ones become rows, bad ones stay as raw payloads with reasons.

Each micro-batch is validated once and split in two outputs that are committed together (batches.py):
``records``, the parsed columns by ingestion date, and ``quarantine``, the payload as it came, its
broken rules, and the time it came at.  Malformed text is quarantined as ``not_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.contracts import Rule, validate
from tidemart.streaming.batches import BATCH, COMMITS, read_batches, write_batch

RECORDS, QUARANTINE = "records", "quarantine"
PARTITION = "ingestion_date"
_INGESTED = ["source_timestamp", "ingestion_timestamp", PARTITION]
_INGESTED_TYPES = "source_timestamp timestamp, ingestion_timestamp timestamp, ingestion_date date"


def checked(raw: DataFrame, schema: T.StructType, contract: dict[str, Rule] | None) -> DataFrame:
    """value (text), violations and the ingestion columns of raw (value, timestamp) records.

    Without a contract only records whose key, the schema's first field, cannot be read are bad.
    The ingestion time is the micro-batch's, so a retried batch gets the same one.
    """
    text = raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("source_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.current_date().alias(PARTITION),
    )
    if contract is not None:
        return validate(text, contract)
    key = F.from_json("value", T.StructType(schema.fields[:1]))[schema.fields[0].name]
    return text.withColumn("violations", F.when(key.isNull(), F.array(F.lit("no_key"))).otherwise(F.array().cast("array<string>")))


def store_batch(batch: DataFrame, batch_id: int, schema: T.StructType, root: str) -> None:
    """Write both outputs of a checked micro-batch, then its commit."""
    batch = batch.persist()
    try:
        bad = F.size("violations") > 0
        good_rows, bad_rows = Observation(), Observation()
        record = F.from_json("value", schema)
        records = batch.filter(~bad).select(F.inline(F.array(record)), *_INGESTED)
        rejected = batch.filter(bad).select("value", "violations", *_INGESTED)
        count = F.count(F.lit(1)).alias("rows")
        write_batch(records.observe(good_rows, count), root, RECORDS, batch_id, PARTITION)
        write_batch(rejected.observe(bad_rows, count), root, QUARANTINE, batch_id)
        done = (batch_id, good_rows.get["rows"], bad_rows.get["rows"])
        spark = batch.sparkSession
        counts = spark.createDataFrame([done], f"{BATCH} long, good long, bad long").drop(BATCH)
        write_batch(counts, root, COMMITS, batch_id)
    finally:
        batch.unpersist()


def write_checked(
    raw: DataFrame,
    schema: T.StructType,
    contract: dict[str, Rule] | None,
    root: str,
    checkpoint: str,
    label: str,
    trigger: dict,
) -> StreamingQuery:
    """One stream, two outputs, exactly once per checkpoint."""
    return (
        checked(raw, schema, contract)
        .writeStream.option("checkpointLocation", checkpoint)
        .queryName(f"bronze_{label}")
        .foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, schema, root))
        .trigger(**trigger)
        .start()
    )


def read_records(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    ingested = spark.createDataFrame([], _INGESTED_TYPES).schema
    return read_batches(spark, root, RECORDS, T.StructType([*schema.fields, *ingested.fields]))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, root, QUARANTINE, f"value string, violations array<string>, {_INGESTED_TYPES}")
