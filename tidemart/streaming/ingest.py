"""Event streams into the bronze tables: parse, add ingestion columns, append."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.contracts import Rule, split_valid, validate
from tidemart.streaming.quarantine import write_checked

# Kafka reader defaults, trigger, partition column.
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}
TRIGGER = "30 seconds"
PARTITION = "ingestion_date"


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """Raw records (value, timestamp) of a topic; needs the Kafka connector jar."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": f"tidemart-bronze-{topic.replace('.', '-')}",
        **KAFKA_DEFAULTS,
        **(options or {}),
    }
    return spark.readStream.format("kafka").options(**settings).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files arriving in a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_and_enrich(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON payload to columns, plus source time, ingestion date and ingestion time.

    Works the same on streams and batches.  Records whose key, the schema's first
    field, is null did not parse and are left out; ``with_quarantine`` keeps them.
    The parsed struct is flattened by a generator, which the key filter is not
    pushed through, so each record is parsed once.
    """
    key = schema.fields[0].name
    record = F.from_json(F.col("value").cast("string"), schema)
    return (
        raw.withColumnRenamed("timestamp", "source_timestamp")
        .select(F.inline(F.array(record)), "source_timestamp")
        .filter(F.col(key).isNotNull())
        .withColumn(PARTITION, F.current_date())
        .withColumn("ingestion_timestamp", F.current_timestamp())
    )


def with_quarantine(raw: DataFrame, contract: dict[str, Rule]) -> tuple[DataFrame, DataFrame]:
    """(raw records that meet the contract, rejected records with their reasons)."""
    text = raw.withColumn("value", F.col("value").cast("string"))
    return split_valid(validate(text, contract))


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    label: str,
    trigger: dict | None = None,
    fmt: str = "parquet",
    partition_by: str | None = PARTITION,
) -> StreamingQuery:
    """Append a stream to a table, exactly once per checkpoint."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .queryName(f"bronze_{label}")
        .trigger(**(trigger or {"processingTime": TRIGGER}))
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.start()


@dataclass(frozen=True)
class Feed:
    """One topic: its raw stream, payload schema and, to keep bad records, its contract."""

    label: str
    raw: DataFrame
    schema: T.StructType
    contract: dict[str, Rule] | None = None


def start_feeds(
    feeds: list[Feed], bronze_root: str, checkpoint_root: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """One independent query per feed, each with its own table and checkpoint.

    A feed with a contract keeps its bad records in a quarantine beside the table.
    """

    def start(feed: Feed) -> StreamingQuery:
        table, checkpoint = f"{bronze_root}/{feed.label}", f"{checkpoint_root}/{feed.label}"
        if feed.contract is not None:
            every = trigger or {"processingTime": TRIGGER}
            return write_checked(feed.raw, feed.schema, feed.contract, table, checkpoint, feed.label, every)
        return write_stream(parse_and_enrich(feed.raw, feed.schema), table, checkpoint, feed.label, trigger)

    return [start(feed) for feed in feeds]


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for any query to end, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an availableNow query to finish; raises if it failed."""
    query.awaitTermination()
    return query
