"""Exact duplicates by a stateful stream.

Rows arrive as a feed of (delivery, seq, doc_id, digest).  A streaming aggregation keeps one state row
per digest in a disk-backed (RocksDB) store without watermark, so nothing expires: how many rows
had the digest, the stable identifier of the row that stays, and its place in the feed (the content
locator: delivery and number in it).  The aggregation combines copies before the shuffle, so a group
that holds a third of all rows reaches the store as one row per task and micro-batch.

A state folder outlives the call.  It holds the feed, the texts, the stream's checkpoint and the state
rows of each micro-batch, so a later delivery meets the copies of all earlier ones.  A delivery that
has been written is not written again, so a call that failed is simply repeated, and repeating an
earlier delivery's call gives its rows as they stand now.  Without a state folder a call is alone.

Hits (digests seen more than once) are confirmed on full bytes: their texts are grouped by
(digest, text), which compares whole byte strings and also combines before the shuffle.
Should two texts share a digest, the rows of that digest are grouped by text instead.

Defined results: a null text counts as empty; of rows with equal text the one with the largest
doc_id stays (null is smallest); of equal doc_ids the one latest in the feed; every row comes
back once, repeated rows too; an empty table or delivery gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import staged
from tidemart.session import fresh_dir
from tidemart.sources.folders import exists, numbered_folders

STATE_STORE = "spark.sql.streaming.stateStore"
STATE_CONF = {
    f"{STATE_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # There are as many stores as shuffle partitions, most of them small: reserve no disk ahead
    # for each, and save the changes of a micro-batch instead of whole files.
    f"{STATE_STORE}.rocksdb.allowFAllocate": "false",
    f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Distinct digests (32 bytes each) that may be broadcast to pick the hits' texts.
BROADCAST_DIGESTS = 200_000

FILES_PER_TRIGGER = 512


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normalised(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), digest(text).alias("digest"))


def written_once(rows: DataFrame, folder: str, delivery: int) -> DataFrame:
    """A delivery's rows as they were first written; then what has been written of all deliveries is read."""
    spark = rows.sparkSession
    if delivery not in numbered_folders(spark, folder, "delivery"):
        rows.write.mode("overwrite").parquet(f"{folder}/delivery={delivery}")
    columns = T.StructType([*rows.schema.fields, T.StructField("delivery", T.IntegerType())])
    return spark.read.schema(columns).parquet(folder)


def update_state(feed: DataFrame, folder: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Stream what is new in the folder's feed through the keyed state; one row per digest comes back.

    Columns: digest, group_size, best (doc_id, delivery and seq of the row that stays).  Every
    micro-batch writes the state rows it changed into a folder of its own, which a retry replaces.
    """
    spark, out = feed.sparkSession, f"{folder}/changes"

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.groupBy("digest").agg(
            F.count("*").alias("group_size"), F.max(F.struct("doc_id", "delivery", "seq")).alias("best")
        )

    stream = grouped(
        spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{folder}/feed")
    )

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        query = (
            stream.writeStream.outputMode("update")
            .foreachBatch(save)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    if not exists(spark, out):
        return grouped(feed.limit(0))
    # A digest's counts only grow, so its last state is its largest.
    return (
        spark.read.schema(grouped(feed).schema)
        .parquet(out)
        .groupBy("digest")
        .agg(F.max("group_size").alias("group_size"), F.max("best").alias("best"))
    )


def confirmed(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """(digest, text) of the hits, one row per different text: whole byte strings are compared."""
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    hits = rows.join(repeated.select("digest"), "digest", "left_semi")
    return hits.groupBy("digest", "text").agg(F.count("*").alias("n"))


def find_copies(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, state: str | None = None, delivery: int = 0, **stream
) -> DataFrame:
    """Return per row of this delivery: doc_id, digest, keep_id, group_size, kept.

    ``state`` is a folder that all executors reach; groups then span all its deliveries, of which each
    has a number of its own.
    """
    folder = state or fresh_dir(docs.sparkSession, "dedup-state")
    mine = F.col("delivery") == delivery
    rows = normalised(docs, digest)
    texts = written_once(rows, f"{folder}/texts", delivery) if state else rows.withColumn("delivery", F.lit(delivery))
    places = texts.filter(mine).select(F.monotonically_increasing_id().alias("seq"), "doc_id", "digest")
    whole_feed = written_once(places, f"{folder}/feed", delivery)
    feed = whole_feed.filter(mine)
    groups = staged(update_state(whole_feed, folder, **stream), "dedup-groups")
    repeated = groups.filter("group_size > 1")
    clashing = staged(
        confirmed(texts, repeated.select("digest")).groupBy("digest").count().filter("count > 1").select("digest"),
        "dedup-clashes",
    )
    # Rows alone with their digest need no partner; only the others meet their state.
    found = (
        feed.join(repeated.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left")
        .select(
            "doc_id", "digest",
            F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (F.col("of").isNull() | ((F.col("best.delivery") == delivery) & (F.col("best.seq") == F.col("seq")))).alias("kept"),
        )
    )
    if clashing.isEmpty():
        return found
    return found.join(clashing, "digest", "left_anti").unionByName(by_text(texts, clashing).filter(mine).drop("delivery"))


def by_text(rows: DataFrame, clashing: DataFrame) -> DataFrame:
    """The same columns for digests that different texts share, grouped by whole text."""
    theirs = staged(
        rows.join(clashing, "digest", "left_semi").withColumn("seq", F.monotonically_increasing_id()),
        "dedup-clashing",
    )
    best = theirs.groupBy("digest", "text").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "delivery", "seq")).alias("best")
    )
    return theirs.join(best, ["digest", "text"]).select(
        "doc_id", "delivery", "digest", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.seq") == F.col("seq")).alias("kept"),
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The documents without exact copies; all columns stay.

    Rows equal in doc_id and text are one document: one of them stays.
    """
    found = find_copies(docs).filter(~F.col("kept"))
    gone = staged(
        found.select(
            F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("_one_stays"),
        ).distinct(),
        "dedup-gone",
    )
    text = F.coalesce(docs["text"], F.lit(""))

    def among(some: DataFrame) -> tuple[DataFrame, Column]:
        if some.count() <= BROADCAST_DIGESTS:
            some = F.broadcast(some)
        return some, docs["doc_id"].eqNullSafe(some["_gone_id"]) & (sha256(text) == some["_gone_digest"])

    others, repeats = gone.filter(~F.col("_one_stays")), gone.filter("_one_stays")
    rest = docs.join(*among(others), "left_anti")
    if repeats.isEmpty():
        return rest
    once = (
        docs.join(*among(repeats), "left_semi")
        .groupBy(docs["doc_id"].alias("_id"), text.alias("_text"))
        .agg(F.first(F.struct(*docs.columns)).alias("_row"))
        .select("_row.*")
    )
    return rest.join(*among(repeats), "left_anti").unionByName(once)
