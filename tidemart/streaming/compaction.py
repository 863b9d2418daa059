"""Keyed updates of a stream as one snapshot and one folder of changes, whatever the number of micro-batches.

``base/through=B`` holds the newest row of every key up to micro-batch B, ``changes/through=N`` the
newest row of the keys changed in B+1..N.  A micro-batch merges its updates into the changes; every
``every`` batches the changes are merged into the base.  Readers take the newest complete folder of
each kind, so they read two folders at most, and a batch costs what changed since the last base.

A folder counts once Spark has marked it complete.  A retried batch starts from the folders before
it and replaces its own.  Folders that have been replaced twice are removed: a reader that has just
listed the ones before still finds them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.sources.folders import numbered_folders, remove_folder

BASE, CHANGES, THROUGH = "base", "changes", "through"
_STEP = "__step"


@dataclass(frozen=True)
class State:
    """The folders to read: numbers of the last micro-batch they hold, -1 for none."""

    base: int
    changes: int


def _state(spark: SparkSession, path: str, before: int | None = None) -> State:
    def last(kind: str) -> int:
        found = numbered_folders(spark, f"{path}/{kind}", THROUGH)
        return max((n for n in found if before is None or n < before), default=-1)

    base, changes = last(BASE), last(CHANGES)
    return State(base, changes if changes > base else -1)


def _folder(path: str, kind: str, through: int) -> str:
    return f"{path}/{kind}/{THROUGH}={through}"


def _merged(parts: list[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The newest row of each key.  Every part holds a key once, so at most a few rows meet per key."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    if len(parts) == 1:
        return rows
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), _STEP).alias("row"))
    return newest.select(*keys, *[F.col("row")[c].alias(c) for c in rest])


def store_batch(updates: DataFrame, batch_id: int, path: str, keys: Sequence[str], every: int) -> None:
    """Merge the updated rows of a micro-batch (one per key) into the table."""
    spark = updates.sparkSession
    state = _state(spark, path, batch_id)
    parts = [updates.withColumn(_STEP, F.lit(batch_id).cast("long"))]
    if state.changes >= 0:
        parts.append(spark.read.schema(parts[0].schema).parquet(_folder(path, CHANGES, state.changes)))
    full = batch_id - state.base >= every
    if full and state.base >= 0:
        parts.append(spark.read.schema(parts[0].schema).parquet(_folder(path, BASE, state.base)))
    kind = BASE if full else CHANGES
    _merged(parts, keys).write.mode("overwrite").parquet(_folder(path, kind, batch_id))
    for old in (BASE, CHANGES):
        kept = {batch_id, state.base if old == BASE else state.changes}
        for through in numbered_folders(spark, f"{path}/{old}", THROUGH):
            if through < batch_id and through not in kept:
                remove_folder(spark, _folder(path, old, through))


def write_compacted(
    updates: DataFrame, path: str, checkpoint: str, trigger: dict, keys: Sequence[str], every: int = 20
) -> StreamingQuery:
    """Keep the newest row per key of an update-mode stream."""
    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, path, keys, every))
        .trigger(**trigger)
        .start()
    )


def read_compacted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key; reads the snapshot and one folder of changes."""
    state = _state(spark, path)
    places = [(BASE, state.base), (CHANGES, state.changes)]
    parts = [spark.read.parquet(_folder(path, kind, n)) for kind, n in places if n >= 0]
    if not parts:
        raise FileNotFoundError(f"no micro-batch has been stored below {path}")
    return _merged(parts, keys).drop(_STEP)
