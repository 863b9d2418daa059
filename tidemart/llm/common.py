"""Reading documents, shared staging tables, and small text helpers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import configure, fresh_dir

#: Rows and bytes of a table in one Arrow batch.  Texts may be long, so batches stay small; a row
#: beyond the bytes is a batch of its own.
ARROW_ROWS, ARROW_BYTES = "1000", str(4 << 20)

#: White space of the word rules of this package, as bytes 0x20 and 0x09 to 0x0D.
SPACES = "[\\x20\\x09-\\x0D]"


#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """The runtime settings that the operators of this package rely on.

    Python workers import this package; they look for it where the driver found it, besides the
    places that the cluster has been given (spark-submit --py-files).
    """
    configure(spark)
    places = [x for x in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if ROOT not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*places, ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of a column as text, modulo buckets; 0 where the column is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % buckets, F.lit(0))


def emptied(run: Callable, *forget: Callable[[], None]) -> Callable:
    """A function of Arrow batches after whose partition a worker holds on to nothing.

    Workers live on from stage to stage.  ``forget`` are functions of a module, which empty what that
    module remembers; Arrow's unused memory goes back to the system.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for one in forget:
                one()
            pa.default_memory_pool().release_unused()

    return whole


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Cut a text after spaces or line ends into parts of about size characters.

    A part without such a place grows until there is one, so no word is cut.
    """
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(" ", start, start + size), text.rfind("\n", start, start + size)) + 1
        if cut <= start:
            ends = [x for x in (text.find(" ", start + size), text.find("\n", start + size)) if x >= 0]
            if not ends:
                break
            cut = min(ends) + 1
        yield text[start:cut]
        start = cut
    yield text[start:]
