"""Hand-made document tables."""

from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def table(spark, rows, extra=()):
    """Documents of (doc_id, text) rows; extra: names of further columns that clash with results."""
    schema = T.StructType([*DOCUMENT.fields, *(T.StructField(x, T.StringType()) for x in extra)])
    return spark.createDataFrame([(i, t, None, None, None, *["x"] * len(extra)) for i, t in rows], schema)


def written(path, df):
    """A folder as the queries take it."""
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)
