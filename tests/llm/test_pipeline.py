from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import table, written
from tests.llm.test_minhash import brute_force
from tidemart.llm.common import documents


def test_stages_one_by_one(spark, sf_dir):
    """Each stage against its definition, on what the stage before kept."""
    docs, names = documents(spark, sf_dir), [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "exact_dedup", "minhash_near_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir).cache()
        assert after.columns == docs.columns
        assert after.exceptAll(docs).count() == 0
        before = [(r.doc_id, r.text) for r in docs.collect()]
        left = {r.doc_id for r in after.collect()}
        if name == "language_id":
            assert len(left) >= 0.97 * len(before)
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
            clean = {r.doc_id for r in labels.filter("toxic = 0").collect()} & {i for i, _ in before}
            assert len(left & clean) >= 0.97 * len(clean)
        if name == "exact_dedup":
            last = {text or "": doc for doc, text in sorted(before)}
            assert left == set(last.values())
        if name == "minhash_near_dedup":
            assert left == {row[0] for row in map(eval, brute_force(before, 80)) if row[3]}
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.count()
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert used.filter("n > 2048").isEmpty()


def test_whole_run_and_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "12 !"), (None, "the words of a document without id"), (4, "twice here"), (4, "twice here")]
    rows += [(10 + i, f"these are some words number {i} of the text") for i in range(5)]
    root = written(tmp_path, table(spark, rows, extra=("kept", "score", "node")).withColumn("lang", F.lit("en")))
    spark.createDataFrame([(10, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    found = corpus_pipeline.run(spark, root)
    kept = {row.doc_id for row in found.collect()}
    assert not {1, 2, 3} & kept
    assert found.filter("doc_id = 4").count() == 1


def test_empty_table(spark, tmp_path):
    root = written(tmp_path, table(spark, [(1, "x")]).limit(0))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0
