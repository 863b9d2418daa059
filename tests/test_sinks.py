"""Catalog, sinks and publishing."""

import datetime as dt

from pyspark.sql import functions as F

from tidemart.session import cut_lineage, fresh_dir
from tidemart.plans import queries as registry
from tidemart.plans.gold import build_seed, publish
from tidemart.schemas import SILVER_TABLES, TRANSACTIONS
from tidemart.sources import catalog, sinks


def test_append_twice_writes_once(spark):
    path = fresh_dir(spark, "t-append")
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert sinks.append_new(rows, path, ["k"]) == 2
    assert sinks.append_new(rows, path, ["k"]) == 0
    more = rows.union(spark.createDataFrame([(3, "c")], rows.schema))
    assert sinks.append_new(more, path, ["k"]) == 1
    assert spark.read.parquet(path).count() == 3


def test_overwrite_replaces_only_its_partitions(spark):
    path = fresh_dir(spark, "t-overwrite")
    first = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3)], "day string, v int")
    assert sinks.overwrite_partitions(first, path, ["day"]) == 3
    assert sinks.overwrite_partitions(spark.createDataFrame([("d1", 9)], first.schema), path, ["day"]) == 1
    got = sorted((r.day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("d1", 9), ("d2", 3)]


def test_incremental_read_prunes_partitions(spark):
    path = fresh_dir(spark, "t-bronze")
    rows = [(i, dt.date(2025, 1, 1 + i)) for i in range(5)]
    spark.createDataFrame(rows, "id int, ingestion_date date").write.partitionBy("ingestion_date").parquet(path)
    recent = catalog.read_since(spark, path, "2025-01-04")
    assert sorted(r.id for r in recent.collect()) == [3, 4]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_schema_evolution(spark):
    path = fresh_dir(spark, "t-merge")
    spark.range(1).select(F.lit(1).alias("a")).write.parquet(path)
    spark.range(1).select(F.lit(1).alias("a"), F.lit("x").alias("b")).write.mode("append").parquet(path)
    merged = catalog.read_table(spark, path, merge_schema=True)
    assert merged.columns == ["a", "b"] and merged.count() == 2


def test_conform_and_ensure_table(spark):
    raw = spark.createDataFrame([("o", "12.345")], "order_id string, total_amount string")
    shaped = catalog.conform(raw, TRANSACTIONS)
    assert shaped.schema == TRANSACTIONS
    row = shaped.collect()[0]
    assert str(row.total_amount) == "12.35" and row.city is None
    for name, schema in SILVER_TABLES.items():
        catalog.ensure_table(spark, f"t_silver_{name}", schema)
        catalog.ensure_table(spark, f"t_silver_{name}", schema)
        assert spark.table(f"t_silver_{name}").columns == schema.names
        spark.sql(f"DROP TABLE t_silver_{name}")


def test_freshness_and_presence(spark, sf_dir):
    tables = {"orders": catalog.Tables(spark, sf_dir).orders}
    newest = catalog.file_freshness(tables).collect()[0].newest_file
    late = catalog.file_freshness(tables, newest + dt.timedelta(hours=3)).collect()[0]
    assert late.age_hours == 3.0 and not late.is_fresh
    assert catalog.file_freshness(tables, newest + dt.timedelta(hours=2)).collect()[0].is_fresh
    empty = spark.createDataFrame([], "a int")
    assert [r.has_rows for r in catalog.presence({"empty": empty}).collect()] == [False]


def test_publish_matches_the_lazy_chain(spark, sf_dir):
    shop = registry.Shop(spark, sf_dir)
    as_of = dt.date(2001, 8, 2)
    settled = {name: cut_lineage(df) for name, df in shop.sources.items()}
    written = publish(settled, as_of, prefix="t_")
    assert len(written) == 8
    lazy = registry.build_gold(settled, as_of)
    try:
        for name in ("fct_orders", "agg_daily_revenue", "agg_rfm_scores", "agg_churn_features"):
            stored = spark.table(f"t_{name}")
            assert "built_at" in stored.columns
            stored = stored.drop("built_at").select(*lazy[name].columns)
            assert stored.exceptAll(lazy[name]).count() == 0 and stored.count() == lazy[name].count()
    finally:
        for name in written:
            spark.sql(f"DROP TABLE {name}")


def test_build_seed_names(spark, sf_dir):
    shop = registry.Shop(spark, sf_dir)
    gold = build_seed({**shop.sources, "transactions": shop.lines}, shop.as_of)
    assert set(gold) == {
        "dim_customers", "dim_products", "fct_orders", "agg_daily_revenue", "agg_rfm_scores",
        "agg_cohort_retention", "agg_funnel", "agg_churn_features",
    }
    revenue = gold["dim_products"].agg(F.sum("total_revenue")).collect()[0][0]
    assert revenue == gold["agg_daily_revenue"].agg(F.sum("total_revenue")).collect()[0][0]


def test_jdbc_options():
    options = sinks.jdbc_options("jdbc:x", "silver.t", {"user": "u"}, 5000)
    assert options == {"url": "jdbc:x", "dbtable": "silver.t", "batchsize": "5000", "user": "u"}


def test_silver_partitions_are_replaced(spark):
    from tidemart.plans import silver

    root = fresh_dir(spark, "t-silver")
    rows = [(str(i), dt.date(2025, 1, 1 + i % 3)) for i in range(9)]
    table = spark.createDataFrame(rows, "order_id string, order_date date")
    parts = {"transactions": ["order_date"]}
    assert silver.write_silver({"transactions": table}, root, parts) == {"transactions": 9}
    again = table.filter("order_date = '2025-01-02'").limit(1)
    assert silver.write_silver({"transactions": again}, root, parts) == {"transactions": 1}
    stored = spark.read.parquet(f"{root}/transactions")
    assert stored.groupBy("order_date").count().orderBy("order_date").toPandas()["count"].tolist() == [3, 1, 3]
    assert stored.filter("ingested_at is null").count() == 0


def test_missing_bronze_is_reported(spark):
    import pytest

    from tidemart.plans import silver

    full, empty = spark.range(1), spark.range(0)
    silver.require_bronze({"orders": full})
    with pytest.raises(ValueError, match="inventory"):
        silver.require_bronze({"orders": full, "inventory": empty})


def test_bronze_reader(spark):
    from tidemart.plans import silver

    root = fresh_dir(spark, "t-bronze-root")
    for name in silver.BRONZE_TABLES:
        rows = [(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2))]
        df = spark.createDataFrame(rows, "id int, ingestion_date date")
        df.write.partitionBy("ingestion_date").parquet(f"{root}/{name}")
    assert silver.read_bronze(spark, root)["orders"].count() == 2
    assert silver.read_bronze(spark, root, since="2025-01-02")["inventory"].count() == 1


def test_append_reads_only_the_parts_that_overlap(spark):
    path = fresh_dir(spark, "t-ranges")

    def add(low, high, note="x"):
        rows = spark.createDataFrame([(i, note) for i in range(low, high)] + [(low, note), (None, note)], "id long, note string")
        return sinks.append_new_by_range(rows, path, "id")

    assert add(0, 10) == (10, [])
    assert add(10, 20) == (10, [])  # ranges do not overlap: nothing is read
    assert add(20, 30) == (10, [])
    assert add(25, 35, "again") == (5, ["part=2"])
    assert add(0, 10) == (0, ["part=0"])  # a re-run writes nothing
    assert add(5, 27) == (0, ["part=0", "part=1", "part=2"])
    stored = spark.read.schema("id long, note string").parquet(path)
    assert sorted(r.id for r in stored.collect()) == list(range(35))
    # A part whose range was never noted is read whatever the keys.
    spark.createDataFrame([(99, "y")], "id long, note string").write.parquet(f"{path}/part=77")
    assert add(99, 101) == (1, ["part=77"])
    assert sinks.append_new_by_range(stored.limit(0), path, "id") == (0, [])


def test_freshness_from_the_listing(spark):
    path = fresh_dir(spark, "t-listed")
    days = [(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2))]
    spark.createDataFrame(days, "id long, ingestion_date date").write.partitionBy("ingestion_date").parquet(path)
    table = spark.read.parquet(path)
    now = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    by_row = catalog.file_freshness({"t": table}, now).collect()
    assert catalog.listed_freshness(spark, {"t": path}, now).collect() == by_row and by_row[0].is_fresh
    newest = catalog.listed_freshness(spark, {"t": path}, now, partition="ingestion_date", max_age_hours=0.5)
    assert [(r.table_name, r.is_fresh) for r in newest.collect()] == [("t", False)]
    none = fresh_dir(spark, "t-none")
    spark.createDataFrame([], "id long").write.partitionBy().parquet(none)
    assert catalog.listed_freshness(spark, {"n": none}, now, pattern="*.none").collect()[0].is_fresh is False
