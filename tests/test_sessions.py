"""Sessions, funnel steps and experiment groups."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from tidemart.operators import experiments, sessions

START = dt.datetime(2025, 1, 1)
COLUMNS = "event_id long, user_id long, timestamp timestamp, event_type string, device_type string, country string"


def _events(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


def test_gap_sessions_match_a_walk_over_the_events(spark):
    rnd = random.Random(1)
    gap = 600
    rows, moment = [], {1: START, 2: START, 3: START}
    for i in range(400):
        user = rnd.choice([1, 1, 1, 2, 3])
        moment[user] += dt.timedelta(seconds=rnd.choice([0, 5, 599, 600, 601, 3000]))
        rows.append((i, user, moment[user], "page_view", "mobile", "X"))
    expected = []
    for user in (1, 2, 3):
        last = None
        for _, u, ts, *_ in rows:
            if u != user:
                continue
            if last is None or (ts - last).total_seconds() > gap:
                expected.append([user, ts, ts, 0])
            expected[-1][2], expected[-1][3] = ts, expected[-1][3] + 1
            last = ts
    got = sessions.sessionize_by_gap(_events(spark, rows), gap)
    keyed = sorted((r.user_id, r.start_time, r.end_time, r.page_views) for r in got.collect())
    assert keyed == sorted(tuple(e) for e in expected)
    by_id = sessions.sessionize(sessions.assign_sessions(_events(spark, rows), gap))
    assert sorted(by_id.collect()) == sorted(got.collect())


def test_disagreeing_device_and_country_take_the_earliest_event(spark):
    rows = [
        (2, 1, START + dt.timedelta(seconds=1), "add_to_cart", "desktop", "B"),
        (1, 1, START, "product_view", "mobile", "A"),
        (3, 1, START + dt.timedelta(seconds=9), "checkout_complete", "tablet", "C"),
    ]
    events = _events(spark, rows).withColumn("session_id", F.lit("s"))
    got = sessions.sessionize(events).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.device_type, row.country, row.page_views, row.duration_seconds) == ("mobile", "A", 3, 9)
    assert row.converted and row.products_viewed == 1 and row.add_to_cart_count == 1


def test_funnel_steps(spark):
    rows = [
        (1, 1, START, "page_view", "m", "X"),
        (2, 1, START, "add_to_cart", "m", "X"),
        (3, 2, START, "product_view", "m", "X"),
    ]
    events = _events(spark, rows).withColumn("session_id", F.col("user_id").cast("string"))
    reach = {r.step: (r.sessions_reached, r.reach_pct) for r in sessions.funnel_steps(events).collect()}
    assert reach["page_view"] == (2, 100.0) and reach["product_view"] == (2, 100.0)
    assert reach["add_to_cart"] == (1, 50.0) and reach["checkout_complete"] == (0, 0.0)
    furthest = {r.session_id: r.furthest_step for r in sessions.funnel_progress(events).collect()}
    assert furthest == {"1": "add_to_cart", "2": "product_view"}


def _table(spark, a, b, c, d):
    names = ["control_converted", "control_not_converted", "treatment_converted", "treatment_not_converted"]
    return spark.createDataFrame([(a, b, c, d)], names)


def test_chi_squared(spark):
    equal = experiments.significance(_table(spark, 10, 90, 10, 90)).collect()[0]
    assert equal.chi2 == 0.0 and equal.p_value == 1.0 and not equal.significant
    # By hand: 100 * (|10*40 - 20*30| - 50)^2 / (30*70*40*60), and p = 2 (1 - Phi(0.66815)).
    known = experiments.significance(_table(spark, 10, 20, 30, 40)).collect()[0]
    assert round(known.chi2, 4) == 0.4464 and round(known.p_value, 3) == 0.504
    empty = experiments.significance(_table(spark, 0, 0, 3, 4)).collect()[0]
    assert empty.chi2 is None and empty.p_value is None
    strong = experiments.significance(_table(spark, 10, 190, 60, 140)).collect()[0]
    assert strong.significant


def test_lift_and_groups(spark):
    row = experiments.lift(_table(spark, 10, 90, 15, 85)).collect()[0]
    assert (row.control_rate, row.treatment_rate, row.lift_pct) == (10.0, 15.0, 50.0)
    visits = spark.createDataFrame(
        [("a7", 1, None, None, None, 1, "m", dt.date(2025, 1, 20)), ("a8", 1, True, 1, 5, 1, "m", dt.date(2025, 1, 6)),
         ("a9", 1, True, 1, 5, 1, "m", dt.date(2025, 1, 5))],
        "session_id string, user_id long, converted boolean, add_to_cart_count long, duration_seconds long, products_viewed long, device_type string, session_date date",
    )
    got = {r.session_id: r for r in experiments.assign_groups(visits, dt.date(2025, 1, 20)).collect()}
    assert set(got) == {"a7", "a8"}
    assert got["a7"].group == "control" and got["a8"].group == "treatment"
    assert got["a7"].converted is False and got["a7"].duration_seconds == 120


def test_sessions_of_a_window_come_from_the_events_around_it(spark):
    rnd = random.Random(4)
    gap, rows, moment = 600, [], {1: START, 2: START, 3: START}
    for i in range(600):
        user = rnd.choice([1, 1, 2, 3])
        moment[user] += dt.timedelta(seconds=rnd.choice([5, 300, 599, 600, 601, 3000]))
        rows.append((i, user, moment[user], "page_view", "mobile", "X"))
    # A user who never pauses: the session lasts far beyond every window.
    rows += [(1000 + i, 9, START + dt.timedelta(seconds=500 * i), "page_view", "mobile", "X") for i in range(200)]
    events = _events(spark, rows)
    whole = sessions.sessionize_by_gap(events, gap).collect()
    for hours in ((0, 1), (3, 5), (400, 401)):
        low, high = (START + dt.timedelta(hours=h) for h in hours)
        found = sessions.sessions_started_between(events, low, high, gap)
        assert sorted(found.collect()) == sorted(r for r in whole if low <= r.start_time < high)


def test_a_window_of_sessions_reads_a_window_of_events(spark, tmp_path):
    rows = [(i, 1, START + dt.timedelta(days=i), "page_view", "m", "X") for i in range(30)]
    _events(spark, rows).write.parquet(f"{tmp_path}/e")
    found = sessions.sessions_started_between(
        spark.read.parquet(f"{tmp_path}/e"), START + dt.timedelta(days=7), START + dt.timedelta(days=8), 3600
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(timestamp,2025-01-07 23:00:00" in plan
    assert "LessThan(timestamp,2025-01-09 01:00:00" in plan
    assert [r.start_time for r in found.collect()] == [START + dt.timedelta(days=7)]


def test_error_function(spark):
    places = [0.0, 1e-9, 0.1, 0.5, 1.0, 2.0, 2.9999, 3.0, 3.5, 5.0, 8.0, 20.0]
    rows = spark.createDataFrame([(z,) for z in places], "z double").select("z", experiments.erfc(F.col("z")).alias("e"))
    for row in rows.collect():
        assert abs(row.e - math.erfc(row.z)) < 2e-15 and (row.z < 3 or abs(row.e / math.erfc(row.z) - 1) < 1e-12)
    assert spark.createDataFrame([(None,)], "z double").select(experiments.erfc(F.col("z"))).first()[0] is None
