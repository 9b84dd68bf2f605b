"""Retention from stored bitmaps and sketches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from reelspark.plans import dims, marts, retention


def _ratings(spark, rows):
    return (spark.createDataFrame(rows, "user_id long, movie_id long, rating double, ts string")
            .select("user_id", "movie_id", "rating", F.col("ts").cast("timestamp").alias("rating_timestamp")))


def _users(ratings):
    activity = ratings.groupBy("user_id").agg(F.count("*").alias("n_ratings"), F.avg("rating").alias("avg_rating_given"),
                                              F.min("rating_timestamp").alias("first_rating_at"), F.max("rating_timestamp").alias("last_rating_at"))
    tags = activity.sparkSession.createDataFrame([], "user_id long, n_tags long, first_tag_at timestamp, last_tag_at timestamp")
    return dims.dim_users_from_activity(activity, tags)


FIRST = ([(u, u % 7, 4.0, f"2020-0{1 + u % 3}-03") for u in range(1, 400)] + [(u, 1, 3.0, "2020-05-01") for u in range(1, 400, 2)]
         + [(9, k, 3.0, "2020-02-02 10:00:00") for k in range(3000)]                                   # a hot user
         + [(40_000, 1, 3.0, "2020-01-05"), (32_768, 1, 3.0, "2020-01-05"), (32_769, 1, 3.0, "2020-01-05"), (-5, 1, 3.0, "2020-01-05"), (0, 1, 3.0, "2020-01-05")]
         + [(None, 1, 3.0, "2020-01-05"), (77, 1, 3.0, None)])
SECOND = [(u, 2, 3.0, "2020-06-01") for u in range(1, 400, 3)] + [(5, 2, 3.0, "2019-12-30"), (500, 1, 2.0, "2020-01-09"), (9, 1, 1.0, "2020-01-31")]  # late ones too


def _rows(df):
    return sorted(map(tuple, df.select("cohort_month", "months_since_first_rating", "cohort_size", "active_users", "retention_rate").collect()))


def test_bridge_equals_the_exact_mart_after_two_loads_and_a_replay(spark, tmp_base):
    first, second = _ratings(spark, FIRST), _ratings(spark, SECOND)
    path, both = os.path.join(tmp_base, "bridge"), first.unionByName(second)
    retention.add_to_bridge(first, path)
    retention.add_to_bridge(second, path)
    retention.add_to_bridge(second, path)                      # a replayed load changes nothing
    bridge = retention.held(spark, path, retention.BRIDGE)
    assert bridge.groupBy("activity_month", "bucket").count().where("count > 1").isEmpty()
    users, both = _users(both), both.where("rating_timestamp IS NOT NULL")
    assert _rows(retention.retention_from_bridge(users, bridge)) == _rows(marts.mart_user_cohort_retention(users, both))
    want = {(r[0]): r[1] for r in both.where("user_id IS NOT NULL AND rating_timestamp IS NOT NULL")
            .groupBy(F.trunc("rating_timestamp", "month")).agg(F.countDistinct("user_id")).collect()}
    assert {r.activity_month: r.active_users for r in retention.active_users(bridge).collect()} == want


def test_a_load_rewrites_the_months_it_touches_only(spark, tmp_base):
    path = os.path.join(tmp_base, "bridge")
    retention.add_to_bridge(_ratings(spark, FIRST), path)
    files = lambda: {os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    retention.add_to_bridge(_ratings(spark, [(1, 1, 2.0, "2020-02-09")]), path)
    gone = {f.split("activity_month=")[1][:10] for f in before - files()}
    assert gone == {"2020-02-01"}


def test_sketches_follow_users_to_their_cohort_and_stay_within_their_error(spark, tmp_base):
    first, second = _ratings(spark, FIRST), _ratings(spark, SECOND)
    path, both = os.path.join(tmp_base, "sketches"), first.unionByName(second)
    before, after = _users(first), _users(both)
    first, both = first.where("rating_timestamp IS NOT NULL"), both.where("rating_timestamp IS NOT NULL")
    retention.add_to_sketches(before, first, path)
    moved = retention.moved_cohorts(before, after)
    assert dt.date(2019, 12, 1) in moved
    retention.sketch_again(after, first, path, moved)
    for _ in range(2):
        retention.add_to_sketches(after, second, path)
    found = retention.retention_from_sketches(after, retention.held(spark, path, retention.SKETCHES))
    exact = {r[:2]: r[2:] for r in _rows(marts.mart_user_cohort_retention(after, both))}
    got = {r[:2]: r[2:] for r in _rows(found)}
    assert set(got) == set(exact)
    for k, (size, active, rate) in got.items():
        assert size == exact[k][0] and abs(active - exact[k][1]) <= 3 * retention.RSD * exact[k][1] and 0 < rate <= 1


def test_sketches_need_no_distinct_users(spark, tmp_base):
    path, ratings = os.path.join(tmp_base, "sketches"), _ratings(spark, FIRST)
    users = _users(ratings)
    users.write.parquet(os.path.join(tmp_base, "users"))
    users = spark.read.parquet(os.path.join(tmp_base, "users"))
    load = retention.sketch_load(users, ratings)
    retention.add(load, path, retention.SKETCHES, retention.merge_sketches)
    for df in (load, retention.retention_from_sketches(users, retention.held(spark, path, retention.SKETCHES))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        aggregates = [line for line in plan.splitlines() if "Aggregate [" in line]
        assert aggregates and all("user_id" not in line.split("Aggregate [")[1].split("]")[0] for line in aggregates)


def test_empty_loads_and_sketch_sizes(spark, tmp_base):
    path = os.path.join(tmp_base, "bridge")
    assert retention.active_users(retention.held(spark, path, retention.BRIDGE)).isEmpty()
    retention.add_to_bridge(_ratings(spark, FIRST).where("false"), path)
    assert retention.active_users(retention.held(spark, path, retention.BRIDGE)).isEmpty()
    assert retention.sketch_size(0.02) == 12 and retention.sketch_size(0.01) == 14
    with pytest.raises(ValueError):
        retention.sketch_size(1e-9)


def _counted(spark, df):
    """The rows, and how many have been read of them in all."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema), seen


def test_a_load_is_read_once(spark, tmp_base):
    for add, extra in ((retention.add_to_bridge, ()), (retention.add_to_sketches, (_users(_ratings(spark, FIRST)),))):
        ratings, seen = _counted(spark, _ratings(spark, FIRST))
        add(*extra, ratings, os.path.join(tmp_base, add.__name__))
        assert seen.value == len(FIRST)


@pytest.mark.parametrize("name", ["retention_approx", "retention_sketch_bounds"])
def test_two_loads_of_sketches_stage_the_ratings_once(spark, monkeypatch, name):
    from reelspark.plans import catalog, inputs
    rows = [(*r, "1998-05-01") for r in FIRST if None not in r] + [(*r, "1998-07-01") for r in SECOND]
    staged = (spark.createDataFrame(rows, "user_id long, movie_id long, rating double, ts string, at string")
              .select("user_id", "movie_id", "rating", F.col("ts").cast("timestamp").alias("rating_timestamp"), F.col("at").cast("timestamp").alias("arrived_at")))
    ratings, seen = _counted(spark, staged)
    tags = spark.createDataFrame([(1, 1, "a", dt.datetime(2020, 1, 1))], "user_id long, movie_id long, tag string, tag_timestamp timestamp")
    monkeypatch.setattr(inputs, "ratings", lambda *_, **__: ratings)
    monkeypatch.setattr(inputs, "tags", lambda *_: tags)
    found = catalog.queries()[name](spark, "").collect()
    assert seen.value == len(rows)
    want = marts.mart_user_cohort_retention(_users(staged), staged).collect()
    assert {(r.cohort_month, r.months_since_first_rating) for r in found} == {(r.cohort_month, r.months_since_first_rating) for r in want}
    if name == "retention_sketch_bounds":
        assert all(r.within_bound for r in found)
