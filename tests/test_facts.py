"""M9-M11 and the incremental cases I1-I4, S7, S8, S12, X6."""

import datetime as dt

import pytest

from reelspark.operators.upsert import (DuplicateKeyError, SchemaChangeError, check_lookback,
                                        merge_upsert)
from reelspark.plans import facts

RSCHEMA = "user_id long, movie_id long, rating double, rating_timestamp timestamp"


def D(day, h=0, m=0):
    return dt.datetime(2020, 1, day, h, m)


def ratings(spark, rows):
    return spark.createDataFrame(rows, RSCHEMA)


def test_w1_w2_range_frames_count_calendar_days(spark):
    r = ratings(spark, [(1, 7, 4.0, D(1)), (2, 7, 3.0, D(2)), (3, 7, 5.0, D(8)), (4, 7, 1.0, D(30))])
    out = facts.movie_rating_daily(r).orderBy("rating_date").collect()
    assert [x.n_ratings_7d for x in out] == [1, 2, 2, 1]
    assert [x.n_ratings_28d for x in out] == [1, 2, 3, 2]
    # volume-weighted 28-day mean: day 30 sees days 3..30 -> days 8 and 30
    assert out[3].avg_rating_28d == 3.0
    assert out[2].avg_rating_28d == 4.0


def test_w3_weighted_mean_weights_by_daily_volume(spark):
    rows = [(u, 1, 5.0, D(1)) for u in range(4)] + [(9, 1, 1.0, D(2))]
    out = facts.movie_rating_daily(ratings(spark, rows)).orderBy("rating_date").collect()
    assert out[1].avg_rating_28d == round((4 * 5.0 + 1.0) / 5, 4)
    assert out[0].avg_rating == 5.0 and out[1].avg_rating == 1.0


def test_merge_upsert_replaces_inserts_never_deletes(spark):
    t = ratings(spark, [(1, 1, 1.0, D(1)), (1, 2, 2.0, D(1))])
    s = ratings(spark, [(1, 1, 5.0, D(3)), (2, 1, 4.0, D(3))])
    out = sorted(tuple(r) for r in merge_upsert(t, s, ["user_id", "movie_id"]).collect())
    assert out == [(1, 1, 5.0, D(3)), (1, 2, 2.0, D(1)), (2, 1, 4.0, D(3))]


def test_s7_duplicate_source_keys_raise(spark):
    t = ratings(spark, [(1, 1, 1.0, D(1))])
    s = ratings(spark, [(1, 1, 5.0, D(3)), (1, 1, 4.0, D(3))])
    with pytest.raises(DuplicateKeyError):
        merge_upsert(t, s, ["user_id", "movie_id"])


def test_s12_schema_change_raises(spark):
    t = ratings(spark, [(1, 1, 1.0, D(1))])
    extra = spark.createDataFrame([(1, 1, 1.0, D(1), "x")], RSCHEMA + ", note string")
    retyped = spark.createDataFrame([(1, 1, "1", D(1))],
                                    "user_id long, movie_id long, rating string, rating_timestamp timestamp")
    for bad in (extra, retyped):
        with pytest.raises(SchemaChangeError):
            merge_upsert(t, bad, ["user_id", "movie_id"])


def test_s8_row_at_the_mark_loaded_once(spark):
    target = ratings(spark, [(1, 1, 3.0, D(5))])
    src = ratings(spark, [(1, 1, 3.0, D(5)), (2, 1, 4.0, D(5)), (3, 1, 2.0, D(4))])
    out = facts.fct_ratings_incremental(target, src)
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [(1, 1, 3.0, D(5)), (2, 1, 4.0, D(5))]    # (3,1) is late: skipped (I1)


def test_i1_late_row_loaded_with_lookback(spark):
    target = ratings(spark, [(1, 1, 3.0, D(5))])
    src = ratings(spark, [(1, 1, 3.0, D(5)), (3, 1, 2.0, D(4))])
    out = facts.fct_ratings_incremental(target, src, lookback=dt.timedelta(days=2))
    assert out.count() == 2


def test_i4_empty_target_is_first_run(spark):
    empty = ratings(spark, [])
    src = ratings(spark, [(1, 1, 3.0, D(5)), (2, 1, 4.0, D(1))])
    assert facts.fct_ratings_incremental(empty, src).count() == 2
    daily_empty = facts.movie_rating_daily(empty)
    assert facts.movie_rating_daily_incremental(daily_empty, src).count() == 2


def test_i2_first_build_keeps_duplicates_unless_deduped(spark):
    src = spark.createDataFrame(
        [(1, 1, 3.0, D(5), 10), (1, 1, 4.0, D(5), 11), (1, 1, 1.0, D(2), 12)],
        RSCHEMA + ", seq long")
    assert facts.fct_ratings_full(src).count() == 3
    latest = facts.fct_ratings_full(src, dedupe=True, tiebreak=["seq"]).collect()
    assert [(r.rating, r.rating_timestamp) for r in latest] == [(4.0, D(5))]


def test_i3_rerating_leaves_stale_day_unless_delete_window(spark):
    before = ratings(spark, [(1, 1, 3.0, D(10)), (2, 1, 4.0, D(12))])
    target = facts.movie_rating_daily(before)
    # user 1 re-rates film 1 on day 14: fct_ratings now has no row on day 10
    after = ratings(spark, [(1, 1, 5.0, D(14)), (2, 1, 4.0, D(12))])
    default = facts.movie_rating_daily_incremental(target, after)
    fixed = facts.movie_rating_daily_incremental(target, after, delete_window=True)
    assert sorted(r.rating_date.day for r in default.collect()) == [10, 12, 14]
    assert sorted(r.rating_date.day for r in fixed.collect()) == [12, 14]
    full = {(r.rating_date, r.n_ratings_28d) for r in facts.movie_rating_daily(after).collect()}
    assert {(r.rating_date, r.n_ratings_28d) for r in fixed.collect()} == full


def test_x6_lookback_must_cover_window():
    check_lookback(56, 28, 28)
    with pytest.raises(ValueError):
        check_lookback(40, 28, 28)


def test_daily_incremental_equals_full_refresh_on_time_ordered_batches(spark):
    rows = [(u, u % 3, float(1 + u % 5), dt.datetime(2020, 1, 1) + dt.timedelta(days=u % 90, hours=u % 7))
            for u in range(300)]
    allr = ratings(spark, rows)
    cut = dt.datetime(2020, 2, 15)
    first = allr.where(allr.rating_timestamp < cut)
    t1 = facts.movie_rating_daily(first)
    inc = facts.movie_rating_daily_incremental(t1, allr)
    full = facts.movie_rating_daily(allr)
    assert sorted(tuple(r) for r in inc.collect()) == sorted(tuple(r) for r in full.collect())


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 120),
                          st.sampled_from([0.5, 1.0, 3.5, 5.0])), min_size=1, max_size=40,
                unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 119))
def test_property_incremental_equals_full_refresh(spark, events, cut_day):
    """Unique (user, film) keys, any time-ordered split into two runs: both
    incremental facts equal their full refresh, and n_28d >= n_7d >= n."""
    base = dt.datetime(2020, 1, 1)
    rows = [(u, f, r, base + dt.timedelta(days=d, hours=u)) for u, f, d, r in events]
    allr = ratings(spark, rows)
    cut = base + dt.timedelta(days=cut_day)
    first = allr.where(allr.rating_timestamp < cut)
    t1 = facts.fct_ratings_incremental(None, first)
    inc = facts.fct_ratings_incremental(t1, allr)
    assert sorted(tuple(r) for r in inc.collect()) == sorted(tuple(r) for r in allr.collect())
    d1 = facts.movie_rating_daily(t1)
    d2 = facts.movie_rating_daily_incremental(d1, inc)
    full = facts.movie_rating_daily(allr).collect()
    assert sorted(tuple(r) for r in d2.collect()) == sorted(tuple(r) for r in full)
    assert all(r.n_ratings_28d >= r.n_ratings_7d >= r.n_ratings for r in full)
