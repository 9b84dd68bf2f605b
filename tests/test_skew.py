"""Hot keys: one user and one film hold a third of all rows. Results must stay
exact (compared with brute force in pandas) through the skew-safe operators."""

import datetime as dt
import random

import pandas as pd

from reelspark.operators.latest import latest_per_key
from reelspark.operators.median import exact_median
from reelspark.plans import dims, facts, marts

RSCHEMA = "user_id long, movie_id long, rating double, rating_timestamp timestamp, seq long"


def skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        user = 0 if hot else rnd.randint(1, 200)
        film = 0 if hot else rnd.randint(1, 50)
        ts = base + dt.timedelta(days=rnd.randint(0, 400), hours=rnd.randint(0, 23))
        rows.append((user, film, rnd.choice([0.5, 1.0, 2.5, 4.0, 5.0]), ts, i))
    return rows


def test_latest_and_median_exact_under_skew(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, RSCHEMA)
    got = {(r.user_id, r.movie_id): (r.rating_timestamp, r.seq)
           for r in latest_per_key(df, ["user_id", "movie_id"], ["rating_timestamp", "seq"], []).collect()}
    pdf = pd.DataFrame(rows, columns=["user_id", "movie_id", "rating", "ts", "seq"])
    want = (pdf.sort_values(["ts", "seq"]).groupby(["user_id", "movie_id"]).tail(1)
            .set_index(["user_id", "movie_id"]))
    assert len(got) == len(want)
    for k, (ts, seq) in got.items():
        assert want.loc[k, "seq"] == seq
    med = {r.movie_id: r.median for r in exact_median(df, ["movie_id"], "rating").collect()}
    assert med == pdf.groupby("movie_id")["rating"].median().to_dict()


def test_daily_and_retention_exact_under_skew(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, RSCHEMA).drop("seq")
    daily = {(r.movie_id, r.rating_date): r for r in facts.movie_rating_daily(df).collect()}
    pdf = pd.DataFrame(rows, columns=["user_id", "movie_id", "rating", "ts", "seq"])
    pdf["day"] = pdf["ts"].dt.date
    per_day = pdf.groupby(["movie_id", "day"]).size()
    hot = per_day.loc[0]
    for d, n in hot.items():
        lo = d - dt.timedelta(days=27)
        n28 = int(hot[(hot.index >= lo) & (hot.index <= d)].sum())
        assert daily[(0, d)].n_ratings == n and daily[(0, d)].n_ratings_28d == n28
    tags = spark.createDataFrame([], "user_id long, movie_id long, tag string, tag_timestamp timestamp")
    du = dims.dim_users(df, tags)
    ret = {(r.cohort_month, r.months_since_first_rating): r.active_users
           for r in marts.mart_user_cohort_retention(du, df).collect()}
    pdf["month"] = pdf["ts"].dt.to_period("M")
    first = pdf.groupby("user_id")["month"].min().rename("cohort")
    act = pdf.join(first, on="user_id")
    act["off"] = (act["month"] - act["cohort"]).apply(lambda x: x.n)
    want = act.drop_duplicates(["user_id", "month"]).groupby(["cohort", "off"]).size()
    assert len(ret) == len(want)
    for (c, off), n in want.items():
        assert ret[(c.to_timestamp().date(), off)] == n
