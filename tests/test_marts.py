"""M6-M8, M12-M14 edge cases (FIXTURES part C) and the skew-safe operators."""

import datetime as dt

from pyspark.sql import functions as F

from reelspark.operators.latest import latest_per_key
from reelspark.operators.median import exact_median
from reelspark.plans import dims, marts, staging
from reelspark.sources import seeds

MOV = "movieId long, title string, genres string"


def test_exact_median_interpolates(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 10.0, 11.0)] + [("b", 3.0), ("b", None)],
                               "g string, v double")
    out = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    assert out == {"a": 6.0, "b": 3.0}
    pct = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert pct == out


def test_latest_per_key_is_total_order(spark):
    df = spark.createDataFrame([(1, 5, 1, "x"), (1, 5, 2, "y"), (1, 4, 9, "z"), (2, 1, 1, "w")],
                               "k long, t long, seq long, v string")
    out = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["t", "seq"], ["v"]).collect())
    assert out == [(1, 5, 2, "y"), (2, 1, 1, "w")]


def _movies(spark, rows):
    return dims.dim_movies(staging.stg_movies(spark.createDataFrame(rows, MOV)))


def test_genre_explode_rules(spark):
    dm = _movies(spark, [(1, "A (1990)", "Drama|Drama"), (2, "B", None), (3, "C", "(no genres listed)"),
                         (4, "D", "Comedy")])
    mg = sorted(tuple(r) for r in marts.movie_genres(dm).collect())
    # NULL genres: NULL flag dropped by WHERE NOT; unclassified dropped; duplicate kept twice
    assert mg == [(1, "Drama"), (1, "Drama"), (4, "Comedy")]


def test_affinity_semantics(spark):
    dm = _movies(spark, [(1, "A", "Drama|Drama"), (2, "B", "Drama|IMAX"), (3, "C", "Comedy|Unknown")])
    scores = spark.createDataFrame([(1, 10, 0.2), (2, 10, 0.8), (3, 10, 0.5)],
                                   "movie_id long, tag_id long, relevance_score double")
    tags = spark.createDataFrame([(10, "Tag")], "tag_id long, tag_name string")
    rel = marts.int_movie_tag_relevance(dm, scores, tags)
    aff = {r.genre: r for r in marts.mart_tag_genre_affinity(rel, seeds.load_seed(spark)).collect()}
    assert set(aff) == {"Drama", "Comedy", "Unknown"}          # IMAX filtered, unknown kept
    assert aff["Unknown"].genre_group is None                   # caught later by not_null
    d = aff["Drama"]
    assert d.n_movies == 2                                      # distinct films
    assert d.avg_relevance == round((0.2 + 0.2 + 0.8) / 3, 4)   # duplicate genre double-weights
    assert d.median_relevance == 0.2
    # baseline = unweighted mean of per-genre means over Drama, Comedy, Unknown (not IMAX)
    base = ((0.2 + 0.2 + 0.8) / 3 + 0.5 + 0.5) / 3
    assert d.relevance_lift_vs_all_genres == round((0.2 + 0.2 + 0.8) / 3 - base, 4)
    assert all(r.tag_rank_in_genre == 1 for r in aff.values())


def test_users_dim_and_retention(spark):
    R = "userId long, movieId long, rating double, timestamp long"
    T = "userId long, movieId long, tag string, timestamp long"
    def ep(y, m, d, h=0, mi=0):
        return int(dt.datetime(y, m, d, h, mi, tzinfo=dt.timezone.utc).timestamp())
    raw_r = spark.createDataFrame([(1, 1, 4.0, ep(2020, 1, 1, 23, 59)), (1, 2, 2.0, ep(2020, 1, 2, 0, 1)),
                                   (1, 3, 3.0, ep(2020, 3, 5)), (2, 1, 5.0, ep(2020, 2, 1))], R)
    raw_t = spark.createDataFrame([(3, 1, "fun", ep(2020, 1, 4)), (1, 1, None, ep(2020, 1, 3))], T)
    sr, st_ = staging.stg_ratings(raw_r), staging.stg_tags(raw_t)
    du = {r.user_id: r for r in dims.dim_users(sr, st_).collect()}
    assert du[1].n_ratings == 3 and du[1].n_tags == 1 and du[1].has_tagged
    assert du[1].avg_rating_given == 3.0 and du[1].cohort_month == dt.date(2020, 1, 1)
    assert du[3].n_ratings == 0 and du[3].cohort_month is None and du[3].avg_rating_given is None
    two = dims.dim_users(sr.where(F.col("movie_id") < 3), st_).collect()
    assert {r.user_id: r.active_span_days for r in two}[1] == 1   # 23:59 -> 00:01 is one day
    ret = sorted((r.cohort_month.month, r.months_since_first_rating, r.active_users, r.retention_rate)
                 for r in marts.mart_user_cohort_retention(dims.dim_users(sr, st_),
                                                           sr.select("user_id", "movie_id", "rating",
                                                                     "rating_timestamp")).collect())
    # tag-only user 3 is absent; user 1: months 0 and 2; user 2: month 0
    assert ret == [(1, 0, 1, 1.0), (1, 2, 1, 1.0), (2, 0, 1, 1.0)]


def test_genome_tag_names(spark):
    raw = spark.createDataFrame([(1, "  sci-fi o'brien  "), (2, "supplier#000000002")], "tagId long, tag string")
    out = {r.tag_id: r.tag_name for r in dims.dim_genome_tags(staging.stg_genome_tags(raw)).collect()}
    assert out == {1: "Sci-Fi O'brien", 2: "Supplier#000000002"}


def test_seed_loads_nulls_and_broadcasts(spark):
    rows = seeds.seed_rows(seeds.GENRE_GROUPS)
    assert len(rows) == 20
    imax = [r for r in rows if r[0] == "IMAX"][0]
    assert imax == ("IMAX", "Format", None, True)
    assert seeds.load_seed(spark).where("is_fiction IS NULL").count() == 2


def test_affinity_null_scores_and_duplicates(spark):
    # film 1 lists Drama twice; film 2 has a NULL score; film 3 only NULL in Comedy
    stats = {r.genre: r for r in marts.genre_tag_stats(spark.createDataFrame(
        [(1, "Drama", 10, "T", 0.2), (1, "Drama", 10, "T", 0.2), (2, "Drama", 10, "T", None),
         (4, "Drama", 10, "T", 0.9), (3, "Comedy", 10, "T", None)],
        "movie_id long, genre string, tag_id long, tag_name string, relevance_score double"))
        .collect()}
    d = stats["Drama"]
    assert d.n_movies == 3                                    # NULL-score film counted
    assert abs(d.avg_relevance - (0.2 + 0.2 + 0.9) / 3) < 1e-12
    assert d.median_relevance == 0.2                          # values 0.2, 0.2, 0.9
    c = stats["Comedy"]
    assert c.n_movies == 1 and c.avg_relevance is None and c.median_relevance is None


def test_genre_stats_sort_no_rows_for_a_name(spark):
    """A maximum of strings sorts its rows: only the last aggregate, of the histogram, has one."""
    rows = spark.createDataFrame([(1, "a", 1, "x", 0.5), (1, "a", 1, "x", 0.5), (2, "a", 1, "x", 0.1), (3, "a", 1, None, None), (3, "b", 1, "x", 0.2)],
                                 "movie_id long, genre string, tag_id long, tag_name string, relevance_score double")
    stats = marts.genre_tag_stats(rows)
    assert stats._jdf.queryExecution().executedPlan().toString().count("SortAggregate") <= 2
    found = {r.genre: (r.n_movies, r.tag_name, r.median_relevance) for r in stats.collect()}
    assert found == {"a": (3, "x", 0.5), "b": (1, "x", 0.2)}
