"""Independent SQL twins of the registered queries, for DuckDB.

They start from the same driver tables (pre-registered views) and follow the
reference's SQL shape rather than the Spark plan (e.g. ``SUM(n * avg)`` for the
weighted mean, ``MEDIAN`` for the median, ``UNION`` + left joins for the user
dimension), so a match is evidence, not a tautology. Ratios and means are
rounded through ``DECIMAL(28,10)`` on both sides.
"""

from __future__ import annotations

from ..sources import seeds
from ..sources.testdata import (SQL_RAW_GENOME_SCORES, SQL_RAW_GENOME_TAGS,
                                SQL_RAW_MOVIES, SQL_RAW_TAGS, sql_raw_ratings)


def R(x: str, scale: int = 4) -> str:
    """round_half_up twin."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {scale}) AS DOUBLE)"


# Fixed: the warehouse INITCAP delimiter class (see functions/text.py).
_D = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def TITLE(x: str) -> str:
    """title_case twin."""
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), "
            f"'([{_D}]+|[^{_D}]+)'), lambda t: upper(t[1]) || lower(t[2:])), '')")


def stg_ratings_cte(item: str = "part") -> str:
    return f"""
raw_ratings AS ({sql_raw_ratings(item)}),
stg_ratings AS (
    SELECT userId AS user_id, movieId AS movie_id, CAST(rating AS DOUBLE) AS rating,
           CAST("timestamp" AS TIMESTAMP) AS rating_timestamp,
           l_orderkey, l_linenumber, l_suppkey, arrived_at
    FROM raw_ratings)"""


STG_TAGS = f"""
raw_tags AS ({SQL_RAW_TAGS}),
stg_tags AS (
    SELECT userId AS user_id, movieId AS movie_id, tag,
           CAST("timestamp" AS TIMESTAMP) AS tag_timestamp
    FROM raw_tags)"""

STG_MOVIES = f"""
raw_movies AS ({SQL_RAW_MOVIES}),
stg_movies AS (SELECT movieId AS movie_id, title, genres FROM raw_movies)"""

# The year by position: the last six characters are a parenthesised number. Genres are taken apart and joined again.
DIM_MOVIES = STG_MOVIES + f""",
ends AS (SELECT *, rtrim(title) AS t, string_split(genres, '|') AS parts FROM stg_movies),
dated AS (
    SELECT *, coalesce(t[-6] = '(' AND t[-1] = ')' AND length(t) >= 6 AND ltrim(t[-5:-2], '0123456789') = '', FALSE) AS known FROM ends),
dim_movies AS (
    SELECT movie_id, {TITLE("trim(if(known, t[:-7], title))")} AS movie_title,
           if(known, CAST(if(known, t[-5:-2], NULL) AS INTEGER), NULL) AS release_year,
           title AS source_title, parts AS genre_array, array_to_string(parts, '|') AS genre_list,
           parts = ['(no genres listed)'] AS is_unclassified
    FROM dated)"""

DIM_GENOME_TAGS = f"""
raw_genome_tags AS ({SQL_RAW_GENOME_TAGS}),
dim_genome_tags AS (SELECT tagId AS tag_id, {TITLE("trim(tag)")} AS tag_name FROM raw_genome_tags)"""

FCT_GENOME_SCORES = f"""
raw_genome_scores AS ({SQL_RAW_GENOME_SCORES}),
fct_genome_scores AS (
    SELECT movieId AS movie_id, tagId AS tag_id,
           {R("CAST(relevance AS DOUBLE)")} AS relevance_score
    FROM raw_genome_scores)"""

# All activity in one list, so that a user is one group of it.
DIM_USERS = """
activity AS (
    SELECT user_id, rating, rating_timestamp AS rated, CAST(NULL AS TIMESTAMP) AS tagged FROM stg_ratings
    UNION ALL SELECT user_id, NULL, NULL, tag_timestamp FROM stg_tags),
dim_users AS (
    SELECT user_id, count(rated) AS n_ratings, count(tagged) AS n_tags, avg(rating) AS avg_rating_given,
           min(rated) AS first_rating_at, max(rated) AS last_rating_at,
           min(tagged) AS first_tag_at, max(tagged) AS last_tag_at,
           CAST(date_trunc('month', min(rated)) AS DATE) AS cohort_month,
           CAST(CAST(max(rated) AS DATE) - CAST(min(rated) AS DATE) AS INTEGER) AS active_span_days,
           count(tagged) > 0 AS has_tagged
    FROM activity GROUP BY user_id)"""

TAG_RELEVANCE = DIM_MOVIES + "," + DIM_GENOME_TAGS + "," + FCT_GENOME_SCORES + """,
listed AS (SELECT movie_id, unnest(genre_array) AS genre FROM dim_movies WHERE is_unclassified IS FALSE),
int_movie_tag_relevance AS (
    SELECT * FROM fct_genome_scores JOIN dim_genome_tags USING (tag_id) JOIN listed USING (movie_id))"""


def genre_affinity_cte() -> str:
    """Means and medians from the scores; a rank is one more than the number of better tags of the genre."""
    return TAG_RELEVANCE + f""",
genre_groups AS (SELECT * FROM {seeds.seed_values_sql(seeds.GENRE_GROUPS_TESTDATA)}),
stats AS (
    SELECT genre_group, r.genre, tag_id, any_value(tag_name) AS tag_name, count(DISTINCT movie_id) AS films,
           avg(relevance_score) AS mean, quantile_cont(relevance_score, 0.5) AS middle
    FROM int_movie_tag_relevance r LEFT JOIN genre_groups USING (genre)
    WHERE is_format_not_genre IS DISTINCT FROM TRUE GROUP BY genre_group, r.genre, tag_id),
lifts AS (SELECT s.*, s.mean - (SELECT avg(o.mean) FROM stats o WHERE o.tag_id = s.tag_id) AS lift FROM stats s),
mart_tag_genre_affinity AS (
    SELECT genre_group, genre, tag_id, tag_name, films AS n_movies, {R("mean")} AS avg_relevance, {R("middle")} AS median_relevance,
           {R("lift")} AS relevance_lift_vs_all_genres,
           CAST(1 + (SELECT count(*) FROM lifts o WHERE o.genre = l.genre AND o.lift > l.lift) AS INTEGER) AS tag_rank_in_genre
    FROM lifts l)"""


def daily_rel(name: str, source: str) -> str:
    """M11 full refresh of ``source`` as a CTE named ``name``: each rated day is joined with the days of the same film
    that are at most 27 days before it."""
    return f"""
{name}_day AS (
    SELECT movie_id, CAST(rating_timestamp AS DATE) AS d, count(*) AS n, avg(rating) AS v FROM {source} GROUP BY ALL),
{name} AS (
    SELECT a.movie_id, a.d AS rating_date, any_value(a.n) AS n_ratings, {R("any_value(a.v)")} AS avg_rating,
           CAST(sum(b.n) FILTER (a.d - b.d < 7) AS BIGINT) AS n_ratings_7d, CAST(sum(b.n) AS BIGINT) AS n_ratings_28d,
           {R("sum(b.n * b.v) / sum(b.n)")} AS avg_rating_28d
    FROM {name}_day a JOIN {name}_day b ON b.movie_id = a.movie_id AND b.d > a.d - 28 AND b.d <= a.d
    GROUP BY a.movie_id, a.d)"""


def daily_sql(source_cte: str, source: str) -> str:
    return f"WITH {source_cte}, {daily_rel('rolled', source)} SELECT * FROM rolled"


LATEST = """
ratings_latest AS (
    SELECT user_id, movie_id, rating, rating_timestamp FROM stg_ratings
    QUALIFY row_number() OVER (PARTITION BY user_id, movie_id
        ORDER BY rating_timestamp DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1)"""


def retention_sql(ratings_rel: str) -> str:
    """Both numbers of a cohort and offset are counted anew from the users' months."""
    return f"""
member AS (SELECT user_id, cohort_month FROM dim_users WHERE cohort_month IS NOT NULL),
active AS (
    SELECT DISTINCT user_id, cohort_month,
        CAST(date_diff('month', cohort_month, date_trunc('month', rating_timestamp)) AS INTEGER) AS k
    FROM {ratings_rel} JOIN member USING (user_id)),
points AS (
    SELECT cohort_month, k, (SELECT count(*) FROM member m WHERE m.cohort_month = p.cohort_month) AS size,
        (SELECT count(*) FROM active a WHERE a.cohort_month = p.cohort_month AND a.k = p.k) AS still
    FROM (SELECT DISTINCT cohort_month, k FROM active) p)
SELECT cohort_month, size AS cohort_size, k AS months_since_first_rating, still AS active_users,
       {R("still / size")} AS retention_rate
FROM points"""


def _core_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["daily_rolling"] = daily_sql(stg_ratings_cte("part"), "stg_ratings")
    q["daily_rolling_dense"] = daily_sql(stg_ratings_cte("supplier"), "stg_ratings")
    q["movies_dim"] = f"WITH {DIM_MOVIES} SELECT * FROM dim_movies"
    q["users_dim"] = f"WITH {stg_ratings_cte()}, {STG_TAGS}, {DIM_USERS} SELECT * FROM dim_users"
    q["genome_tags_dim"] = f"WITH {DIM_GENOME_TAGS} SELECT * FROM dim_genome_tags"
    q["genome_scores"] = f"WITH {FCT_GENOME_SCORES} SELECT * FROM fct_genome_scores"
    q["tag_relevance"] = f"WITH {TAG_RELEVANCE} SELECT * FROM int_movie_tag_relevance"
    q["genre_affinity"] = f"WITH {genre_affinity_cte()} SELECT * FROM mart_tag_genre_affinity"
    q["genre_top_tags"] = (f"WITH {genre_affinity_cte()} SELECT * FROM mart_tag_genre_affinity "
                           f"WHERE tag_rank_in_genre <= 10")
    q["cohort_retention"] = (f"WITH {stg_ratings_cte()}, {STG_TAGS}, {DIM_USERS}, "
                             f"{retention_sql('stg_ratings')}")
    q["ratings_latest"] = f"WITH {stg_ratings_cte()}, {LATEST} SELECT * FROM ratings_latest"
    return q


def _history_sql() -> dict[str, str]:
    from ..sources.testdata import SQL_RAW_MOVIES
    from . import history as H
    cte = H.sql_history_cte(SQL_RAW_MOVIES)
    q = {}
    q["conditional_update"] = f"WITH {cte} SELECT * FROM v2a"
    q["insert_if_absent"] = f"WITH {cte} SELECT * FROM v2"
    q["delete_where"] = f"WITH {cte} SELECT * FROM v3"
    q["snapshot_history"] = q["snapshot_history_stored"] = f"WITH {cte} SELECT * FROM snap_movies"
    versions = f"WITH {cte} SELECT movie_id, title, genres, valid_from, valid_to"
    q["snapshot_state"] = f"{versions}, if(valid_to IS NULL, 'current', 'superseded') AS version_state FROM snap_movies"
    q["snapshot_withdrawn"] = (f"WITH {H.sql_history_cte(SQL_RAW_MOVIES, 3)} SELECT movie_id, title, genres, valid_from, valid_to "
                               "FROM snap_movies WHERE movie_id NOT IN (SELECT movie_id FROM v3)")
    q["snapshot_accounting"] = f"""WITH {cte}, n AS (SELECT count(*) AS own, count(*) - count(valid_to) AS open FROM snap_movies GROUP BY movie_id)
SELECT CAST(sum(own) AS BIGINT) AS total_versions, count(*) AS distinct_movies, CAST(sum(open) AS BIGINT) AS open_versions,
       CAST(sum(own - 1) AS BIGINT) AS superseded_versions FROM n"""
    q["snapshot_multi_open"] = f"""WITH {cte}, n AS (SELECT movie_id, count(*) - count(valid_to) AS open_versions FROM snap_movies GROUP BY ALL)
FROM n WHERE open_versions > 1"""
    q["scd2_violations"] = f"WITH {cte}, {H.sql_violations('snap_movies')} SELECT * FROM violations"
    q["scd2_violations_declared"] = (
        f"WITH {cte}, {H.sql_violations('snap_movies', True, True)} SELECT * FROM violations")
    return q


# ----------------------------------------------------------- incremental runs

_LATEST_ORDER = "rating_timestamp DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC"


def _latest(name: str, where: str) -> str:
    return f"""
{name} AS (
    SELECT user_id, movie_id, rating, rating_timestamp FROM stg_ratings WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY {_LATEST_ORDER}) = 1)"""


def _two_runs(split_col: str, lookback_days: int | None = None) -> str:
    from . import incremental as INC
    cut = f"TIMESTAMP '{INC.CUTOFF:%Y-%m-%d %H:%M:%S}'"
    mark = "(SELECT MAX(rating_timestamp) FROM f1)"
    if lookback_days:
        mark = f"({mark} - INTERVAL {lookback_days} DAY)"
    return (stg_ratings_cte() + "," + _latest("f1", f"{split_col} < {cut}") + ","
            + _latest("batch", f"rating_timestamp >= {mark}") + """,
f2 AS (
    SELECT * FROM f1 WHERE NOT EXISTS (
        SELECT 1 FROM batch b WHERE b.user_id = f1.user_id AND b.movie_id = f1.movie_id)
    UNION ALL SELECT * FROM batch)""")


def _daily_two_runs(mode: str) -> str:
    head = _two_runs("rating_timestamp") + "," + daily_rel("d1", "f1") + """,
mx AS (SELECT MAX(rating_date) AS m FROM d1)"""
    if mode in ("default", "delete_window"):
        base = "d1" if mode == "default" else \
            "(SELECT * FROM d1 WHERE rating_date < CAST((SELECT m FROM mx) - INTERVAL 28 DAY AS DATE))"
        return f"""WITH {head},
src AS (SELECT * FROM f2
        WHERE rating_timestamp >= CAST(CAST((SELECT m FROM mx) - INTERVAL 56 DAY AS DATE) AS TIMESTAMP)),
{daily_rel("e0", "src")},
e AS (SELECT * FROM e0 WHERE rating_date >= CAST((SELECT m FROM mx) - INTERVAL 28 DAY AS DATE)),
base AS (SELECT * FROM {base} b)
SELECT * FROM base WHERE NOT EXISTS (
    SELECT 1 FROM e WHERE e.movie_id = base.movie_id AND e.rating_date = base.rating_date)
UNION ALL SELECT * FROM e"""
    # partition replace by month
    return f"""WITH {head},
fm AS (SELECT CAST(date_trunc('month', CAST(m - INTERVAL 28 DAY AS DATE)) AS DATE) AS first_month FROM mx),
src AS (SELECT * FROM f2 WHERE rating_timestamp >=
        CAST(CAST((SELECT first_month FROM fm) - INTERVAL 27 DAY AS DATE) AS TIMESTAMP)),
{daily_rel("e0", "src")},
e AS (SELECT * FROM e0 WHERE rating_date >= (SELECT first_month FROM fm))
SELECT * FROM d1 WHERE date_trunc('month', rating_date) NOT IN (
    SELECT DISTINCT date_trunc('month', rating_date) FROM e)
UNION ALL SELECT * FROM e"""


def _incremental_sql() -> dict[str, str]:
    from . import incremental as INC
    q = {}
    q["ratings_incremental"] = f"WITH {_two_runs('rating_timestamp')} SELECT * FROM f2"
    q["ratings_bucket_merge"] = q["ratings_incremental"]
    q["incremental_late_rows"] = f"WITH {_two_runs('arrived_at')} SELECT * FROM f2"
    q["incremental_late_rows_lookback"] = (
        f"WITH {_two_runs('arrived_at', INC.LATE_LOOKBACK.days)} SELECT * FROM f2")
    q["daily_incremental"] = _daily_two_runs("default")
    q["daily_incremental_delete_window"] = _daily_two_runs("delete_window")
    q["daily_partition_replace"] = _daily_two_runs("partition")
    q["users_dim_incremental"] = (f"WITH {stg_ratings_cte()}, {STG_TAGS}, {DIM_USERS} "
                                  f"SELECT * FROM dim_users")
    broken = "((l_orderkey % 10 = 7 AND l_linenumber = 3) OR (l_orderkey % 10 = 3 AND l_linenumber = 1))"
    q["ratings_from_text"] = (f"WITH {stg_ratings_cte()} SELECT user_id, movie_id, rating, date_trunc('second', rating_timestamp) AS rating_timestamp "
                              f"FROM stg_ratings WHERE NOT {broken}")
    q["ratings_text_rejects"] = f"""WITH {stg_ratings_cte()}, lines AS (
        SELECT concat_ws(',', movie_id, user_id,
            if(l_orderkey % 10 = 3 AND l_linenumber = 1, strftime(rating_timestamp, '%Y-%m-%d'), CAST(CAST(epoch(rating_timestamp) AS BIGINT) AS VARCHAR)),
            if(l_orderkey % 10 = 7 AND l_linenumber = 3, 'n/a', CAST(rating AS VARCHAR))) AS record
        FROM stg_ratings WHERE {broken})
        SELECT record, count(*) AS n FROM lines GROUP BY record"""
    q["retention_bridge"] = f"WITH {stg_ratings_cte()}, {STG_TAGS}, {DIM_USERS}, {retention_sql('stg_ratings')}"
    q["retention_sketch_bounds"] = (f"WITH exact AS ({q['retention_bridge']}) "
                                    "SELECT cohort_month, months_since_first_rating, TRUE AS within_bound FROM exact")
    q["bridge_active_users"] = (f"WITH {stg_ratings_cte()} SELECT CAST(date_trunc('month', rating_timestamp) AS DATE) AS activity_month, "
                                "count(DISTINCT user_id) AS active_users FROM stg_ratings GROUP BY 1")
    q["user_month_bridge"] = (f"WITH {stg_ratings_cte()} SELECT DISTINCT user_id, "
                              f"CAST(date_trunc('month', rating_timestamp) AS DATE) AS activity_month "
                              f"FROM stg_ratings")
    return q


# ------------------------------------------------------------------ profiling

STG_GENOME = f"""
raw_genome_tags AS ({SQL_RAW_GENOME_TAGS}),
stg_genome_tags AS (SELECT tagId AS tag_id, tag FROM raw_genome_tags),
raw_genome_scores AS ({SQL_RAW_GENOME_SCORES}),
stg_genome_scores AS (SELECT movieId AS movie_id, tagId AS tag_id, CAST(relevance AS DOUBLE) AS relevance
                      FROM raw_genome_scores)"""


def _evidence_sql() -> dict[str, str]:
    from . import catalog as C
    from . import history as H
    day = lambda x: f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"
    days = f"(epoch_us({day(C.FRESHNESS_NOW)}) - epoch_us(CAST(max(o_orderdate) AS TIMESTAMP))) / 86400e6"
    return {
        "profile_tag_only_users_fired": f"""WITH {stg_ratings_cte()}, {STG_TAGS}
SELECT user_id FROM stg_tags GROUP BY user_id HAVING user_id NOT IN (SELECT user_id FROM stg_ratings WHERE rating_timestamp < {day(C.EARLY)})""",
        "profile_orphans_fired": f"""WITH raw_movies AS ({SQL_RAW_MOVIES}), raw_genome_scores AS ({SQL_RAW_GENOME_SCORES})
SELECT movieId AS movie_id, count(*) AS orphan_rows FROM raw_genome_scores
WHERE movieId IN (SELECT movieId FROM raw_movies WHERE ends_with(title, '{H.LATE_END}')) GROUP BY ALL""",
        "snapshot_multi_open_fired": """WITH d AS (SELECT o_custkey, o_orderdate, max(o_orderstatus) AS s FROM orders GROUP BY ALL)
SELECT o_custkey AS movie_id, count(*) AS open_versions FROM d WHERE s = 'O' GROUP BY ALL HAVING count(*) > 1""",
        "freshness_by_source": f"""WITH a AS (
    SELECT c_name AS source, CAST(max(o_orderdate) AS TIMESTAMP) AS last_loaded_at, {days} AS age
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate < {day(C.FRESHNESS_LOADED)} GROUP BY c_custkey, c_name)
SELECT source, last_loaded_at, CASE WHEN age IS NULL OR age > 60 THEN 'error' WHEN age > 35 THEN 'warn' ELSE 'pass' END AS status FROM a""",
    }


def _profile_sql() -> dict[str, str]:
    base = f"WITH {stg_ratings_cte()}, {STG_TAGS}, {DIM_MOVIES}, {STG_GENOME}"

    def dup(metric, rel, keys):
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        return (f"SELECT '{metric}' AS metric, CAST(COUNT_IF(n > 1) AS DOUBLE) AS value FROM "
                f"(SELECT COUNT(*) AS n FROM {rel} WHERE {nn} GROUP BY {', '.join(keys)})")
    q = {}
    q["profile_keys"] = base + " " + " UNION ALL ".join([
        dup("dup_rating_pairs", "stg_ratings", ["user_id", "movie_id"]),
        dup("dup_movie_ids", "stg_movies", ["movie_id"]),
        dup("dup_tag_ids", "stg_genome_tags", ["tag_id"]),
        dup("dup_tag_texts", "stg_genome_tags", ["tag"])])
    q["profile_ranges"] = base + """
SELECT 'null_ratings' AS metric, CAST(COUNT_IF(rating IS NULL) AS DOUBLE) AS value FROM stg_ratings
UNION ALL SELECT 'min_rating', CAST(MIN(rating) AS DOUBLE) FROM stg_ratings
UNION ALL SELECT 'max_rating', CAST(MAX(rating) AS DOUBLE) FROM stg_ratings
UNION ALL SELECT 'n_ratings', CAST(COUNT(*) AS DOUBLE) FROM stg_ratings
UNION ALL SELECT 'nonpositive_relevance', CAST(COUNT_IF(relevance <= 0) AS DOUBLE) FROM stg_genome_scores
UNION ALL SELECT 'min_relevance', CAST(MIN(relevance) AS DOUBLE) FROM stg_genome_scores
UNION ALL SELECT 'n_scores', CAST(COUNT(*) AS DOUBLE) FROM stg_genome_scores"""
    q["profile_ties"] = base + f""",
per_ts AS (SELECT rating_timestamp, COUNT(*) AS n FROM stg_ratings GROUP BY rating_timestamp),
agg AS (SELECT CAST(SUM(n) AS BIGINT) AS n_rows,
               CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS tied_rows,
               CAST(COUNT(*) AS BIGINT) AS n_timestamps,
               CAST(COUNT_IF(n > 1) AS BIGINT) AS tied_timestamps FROM per_ts)
SELECT n_rows, tied_rows, n_timestamps, tied_timestamps,
       {R("tied_rows / NULLIF(n_rows, 0)")} AS tied_row_share,
       {R("tied_timestamps / NULLIF(n_timestamps, 0)")} AS tied_timestamp_share
FROM agg"""
    for qname, seed_file in (("profile_vocab", seeds.GENRE_GROUPS_TESTDATA),
                             ("profile_vocab_reference", seeds.GENRE_GROUPS)):
        q[qname] = base + f""",
seed AS (SELECT genre FROM {seeds.seed_values_sql(seed_file)}),
listed AS (SELECT g.genre, COUNT(DISTINCT m.movie_id) AS n_films
           FROM stg_movies m, unnest(string_split(m.genres, '|')) AS g(genre) GROUP BY g.genre)
SELECT genre, 'missing_from_seed' AS side, CAST(n_films AS BIGINT) AS n_films FROM listed
WHERE genre NOT IN (SELECT genre FROM seed)
UNION ALL
SELECT genre, 'unused_by_films', CAST(0 AS BIGINT) FROM seed
WHERE genre NOT IN (SELECT genre FROM listed)"""
    q["profile_tag_only_users"] = base + """
SELECT DISTINCT user_id FROM stg_tags t
WHERE NOT EXISTS (SELECT 1 FROM stg_ratings r WHERE r.user_id = t.user_id)"""
    q["profile_years"] = base + """
SELECT movie_id, source_title,
       CASE WHEN regexp_matches(source_title, '\\(\\d{4}') THEN 'malformed' ELSE 'absent' END AS reason
FROM dim_movies WHERE release_year IS NULL"""
    q["profile_orphans"] = base + """
SELECT g.movie_id, CAST(COUNT(*) AS BIGINT) AS orphan_rows FROM stg_genome_scores g
WHERE NOT EXISTS (SELECT 1 FROM stg_movies m WHERE m.movie_id = g.movie_id)
GROUP BY g.movie_id"""
    return q


# ------------------------------------------------------------- check summary

def _sql_value(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def check_sql(rel: str, c) -> str:
    """Render one declared check as a SQL count of its violations."""
    p = c.params
    head = f"SELECT '{rel}' AS relation, {_sql_value(c.name)} AS \"check\", '{c.kind}' AS kind, "
    if c.kind == "not_null":
        pred = f"{p['col']} IS NULL"
    elif c.kind == "accepted_values":
        pred = f"{p['col']} NOT IN ({', '.join(_sql_value(v) for v in p['values'])})"
    elif c.kind == "between":
        conds = []
        if p["min"] is not None:
            conds.append(f"{p['col']} >= {p['min']}")
        if p["max"] is not None:
            conds.append(f"{p['col']} <= {p['max']}")
        pred = f"NOT ({' AND '.join(conds)})"
        if p["row_condition"]:
            pred = f"({p['row_condition']}) AND {pred}"
    elif c.kind == "expression_is_true":
        pred = f"NOT ({p['expression']})"
    else:
        pred = None
    if pred is not None:
        return head + f"CAST(COUNT_IF({pred}) AS BIGINT) AS n_violations FROM {rel}"
    if c.kind == "unique":
        sub = (f"SELECT {p['col']} FROM {rel} WHERE {p['col']} IS NOT NULL "
               f"GROUP BY {p['col']} HAVING COUNT(*) > 1")
    elif c.kind == "unique_combination":
        cols = ", ".join(p["cols"])
        sub = f"SELECT {cols} FROM {rel} GROUP BY {cols} HAVING COUNT(*) > 1"
    elif c.kind == "relationships":
        sub = (f"SELECT ch.{p['col']} FROM {rel} ch WHERE ch.{p['col']} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {p['to']} pa WHERE pa.{p['field']} = ch.{p['col']})")
    elif c.kind in ("no_overlapping_versions", "open_window_superseded"):
        from . import history as H
        extra = p["extra_mode"] or p["extra_only"]
        v = H.sql_violations(rel, p["allow_closed_entities"], p["allow_gaps"], extra)
        sub = f"WITH {v} SELECT * FROM violations"
        if p["extra_only"]:
            sub += " WHERE failure_mode = 'open_window_superseded'"
    else:
        raise ValueError(c.kind)
    return head + f"CAST(COUNT(*) AS BIGINT) AS n_violations FROM ({sub}) v"


def _check_summary_sql() -> str:
    from . import history as H
    from . import quality as Q
    ctes = ",".join([
        stg_ratings_cte(), STG_TAGS, genre_affinity_cte(), DIM_USERS,
        """
stg_genome_tags AS (SELECT tagId AS tag_id, tag FROM raw_genome_tags),
stg_genome_scores AS (SELECT movieId AS movie_id, tagId AS tag_id, CAST(relevance AS DOUBLE) AS relevance
                      FROM raw_genome_scores),
fct_ratings AS (SELECT user_id, movie_id, rating, rating_timestamp FROM stg_ratings),
seed_genre_groups AS (SELECT * FROM genre_groups)""",
        daily_rel("fct_movie_rating_daily", "fct_ratings"),
        retention_cte("fct_ratings"),
        H.sql_history_cte(SQL_RAW_MOVIES),
    ])
    checks = Q.declared_checks(Q.TESTDATA_GENRE_GROUPS)
    body = "\nUNION ALL\n".join(check_sql(rel, c) for rel, cs in checks.items() for c in cs)
    return f"WITH {ctes}\n{body}"


def retention_cte(ratings_rel: str) -> str:
    """M14 as a CTE named mart_user_cohort_retention."""
    return retention_sql(ratings_rel).replace(
        "\nSELECT cohort_month, size", "\n, mart_user_cohort_retention AS (SELECT cohort_month, size", 1) + ")"


def _fired_sql() -> dict[str, str]:
    from . import history as H
    counted = {
        "not_null(rebate)": "count(*) FILTER (l_discount = 0 OR l_discount IS NULL)",
        "accepted_values(l_returnflag)": "count(*) FILTER (l_returnflag NOT IN ('A', 'N'))",
        "between(l_quantity,5,45)": "count(*) FILTER (l_quantity < 5 OR l_quantity > 45)",
        "expression_is_true(l_extendedprice >= 2000 * l_quantity)": "count(*) FILTER (l_extendedprice < 2000 * l_quantity)",
    }
    rows = [f"SELECT '{name}' AS \"check\", {value} AS n_violations FROM lineitem" for name, value in counted.items()]
    for name, keys in (("unique(l_orderkey)", "l_orderkey"), ("unique_combination(l_partkey,l_suppkey)", "l_partkey, l_suppkey")):
        rows.append(f"SELECT '{name}', count(*) FROM (SELECT {keys} FROM lineitem GROUP BY ALL HAVING count(*) > 1)")
    rows.append("SELECT 'relationships(l_suppkey->solvent.s_suppkey)', count(*) FROM lineitem "
                "WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)")
    days = """days AS (
    SELECT o_custkey AS movie_id, o_orderdate AS valid_from,
        CASE max(o_orderstatus) WHEN 'F' THEN o_orderdate + INTERVAL 90 DAY WHEN 'P' THEN o_orderdate - INTERVAL 1 DAY END AS valid_to
    FROM orders GROUP BY o_custkey, o_orderdate)"""
    return {
        "checks_fired": " UNION ALL ".join(rows),
        "windows_fired": f"WITH {days}, {H.sql_violations('days')} SELECT failure_mode, count(*) AS n_violations FROM violations GROUP BY ALL",
    }


def oracle_sql() -> dict[str, str]:
    """SQL twin per registered query (all but the rows-only ones)."""
    q = _core_sql()
    q.update(_history_sql())
    q.update(_incremental_sql())
    q.update(_profile_sql())
    q["check_summary"] = _check_summary_sql()
    q.update(_fired_sql())
    q.update(_evidence_sql())
    return q
