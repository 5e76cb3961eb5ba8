"""The silver jobs on the damaged tables, and the reports over their layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.checks.base import D_TIME, TIME_TEXT, d_bool, d_clean, d_double, d_html, d_issues, d_long
from siltstone.checks.registry import Tables, query
from siltstone.checks.relational import D_BRIDGE, D_EVENTS_AGG, D_REVIEWS_AGG, d_quantile
from siltstone.operators import schema
from siltstone.plans import gold, silver
from siltstone.reports import columns as column_reports
from siltstone.reports import histograms, issues, overview, profile
from siltstone.reports import outliers as outlier_reports
from siltstone.sources.staging import stage

# ---- the silver tables as SQL ------------------------------------------------

OLD = "TIMESTAMP '1900-01-01 00:00:00'"
EVENT_ISSUES = [
    ("missing_review_id", "review_id IS NULL"), ("missing_app_id", "app_id IS NULL"),
    ("missing_user_id", "user_id IS NULL"), ("duplicate_review_id", "review_id IS NOT NULL AND copies > 1"),
    ("empty_review_text", "review_text IS NULL OR length(trim(review_text)) = 0"),
    ("negative_hours", "hours < 0"), ("invalid_boolean_is_recommended", "is_recommended IS NULL"),
    ("ancient_timestamp_created", f"timestamp_created < {OLD}"),
    ("invalid_weighted_vote_score", "weighted_vote_score < 0 OR weighted_vote_score > 1"),
]
D_EVENTS = f"""
    ev_clean AS (SELECT src_key, review_id, app_id, user_id, {d_bool(d_clean('is_recommended'))} AS is_recommended,
        {d_clean('review_text')} AS review_text, hours, weighted_vote_score, timestamp_created,
        count(*) OVER (PARTITION BY review_id) AS copies FROM dirty_events),
    ev_judged AS (SELECT *, {d_issues(*EVENT_ISSUES)} AS quality_issue,
        review_id IS NULL OR app_id IS NULL OR user_id IS NULL OR copies > 1 AS bad FROM ev_clean),
    ev_rejected AS (SELECT * FROM ev_judged WHERE bad),
    ev_good AS (SELECT *, CAST(length(review_text) AS INTEGER) AS review_text_length FROM ev_judged WHERE NOT bad),
    ev_limits AS (SELECT quantile_disc(hours, 0.999) AS h, quantile_disc(review_text_length, 0.999) AS n FROM ev_good),
    ev_valid AS (SELECT *, least(hours, h) AS hours_capped, coalesce(hours > h, FALSE) AS far_hours,
        coalesce(review_text_length > n, FALSE) AS far_text FROM ev_good, ev_limits)"""

USER_ISSUES = [
    ("missing_user_id", "user_id IS NULL"), ("negative_products", "products < 0"),
    ("hard_limit_exceeded_products", "products > 10000000"), ("negative_reviews", "reviews < 0"),
    ("hard_limit_exceeded_reviews", "reviews > 10000000"),
    ("duplicate_user_id", "user_id IS NOT NULL AND copy > 1"),
]
D_USERS = f"""
    cu_clean AS (SELECT src_key, {d_long(d_clean('user_id'))} AS user_id,
        {d_long(d_clean('products'), 'INTEGER')} AS products, {d_long(d_clean('reviews'), 'INTEGER')} AS reviews
        FROM dirty_customer),
    cu_judged AS (SELECT *, {d_issues(*USER_ISSUES)} AS quality_issue FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY src_key) AS copy FROM cu_clean)),
    cu_rejected AS (SELECT * FROM cu_judged WHERE quality_issue IS NOT NULL),
    cu_good AS (SELECT * FROM cu_judged WHERE quality_issue IS NULL),
    cu_valid AS (SELECT *, CASE WHEN products IS NOT NULL THEN CAST(least(products, p) AS DOUBLE) END AS products_capped,
        CASE WHEN reviews IS NOT NULL THEN CAST(least(reviews, r) AS DOUBLE) END AS reviews_capped,
        coalesce(products > p, FALSE) AS far_products, coalesce(reviews > r, FALSE) AS far_reviews FROM cu_good,
        (SELECT quantile_disc(products, 0.999) AS p, quantile_disc(reviews, 0.999) AS r FROM cu_good))"""

TEXT_ISSUES = [
    ("missing_app_id", "app_id IS NULL"), ("all_text_fields_empty", "about_clean IS NULL OR about_clean = ''"),
    ("hard_limit_exceeded_about_len", "about_len > 200000"), ("duplicate_app_id", "app_id IS NOT NULL AND copy > 1"),
]
D_TEXTS = f"""
    pg_clean AS (SELECT src_key, app_id, {d_html('about')} AS about_clean FROM dirty_pages),
    pg_judged AS (SELECT *, {d_issues(*TEXT_ISSUES)} AS quality_issue FROM (
        SELECT *, CAST(length(about_clean) AS INTEGER) AS about_len,
          row_number() OVER (PARTITION BY app_id ORDER BY src_key) AS copy FROM pg_clean)),
    pg_rejected AS (SELECT * FROM pg_judged WHERE quality_issue IS NOT NULL),
    pg_valid AS (SELECT *, coalesce(about_len > n, FALSE) AS is_outlier FROM pg_judged,
        (SELECT quantile_disc(about_len, 0.999) AS n FROM pg_judged WHERE quality_issue IS NULL)
        WHERE quality_issue IS NULL)"""

PART_ISSUES = [
    ("missing_game_name", "game_name IS NULL OR length(trim(game_name)) = 0"),
    ("negative_positive_ratio", "positive_ratio < 0"),
    ("invalid_positive_ratio", "positive_ratio < 0 OR positive_ratio > 100"),
    ("release_date_too_far_in_future", "released > DATE '2024-01-31'"),
]
D_PARTS = f"""
    reviews AS ({D_REVIEWS_AGG}), happenings AS ({D_EVENTS_AGG}),
    store_one AS (SELECT app_id, min({d_clean('name')}) AS store_name, min(is_free) AS is_free,
        array_to_string(list_sort(list(DISTINCT genre) FILTER (WHERE genre IS NOT NULL)), ',') AS genres,
        array_to_string(list_sort(list(DISTINCT tag)), ',') AS tags_insight FROM store_games GROUP BY 1),
    pt_joined AS (SELECT d.app_id, {d_clean('d.title')} AS title, s.store_name,
        coalesce({d_clean('d.title')}, s.store_name, r.game_from_reviews) AS game_name,
        TRY_CAST(d.date_release AS DATE) AS released,
        CASE s.is_free WHEN '1' THEN TRUE WHEN '0' THEN FALSE WHEN 'true' THEN TRUE END AS is_free_clean,
        s.genres, s.tags_insight, CAST(d.positive_ratio AS DOUBLE) AS positive_ratio, d.price_final,
        CAST(r.review_count_all_reviews AS DOUBLE) AS review_count, CAST(r.negative_review_count AS DOUBLE) AS negatives,
        round(r.avg_votes_up, 6) AS avg_votes_up,
        CAST(h.recommendation_event_count AS DOUBLE) AS event_count, CAST(h.recommended_count AS DOUBLE) AS recommended,
        {d_clean('m.description')} AS description, {d_clean('m.tags')} AS tags, {d_clean('p.summary')} AS summary,
        {d_clean('p.extensive')} AS extensive, {d_clean('p.about')} AS about, {d_clean('u.developer')} AS developer,
        {d_clean('u.owners')} AS owners, {d_double('u.average_forever')} AS average_forever, CAST(u.ccu AS DOUBLE) AS ccu
        FROM dirty_part d LEFT JOIN store_one s ON d.app_id = s.app_id LEFT JOIN reviews r ON d.app_id = r.app_id
          LEFT JOIN happenings h ON d.app_id = h.app_id LEFT JOIN game_metadata m ON d.app_id = m.app_id
          LEFT JOIN game_promotional p ON d.app_id = p.app_id LEFT JOIN game_usage u ON d.app_id = u.app_id),
    pt_judged AS (SELECT *, {d_issues(*PART_ISSUES)} AS quality_issue FROM pt_joined),
    pt_rejected AS (SELECT * FROM pt_judged WHERE quality_issue IS NOT NULL),
    pt_good AS (SELECT * FROM pt_judged WHERE quality_issue IS NULL),
    pt_valid AS (SELECT *, least(price_final, pr) AS price_final_capped,
        NULLIF(concat_ws('|', CASE WHEN price_final > pr THEN 'p999_outlier_price_final' END,
          CASE WHEN review_count > rc THEN 'p999_outlier_review_count_all_reviews' END,
          CASE WHEN event_count > ec THEN 'p999_outlier_recommendation_event_count' END,
          CASE WHEN length(game_name) > nl THEN 'p999_outlier_game_name_length' END), '') AS outlier_reasons
        FROM pt_good, (SELECT quantile_disc(price_final, 0.999) AS pr, quantile_disc(review_count, 0.999) AS rc,
          quantile_disc(event_count, 0.999) AS ec, quantile_disc(length(game_name), 0.999) AS nl FROM pt_good))"""

D_BRIDGES = f"""{D_BRIDGE},
    br_valid AS (SELECT *, value_length > {d_quantile('value_length', 0.999, 'bridge')} AS is_outlier FROM bridge),
    br_rejected AS (SELECT * FROM (SELECT {d_long('app_id')} AS app_id,
        regexp_replace(lower(trim(tag)), '\\s+', ' ', 'g') AS tag FROM dirty_bridge)
      WHERE app_id IS NULL OR tag IS NULL OR tag = '')"""


# ---- the silver jobs ---------------------------------------------------------

def events(t: Tables) -> silver.Silver:
    return silver.silver_reviews(t.fixture("dirty_events"), t.ctx)


def users(t: Tables) -> silver.Silver:
    return silver.silver_users(t.fixture("dirty_customer"), t.ctx, order_by=["src_key"])


def texts(t: Tables) -> silver.Silver:
    return silver.silver_game_text(t.fixture("dirty_pages"), t.ctx, order_by=["src_key"])


def parts(t: Tables) -> silver.Silver:
    return silver.silver_games({
        "base": t.fixture("dirty_part").drop("is_free"), "store_games": t.fixture("store_games"),
        "metadata": t.fixture("game_metadata"), "promotional": t.fixture("game_promotional"), "usage": t.fixture("game_usage"),
        "reviews": t.fixture("item_reviews"), "interactions": t.fixture("interactions")}, t.ctx)


def tags(t: Tables) -> silver.Silver:
    return silver.silver_bridge(t.fixture("dirty_bridge"), "tag")


@query("silver_events", f"""WITH {D_EVENTS}
    SELECT src_key, review_id, app_id, user_id, is_recommended, review_text, hours, weighted_vote_score,
      CASE WHEN timestamp_created >= {OLD} THEN strftime(timestamp_created, {D_TIME}) END AS created,
      review_text_length, hours_capped, quality_issue, NULLIF(concat_ws('|',
        CASE WHEN far_hours THEN 'p999_outlier_hours' END,
        CASE WHEN far_text THEN 'p999_outlier_review_text_length' END), '') AS outlier_reasons,
      far_hours OR far_text AS is_outlier FROM ev_valid""")
def silver_events(t: Tables):
    return events(t).valid.withColumn("created", F.date_format("timestamp_created", TIME_TEXT)).drop(
        "timestamp_created", "silver_processed_at")


@query("silver_events_rejected", f"WITH {D_EVENTS} SELECT src_key, review_id, quality_issue FROM ev_rejected")
def silver_events_rejected(t: Tables):
    return events(t).rejected.select("src_key", "review_id", "quality_issue")


@query("silver_customers", f"""WITH {D_USERS}
    SELECT src_key, user_id, products, reviews, products_capped, reviews_capped,
      NULLIF(concat_ws('|', CASE WHEN far_products THEN 'p999_outlier_products' END,
        CASE WHEN far_reviews THEN 'p999_outlier_reviews' END), '') AS outlier_reasons,
      far_products OR far_reviews AS is_outlier FROM cu_valid""")
def silver_customers(t: Tables):
    return users(t).valid.drop("silver_processed_at", "quality_issue")


@query("silver_customers_rejected", f"WITH {D_USERS} SELECT src_key, user_id, quality_issue FROM cu_rejected")
def silver_customers_rejected(t: Tables):
    return users(t).rejected.select("src_key", "user_id", "quality_issue")


@query("silver_parts", f"""WITH {D_PARTS}
    SELECT app_id, title, store_name, game_name, CAST(released AS VARCHAR) AS released, is_free_clean, genres,
      tags_insight, positive_ratio, price_final, price_final_capped, review_count, negatives, avg_votes_up,
      event_count, recommended, description, tags, summary, extensive, about, developer, owners, average_forever, ccu,
      outlier_reasons, outlier_reasons IS NOT NULL AS is_outlier FROM pt_valid""")
def silver_parts(t: Tables):
    return parts(t).valid.select(
        "app_id", "title", "store_name", "game_name", F.col("release_date_final").cast("string").alias("released"),
        "is_free_clean", F.array_join("genres", ",").alias("genres"),
        F.array_join("tags_insight", ",").alias("tags_insight"), "positive_ratio", "price_final",
        "price_final_capped", F.col("review_count_all_reviews").alias("review_count"),
        F.col("negative_review_count").alias("negatives"), F.round("avg_votes_up", 6).alias("avg_votes_up"),
        F.col("recommendation_event_count").alias("event_count"), F.col("recommended_count").alias("recommended"),
        "description", "tags", "summary", "extensive", "about", "developer", "owners", "average_forever", "ccu",
        "outlier_reasons", "is_outlier")


@query("silver_parts_rejected", f"WITH {D_PARTS} SELECT app_id, game_name, quality_issue FROM pt_rejected")
def silver_parts_rejected(t: Tables):
    return parts(t).rejected.select("app_id", "game_name", "quality_issue")


@query("silver_bridge_flags", f"WITH {D_BRIDGES} SELECT app_id, tag, value_length, is_outlier FROM br_valid")
def silver_bridge_flags(t: Tables):
    return tags(t).valid.select("app_id", "tag", "value_length", "is_outlier")


@query("silver_page_text", f"WITH {D_TEXTS} SELECT src_key, app_id, about_clean, about_len, is_outlier FROM pg_valid")
def silver_page_text(t: Tables):
    return texts(t).valid.select("src_key", "app_id", "about_clean", "about_len", "is_outlier")


@query("silver_page_text_rejected", f"WITH {D_TEXTS} SELECT src_key, app_id, quality_issue FROM pg_rejected")
def silver_page_text_rejected(t: Tables):
    return texts(t).rejected.select("src_key", "app_id", "quality_issue")


@query("gold_events_bi", f"""WITH {D_EVENTS}
    SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(app_id AS VARCHAR) AS app_id,
      CAST(user_id AS VARCHAR) AS user_id, review_text, CAST(review_text_length AS BIGINT) AS review_text_length,
      is_recommended, hours, weighted_vote_score, far_hours OR far_text AS is_outlier, quality_issue,
      '2024-01-01' AS batch_date FROM ev_valid""")
def gold_events_bi(t: Tables):
    return gold.reviews_bi(events(t).valid, t.ctx).drop("silver_processed_at", "bi_created_at")


# ---- reports -----------------------------------------------------------------

SETS = {"reviews": ("dirty_events", "ev"), "users": ("dirty_customer", "cu"), "game_text": ("dirty_pages", "pg"),
        "game_tags": ("dirty_bridge", "br"), "games": ("dirty_part", "pt")}
BUILD = {"reviews": events, "users": users, "game_text": texts, "game_tags": tags, "games": parts}
FAR = {"reviews": "far_hours OR far_text", "users": "far_products OR far_reviews", "game_text": "is_outlier",
       "game_tags": "is_outlier", "games": "outlier_reasons IS NOT NULL"}
D_ALL = ", ".join([D_EVENTS, D_USERS, D_TEXTS, D_BRIDGES, D_PARTS])
# Columns of the bronze fixture and of the silver table.
WIDTHS = {"reviews": (9, 15), "users": (4, 10), "game_text": (3, 9), "game_tags": (2, 6), "games": (5, 38)}


def _overview_row(table: str) -> str:
    bronze, short = SETS[table]
    wide, slim = WIDTHS[table]
    return f"""SELECT '{table}' AS table_name, (SELECT count(*) FROM {bronze}) AS b,
        (SELECT count(*) FROM {short}_valid) AS s, (SELECT count(*) FROM {short}_rejected) AS r,
        (SELECT count(*) FROM {short}_valid WHERE {FAR[table]}) AS o, {wide} AS cb, {slim} AS cs"""


@query("quality_overview", f"""WITH {D_ALL}, counted AS ({' UNION ALL '.join(map(_overview_row, SETS))})
    SELECT table_name, b AS bronze_row_count, s AS silver_row_count, r AS rejected_row_count,
      o AS silver_outlier_count, r / b AS rejected_rate, s / b AS retention_rate, o / s AS silver_outlier_rate,
      b - s - r AS row_delta, CAST(cb AS BIGINT) AS column_count_bronze, CAST(cs AS BIGINT) AS column_count_silver
    FROM counted""")
def quality_overview(t: Tables):
    """Five tables through their silver jobs, then counted by layer."""
    datasets = {}
    for table, (bronze, _) in SETS.items():
        made = BUILD[table](t)
        raw = t.fixture(bronze)
        datasets[table] = overview.Layers(raw.drop("is_free") if table == "games" else raw, made.valid, made.rejected)
    return overview.overview(t.spark, t.ctx, datasets).drop("overview_created_at")


def _issue_rows(table: str) -> str:
    bronze, short = SETS[table]
    return f"""SELECT '{table}' AS table_name, unnest(string_split(quality_issue, '|')) AS issue_name,
        (SELECT count(*) FROM {bronze}) AS b, (SELECT count(*) FROM {short}_rejected) AS r FROM {short}_rejected"""


@query("quality_issues", f"""WITH {D_EVENTS}, {D_USERS}, {D_PARTS},
    exploded AS ({' UNION ALL '.join(map(_issue_rows, ('reviews', 'games', 'users')))})
    SELECT table_name, issue_name, count(*) AS issue_count, count(*) / any_value(b) AS issue_rate_on_bronze,
      count(*) / any_value(r) AS issue_rate_on_rejected FROM exploded GROUP BY 1, 2""")
def quality_issues(t: Tables):
    return issues.issue_report(t.spark, t.ctx, {
        name: (t.fixture(SETS[name][0]), BUILD[name](t).rejected) for name in ("reviews", "games", "users")
    }).drop("created_at")


PROFILED = {"reviews": ["review_id", "app_id", "is_recommended", "review_text", "weighted_vote_score", "hours",
                        "review_text_length"],
            "users": ["user_id", "products", "reviews", "products_capped"]}


def _profile_sql(table: str, layer: str, column: str) -> str:
    bronze, short = SETS[table]
    source = bronze if layer == "bronze" else f"{short}_valid"
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS n,
        count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS d FROM {source}"""


def _side(layer: str) -> str:
    only_silver = {"review_text_length", "products_capped"}
    return " UNION ALL ".join(
        _profile_sql(table, layer, c) for table, names in PROFILED.items() for c in names
        if layer == "silver" or c not in only_silver)


@query("quality_columns", f"""WITH {D_EVENTS}, {D_USERS}, b AS ({_side('bronze')}), s AS ({_side('silver')})
    SELECT table_name, column_name, b.n AS bronze_row_count, s.n AS silver_row_count, b.nulls AS bronze_null_count,
      s.nulls AS silver_null_count, b.nulls / b.n AS bronze_null_rate, s.nulls / s.n AS silver_null_rate,
      coalesce(b.nulls / b.n, 0) - coalesce(s.nulls / s.n, 0) AS null_rate_improvement,
      b.d AS bronze_distinct_count, s.d AS silver_distinct_count
    FROM b FULL OUTER JOIN s USING (table_name, column_name)""")
def quality_columns(t: Tables):
    return column_reports.column_report(
        t.spark, t.ctx, {n: (t.fixture(SETS[n][0]), BUILD[n](t).valid) for n in PROFILED},
        PROFILED, approximate=False, on_missing="error").drop("created_at")


@query("quality_columns_approximate", f"""WITH {D_EVENTS}, {D_USERS}, b AS ({_side('bronze')}), s AS ({_side('silver')})
    SELECT table_name, column_name, b.n AS bronze_row_count, s.n AS silver_row_count, b.nulls AS bronze_null_count,
      s.nulls AS silver_null_count, CASE WHEN b.n IS NOT NULL THEN TRUE END AS bronze_distinct_near,
      CASE WHEN s.n IS NOT NULL THEN TRUE END AS silver_distinct_near
    FROM b FULL OUTER JOIN s USING (table_name, column_name)""")
def quality_columns_approximate(t: Tables):
    """The form that the jobs run: each estimate of distinct values lies within a sixth of the exact number."""
    datasets = {n: (t.fixture(SETS[n][0]), stage(BUILD[n](t).valid, n)) for n in PROFILED}
    near, exact = (column_reports.column_report(t.spark, t.ctx, datasets, PROFILED, approximate=a, on_missing="error")
                   for a in (True, False))
    distinct = {c: f"{c.split('_')[0]}_distinct" for c in ("bronze_distinct_count", "silver_distinct_count")}
    exact = exact.select("table_name", "column_name", *[F.col(c).alias(f"exact_{c}") for c in distinct])
    joined = near.join(exact, ["table_name", "column_name"])
    return joined.select(
        "table_name", "column_name", "bronze_row_count", "silver_row_count", "bronze_null_count", "silver_null_count",
        *[(6 * F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.col(f"exact_{c}")).alias(f"{new}_near") for c, new in distinct.items()])


IQR_COLUMNS = {"lines": ["l_quantity", "l_extendedprice", "l_tax"], "accounts": ["c_acctbal"],
               "events": ["value"]}
IQR_SOURCE = {"lines": "lineitem", "accounts": "customer", "events": "events"}


def _iqr_sql(table: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS v,
        quantile_disc({column}, 0.25) OVER () AS q1, quantile_disc({column}, 0.75) OVER () AS q3
        FROM {IQR_SOURCE[table]}"""


@query("quality_outliers", f"""WITH v AS ({' UNION ALL '.join(
        _iqr_sql(table, c) for table, names in IQR_COLUMNS.items() for c in names)}),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM v)
    SELECT table_name, column_name, count(*) AS row_count, count(v) AS non_null_count,
      count(*) FILTER (WHERE v < lo OR v > hi) AS outlier_count,
      count(*) FILTER (WHERE v < lo OR v > hi) / count(v) AS outlier_rate, any_value(q1) AS q1, any_value(q3) AS q3,
      any_value(iqr) AS iqr, any_value(lo) AS lower_bound, any_value(hi) AS upper_bound, min(v) AS min_value,
      max(v) AS max_value, round(avg(v), 6) AS mean_value FROM f GROUP BY 1, 2""")
def quality_outliers(t: Tables):
    tables = {name: t.table(source) for name, source in IQR_SOURCE.items()}
    return outlier_reports.outlier_report(t.spark, t.ctx, tables, IQR_COLUMNS, on_missing="error").drop(
        "created_at").withColumn("mean_value", F.round("mean_value", 6))


HISTOGRAMS = {
    "lines": [histograms.Bins("l_quantity", 5, 40), histograms.Bins("l_extendedprice", 5000, 90000),
              histograms.Bins("l_tax", 0.05, 1.0)],
    "accounts": [histograms.Bins("c_acctbal", 500, 8000)],
    "events": [histograms.Bins("value", 10, 200)],
}


def _histogram_sql(table: str, spec: histograms.Bins) -> str:
    size = f"CAST({spec.size} AS DOUBLE)"
    limit = "" if spec.max_value is None else f"AND {spec.column} <= {spec.max_value}"
    return f"""SELECT '{table}' AS table_name, '{spec.column}' AS column_name,
        floor({spec.column} / {size}) * {size} AS bucket_start,
        floor({spec.column} / {size}) * {size} + {size} AS bucket_end, {size} AS bucket_size, count(*) AS bin_count
        FROM {IQR_SOURCE[table]} WHERE {spec.column} IS NOT NULL {limit} GROUP BY 3"""


@query("quality_histograms", " UNION ALL ".join(
    _histogram_sql(table, spec) for table, specs in HISTOGRAMS.items() for spec in specs))
def quality_histograms(t: Tables):
    tables = {name: t.table(source) for name, source in IQR_SOURCE.items()}
    return histograms.histogram_report(t.spark, t.ctx, tables, HISTOGRAMS, on_missing="error").drop("created_at")


@query("histogram_fractional", _histogram_sql("lines", histograms.Bins("l_discount", 0.05)))
def histogram_fractional(t: Tables):
    return histograms.histogram(t.lineitem, "lines", [histograms.Bins("l_discount", 0.05)])


NUMBERS = {"c_custkey", "c_nationkey", "c_acctbal", "n_nationkey", "n_regionkey", "r_regionkey", "s_suppkey",
           "s_nationkey", "s_acctbal", "p_partkey", "p_size", "p_retailprice"}
COLUMNS = {
    "customer": {"c_custkey": "LongType()", "c_name": "StringType()", "c_nationkey": "IntegerType()",
                 "c_acctbal": "DoubleType()", "c_mktsegment": "StringType()"},
    "nation": {"n_nationkey": "IntegerType()", "n_name": "StringType()", "n_regionkey": "IntegerType()"},
    "region": {"r_regionkey": "IntegerType()", "r_name": "StringType()"},
    "supplier": {"s_suppkey": "LongType()", "s_name": "StringType()", "s_nationkey": "IntegerType()",
                 "s_acctbal": "DoubleType()"},
    "part": {"p_partkey": "LongType()", "p_name": "StringType()", "p_brand": "StringType()",
             "p_type": "StringType()", "p_size": "IntegerType()", "p_retailprice": "DoubleType()"},
}


def _null_sql(table: str, column: str, kind: str) -> str:
    return f"""'{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count,
        count(*) - count({column}) AS null_count, (count(*) - count({column})) / count(*) AS null_ratio,
        '{kind}' AS data_type"""


def _number_sql(column: str) -> str:
    if column not in NUMBERS:
        return ("CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, "
                "CAST(NULL AS DOUBLE) AS avg_value, CAST(NULL AS DOUBLE) AS stddev_value")
    return (f"CAST(min({column}) AS DOUBLE) AS min_value, CAST(max({column}) AS DOUBLE) AS max_value, "
            f"round(avg({column}), 4) AS avg_value, round(stddev_samp({column}), 4) AS stddev_value")


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in ("avg_value", "stddev_value")})


@query("profile_columns", " UNION ALL ".join(
    f"SELECT {_null_sql('customer', c, kind)} FROM customer" for c, kind in COLUMNS["customer"].items()))
def profile_columns(t: Tables):
    return profile.profile_columns(t.customer, "customer")


@query("profile_numeric", " UNION ALL ".join(
    f"SELECT 'part' AS table_name, '{c}' AS column_name, {_number_sql(c)} FROM part"
    for c in ("p_partkey", "p_size", "p_retailprice")))
def profile_numeric(t: Tables):
    return _rounded(profile.profile_numeric(t.part, "part"))


@query("profile_all_tables", " UNION ALL ".join(
    f"SELECT {_null_sql(table, c, kind)}, {_number_sql(c)}, count(DISTINCT {c}) AS distinct_count, TRUE AS estimate_is_near FROM {table}"
    for table, names in COLUMNS.items() for c, kind in names.items()))
def profile_all_tables(t: Tables):
    """Five tables; one that does not exist is passed over. Distinct values are counted to judge the estimates."""
    tables = {n: t.table(n) for n in COLUMNS}
    estimated = _rounded(profile.profile_tables({**tables, "missing": None})).withColumnRenamed("distinct_count", "estimate")
    return _judged(estimated, tables)


def _judged(estimated, tables):
    """With the true number of distinct values, and whether the estimate is within four standard errors of it."""
    exact = schema.union_all(
        df.agg(F.array(*[F.struct(F.lit(n).alias("table_name"), F.lit(c).alias("column_name"), F.count_distinct(c).alias("distinct_count"))
                         for c in df.columns]).alias("e")).select(F.inline("e")) for n, df in tables.items())
    room = F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (profile.CELLS / 2) * F.col("distinct_count"))
    near = F.abs(F.col("estimate") - F.col("distinct_count")) <= room
    return estimated.join(exact, ["table_name", "column_name"]).withColumn("estimate_is_near", near).drop("estimate")


@query("profile_merged", " UNION ALL ".join(
    f"SELECT {_null_sql(table, c, kind)}, {_number_sql(c)}, count(DISTINCT {c}) AS distinct_count, TRUE AS estimate_is_near FROM {table}"
    for table in ("customer", "part") for c, kind in COLUMNS[table].items()))
def profile_merged(t: Tables):
    """Profiles of two halves of tables, written as summaries and merged without reading the tables again."""
    tables = {n: t.table(n) for n in ("customer", "part")}
    key = {"customer": "c_custkey", "part": "p_partkey"}
    halves = [stage(profile.summarize({n: df.filter(F.col(key[n]) % 2 == half) for n, df in tables.items()}), "summaries") for half in (0, 1)]
    estimated = _rounded(profile.profile_of(halves[0].unionByName(halves[1]))).withColumnRenamed("distinct_count", "estimate")
    return _judged(estimated, tables)


DISTRIBUTED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_partkey"]


@query("profile_distribution", " UNION ALL ".join(f"""
    SELECT 'lineitem' AS table_name, '{c}' AS column_name, distinct_count, value_rank, value, value_count FROM (
      SELECT CAST({c} AS VARCHAR) AS value, count(*) AS value_count, count(*) OVER () AS distinct_count,
        rank() OVER (ORDER BY count(*) DESC) AS value_rank FROM lineitem GROUP BY 1)""" for c in DISTRIBUTED))
def profile_distribution(t: Tables):
    return profile.profile_distribution(t.lineitem, "lineitem", DISTRIBUTED)


# The rows that each report has for the customers and an empty silver layer of them, and its columns.
EMPTY_REPORTS = {
    "issues": ("0", issues.ISSUE_SCHEMA), "columns": ("0", column_reports.COLUMN_SCHEMA),
    "outliers": ("0", outlier_reports.OUTLIER_SCHEMA), "histograms": ("0", histograms.HISTOGRAM_SCHEMA),
    "overview": ("(SELECT count(*) FROM customer)", overview.OVERVIEW_SCHEMA),
}


def _names(schema_text: str) -> str:
    return ",".join(sorted(part.split()[0] for part in schema_text.split(",") if part.strip()))


@query("report_empty_schema", " UNION ALL ".join(
    f"SELECT '{name}' AS report, {n} AS n, '{_names(kind)}' AS columns" for name, (n, kind) in EMPTY_REPORTS.items()))
def report_empty_schema(t: Tables):
    """Reports over customers of which none is rejected and none is left: typed and empty, and an overview that counts them."""
    bronze, none = t.customer, t.customer.filter("c_custkey < 0")
    made = {
        "issues": issues.issue_report(t.spark, t.ctx, {"customer": (bronze, none)}),
        "columns": column_reports.column_report(t.spark, t.ctx, {"customer": (bronze, None)}, {"customer": ["c_name"]}),
        "outliers": outlier_reports.outlier_report(t.spark, t.ctx, {"customer": None}, {"customer": ["c_acctbal"]}),
        "histograms": histograms.histogram_report(t.spark, t.ctx, {"customer": none}, {"customer": [histograms.Bins("c_acctbal", 10)]}),
        "overview": overview.overview(t.spark, t.ctx, {"customer": overview.Layers(bronze, none, none)}),
    }
    counts = {name: F.max("bronze_row_count") if name == "overview" else F.count("*") for name in made}
    return schema.union_all(
        df.agg(F.lit(name).alias("report"), counts[name].alias("n"), F.lit(",".join(sorted(df.columns))).alias("columns"))
        for name, df in made.items())
