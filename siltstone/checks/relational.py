"""Joins, bridges, aggregates, quantiles and outliers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from siltstone.checks.base import NULLS, d_bool, d_double, d_long  # noqa: F401
from siltstone.checks.registry import Tables, query
from siltstone.operators import assemble, outliers, quantiles, schema
from siltstone.plans import silver

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def d_quantile(column: str, q: float, table: str) -> str:
    return f"(SELECT quantile_disc({column}, {q}) FROM {table})"


D_REVIEWS_AGG = f"""
    SELECT appid AS app_id, count(*) AS review_count_all_reviews,
      count(*) FILTER (WHERE {d_bool('voted_up', True)}) AS positive_review_count,
      count(*) FILTER (WHERE NOT ({d_bool('voted_up', True)})) AS negative_review_count,
      avg({d_long('votes_up')}) AS avg_votes_up, avg(votes_funny) AS avg_votes_funny,
      min(game) AS game_from_reviews
    FROM item_reviews GROUP BY 1"""
D_EVENTS_AGG = """
    SELECT app_id, count(*) AS recommendation_event_count, avg(hours) AS avg_recommendation_hours,
      avg(helpful) AS avg_helpful, avg(funny) AS avg_funny,
      count(*) FILTER (WHERE is_recommended = 'true') AS recommended_count
    FROM interactions GROUP BY 1"""
REVIEW_ROUND = """app_id, review_count_all_reviews, positive_review_count, negative_review_count,
    round(avg_votes_up, 6) AS avg_votes_up, round(avg_votes_funny, 6) AS avg_votes_funny, game_from_reviews"""
EVENT_ROUND = """app_id, recommendation_event_count, round(avg_recommendation_hours, 6) AS avg_recommendation_hours,
    round(avg_helpful, 6) AS avg_helpful, round(avg_funny, 6) AS avg_funny, recommended_count"""


@query("agg_reviews_per_item", f"SELECT {REVIEW_ROUND} FROM ({D_REVIEWS_AGG})")
def agg_reviews_per_item(t: Tables):
    reviews = t.fixture("item_reviews").withColumnRenamed("appid", "app_id")
    return assemble.reviews_per_item(reviews).selectExpr(*[
        f"round({c}, 6) AS {c}" if c.startswith("avg") else c for c in (
            "app_id", "review_count_all_reviews", "positive_review_count", "negative_review_count",
            "avg_votes_up", "avg_votes_funny", "game_from_reviews")])


@query("agg_interactions_per_item", f"SELECT {EVENT_ROUND} FROM ({D_EVENTS_AGG})")
def agg_interactions_per_item(t: Tables):
    return assemble.interactions_per_item(t.fixture("interactions")).selectExpr(*[
        f"round({c}, 6) AS {c}" if c.startswith("avg") else c for c in (
            "app_id", "recommendation_event_count", "avg_recommendation_hours", "avg_helpful", "avg_funny",
            "recommended_count")])


@query("agg_sorted_set", """
    SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_types,
      len(list(DISTINCT event_type)) AS n FROM events GROUP BY 1""")
def agg_sorted_set(t: Tables):
    sets = assemble.sorted_set(t.events, "user_id", "event_type", "types")
    return sets.select("user_id", F.array_join("types", ",").alias("event_types"),
                       F.size("types").cast("bigint").alias("n"))


@query("agg_distinct_exact", """
    SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
      count(DISTINCT l_extendedprice) AS prices FROM lineitem""")
def agg_distinct_exact(t: Tables):
    return t.lineitem.agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_extendedprice").alias("prices"))


@query("agg_distinct_approx", "SELECT TRUE AS orders_near, TRUE AS parts_near, TRUE AS prices_near")
def agg_distinct_approx(t: Tables):
    """Whether each estimate lies within a sixth of the exact number of distinct values of the whole table."""
    columns = {"orders": "l_orderkey", "parts": "l_partkey", "prices": "l_extendedprice"}
    near = t.lineitem.agg(*[F.approx_count_distinct(c).alias(f"{n}_near") for n, c in columns.items()])
    # An estimate beside exact counts in one aggregation would be kept for every distinct value; and each column apart needs no copies of rows.
    exact = [t.lineitem.agg(F.count_distinct(c).alias(n)) for n, c in columns.items()]
    both = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), exact, near)  # one row each
    return both.select(*[(6 * F.abs(F.col(f"{n}_near") - F.col(n)) <= F.col(n)).alias(f"{n}_near") for n in columns])


@query("master_join", f"""
    WITH reviews AS ({D_REVIEWS_AGG}), happenings AS ({D_EVENTS_AGG}),
      shippers AS (SELECT l_partkey AS app_id, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags
                   FROM lineitem GROUP BY 1)
    SELECT p_partkey AS app_id, p_name, p_retailprice, review_count_all_reviews, positive_review_count,
      negative_review_count, round(avg_votes_up, 6) AS avg_votes_up, game_from_reviews,
      recommendation_event_count, recommended_count, flags
    FROM part LEFT JOIN reviews r ON p_partkey = r.app_id LEFT JOIN happenings h ON p_partkey = h.app_id
      LEFT JOIN shippers s ON p_partkey = s.app_id""")
def master_join(t: Tables):
    """Part with three satellites of one row per part, and one that does not exist."""
    base = t.part.select(F.col("p_partkey").alias("app_id"), "p_name", "p_retailprice")
    flags = assemble.sorted_set(t.lineitem.withColumnRenamed("l_partkey", "app_id"), "app_id", "l_returnflag", "flag_set")
    joined = assemble.master_table(base, [
        assemble.reviews_per_item(t.fixture("item_reviews").withColumnRenamed("appid", "app_id")),
        None,
        assemble.interactions_per_item(t.fixture("interactions")),
        flags,
    ])
    return joined.select(
        "app_id", "p_name", "p_retailprice", "review_count_all_reviews", "positive_review_count",
        "negative_review_count", F.round("avg_votes_up", 6).alias("avg_votes_up"), "game_from_reviews",
        "recommendation_event_count", "recommended_count", F.array_join("flag_set", ",").alias("flags"))


D_BRIDGE = f"""bridged AS (
      SELECT DISTINCT {d_long('app_id')} AS app_id,
        regexp_replace(lower(trim(tag)), '\\s+', ' ', 'g') AS tag FROM dirty_bridge),
    bridge AS (SELECT app_id, tag, CAST(length(tag) AS INTEGER) AS value_length FROM bridged
               WHERE app_id IS NOT NULL AND tag IS NOT NULL AND tag <> '')"""


@query("bridge_build", f"""WITH {D_BRIDGE}
    SELECT app_id, tag, value_length, value_length > {d_quantile('value_length', 0.999, 'bridge')} AS is_outlier
    FROM bridge""")
def bridge_build(t: Tables):
    pairs = silver.silver_bridge(t.fixture("dirty_bridge"), "tag").valid
    return pairs.select("app_id", "tag", "value_length", "is_outlier")


@query("quantile_table", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS quantile, CAST(quantile_disc({c}, {q}) AS DOUBLE) AS value
        FROM lineitem""" for c in LINE_NUMBERS for q in (0.01, 0.25, 0.5, 0.999)))
def quantile_table(t: Tables):
    return quantiles.exact_quantiles(t.lineitem, LINE_NUMBERS, [0.01, 0.25, 0.5, 0.999])


@query("quantile_sketch", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS quantile, TRUE AS is_near" for c in LINE_NUMBERS for q in (0.25, 0.999)))
def quantile_sketch(t: Tables):
    """The sketched form: whether each value has a rank within the accuracy of the wanted one."""
    accuracy = 10_000
    sketched = quantiles.sketched_quantiles(t.lineitem, LINE_NUMBERS, [0.25, 0.999], accuracy)
    rows = quantiles.melt(t.lineitem, LINE_NUMBERS).join(
        F.broadcast(sketched.withColumnRenamed("value", "found")), "column_name")  # a row for each column and quantile
    ranks = rows.groupBy("column_name", "quantile").agg(
        F.count_if(F.col("value") < F.col("found")).alias("below"), F.count_if(F.col("value") <= F.col("found")).alias("upto"),
        F.count("*").alias("n"))
    wanted, room = F.col("quantile") * F.col("n"), F.col("n") / accuracy + 1
    near = (F.col("below") <= wanted + room) & (F.col("upto") >= wanted - room)
    return ranks.select("column_name", "quantile", near.alias("is_near"))


LIMITS = f"""limits AS (SELECT quantile_disc(l_quantity, 0.999) AS q, quantile_disc(l_extendedprice, 0.999) AS p,
    quantile_disc(l_discount, 0.95) AS unused FROM lineitem)"""


@query("outlier_flag_p999", f"""WITH {LIMITS}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
      NULLIF(concat_ws('|', CASE WHEN l_quantity > q THEN 'p999_outlier_l_quantity' END,
        CASE WHEN l_extendedprice > p THEN 'p999_outlier_l_extendedprice' END), '') AS outlier_reasons,
      l_quantity > q OR l_extendedprice > p AS is_outlier
    FROM lineitem, limits""")
def outlier_flag_p999(t: Tables):
    flagged = outliers.flag_and_cap(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"),
        flag=["l_quantity", "l_extendedprice"])
    return flagged.select("l_orderkey", "l_linenumber", "l_extendedprice",
                          silver.rules.as_text(F.col("outlier_reasons")).alias("outlier_reasons"), "is_outlier")


@query("outlier_cap_p999", f"""WITH {LIMITS}
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, least(l_quantity, q) AS l_quantity_capped,
      least(l_extendedprice, p) AS l_extendedprice_capped FROM lineitem, limits""")
def outlier_cap_p999(t: Tables):
    capped = outliers.flag_and_cap(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"),
        cap=["l_quantity", "l_extendedprice"])
    return capped.drop("outlier_reasons", "is_outlier")


@query("union_by_name", """
    SELECT 'nation' AS kind, CAST(n_nationkey AS BIGINT) AS id, n_name AS name, n_regionkey AS region FROM nation
    UNION ALL SELECT 'region', r_regionkey, r_name, NULL FROM region
    UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(t: Tables):
    """Three frames of different columns and column order."""
    kind = F.lit
    return schema.union_all([
        t.nation.select(kind("nation").alias("kind"), F.col("n_nationkey").cast("bigint").alias("id"),
                        F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")),
        t.region.select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("bigint").alias("id"),
                        kind("region").alias("kind")),
        t.supplier.select(F.col("s_suppkey").alias("id"), kind("supplier").alias("kind"),
                          F.col("s_name").alias("name")),
    ])
