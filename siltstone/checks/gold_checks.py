"""Gold tables, features and recommendation over all order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.checks.registry import Tables, query
from siltstone.plans import gold, recommend, vectors
from siltstone.sources.staging import stage


def interactions(t: Tables) -> DataFrame:
    """Typed: the recommendation flag as a boolean."""
    return t.fixture("interactions").withColumn("is_recommended", F.col("is_recommended") == "true")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


RATE = "avg(CASE WHEN is_recommended = 'true' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
D_ITEM_KPIS = f"""SELECT app_id, count(*) AS review_count, {RATE} AS recommend_rate, avg(hours) AS avg_hours
    FROM interactions GROUP BY 1"""
D_USER_KPIS = f"""SELECT user_id, count(*) AS interaction_count, count(DISTINCT app_id) AS item_count,
      round({RATE}, 6) AS recommend_rate, round(avg(hours), 6) AS avg_hours,
      CASE WHEN count(*) >= 50 THEN 'high' WHEN count(*) >= 20 THEN 'medium' ELSE 'low' END AS activity_level
    FROM interactions GROUP BY 1"""


@query("gold_item_kpis", f"""SELECT app_id, review_count, round(recommend_rate, 6) AS recommend_rate,
    round(avg_hours, 6) AS avg_hours FROM ({D_ITEM_KPIS})""")
def gold_item_kpis(t: Tables):
    return rounded(gold.item_kpis(interactions(t)), "recommend_rate", "avg_hours")


@query("gold_user_kpis", D_USER_KPIS)
def gold_user_kpis(t: Tables):
    return rounded(gold.user_kpis(interactions(t)), "recommend_rate", "avg_hours")


@query("gold_tag_trends", """
    SELECT month, tag, count(*) AS interaction_count,
      CAST(row_number() OVER (PARTITION BY month ORDER BY count(*) DESC, tag) AS INTEGER) AS tag_rank
    FROM interactions JOIN (SELECT DISTINCT app_id, tag FROM item_tags) USING (app_id) GROUP BY 1, 2""")
def gold_tag_trends(t: Tables):
    return gold.tag_trends(interactions(t), t.fixture("item_tags"))


@query("gold_platform_summary", " UNION ALL ".join(
    f"""SELECT '{p}' AS platform, is_free, count(*) AS item_count, round(avg(price), 6) AS avg_price
        FROM platform_items WHERE {p} GROUP BY is_free""" for p in ("win", "mac", "linux")))
def gold_platform_summary(t: Tables):
    return rounded(gold.platform_summary(t.fixture("platform_items")), "avg_price")


@query("feat_item", f"""
    WITH kpis AS ({D_ITEM_KPIS}),
      tags AS (SELECT app_id, array_to_string(list_sort(list(DISTINCT tag)), ',') AS tags FROM item_tags GROUP BY 1)
    SELECT app_id, is_free, price, tags, coalesce(review_count, 0) AS review_count,
      round(recommend_rate, 6) AS recommend_rate, round(avg_hours, 6) AS avg_hours,
      round(coalesce(ln(1 + review_count) / (SELECT ln(1 + max(review_count)) FROM kpis), 0), 6) AS popularity
    FROM platform_items LEFT JOIN tags USING (app_id) LEFT JOIN kpis USING (app_id)""")
def feat_item(t: Tables):
    items = t.fixture("platform_items").select("app_id", "is_free", "price")
    features = gold.item_features(items, interactions(t), t.fixture("item_tags"))
    return rounded(features.withColumn("tags", F.array_join("tags", ",")), "recommend_rate", "avg_hours", "popularity")


# The recommendation steps as SQL over the interactions ``inter``.
D_WEIGHT = """(CASE WHEN is_recommended = 'true' THEN 1 ELSE 0 END + ln(1 + hours)
    + CAST(0.1 AS DOUBLE) * ln(1 + CAST(helpful AS DOUBLE)))"""


def d_steps(inter: str, people: str = "SELECT DISTINCT user_id FROM inter") -> str:
    """All items that a user has not met, scored and ranked."""
    return f"""inter AS ({inter}),
    bridge AS (SELECT DISTINCT app_id, tag FROM item_tags),
    people AS ({people}),
    profile AS (SELECT user_id, tag, count(*) AS weight FROM inter JOIN bridge USING (app_id) GROUP BY 1, 2),
    favourite AS (SELECT user_id, tag AS favourite_tag FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY weight DESC, tag DESC) AS rn FROM profile) WHERE rn = 1),
    counts AS (SELECT app_id, count(*) AS n FROM inter GROUP BY 1),
    popular AS (SELECT app_id, round(ln(1 + n) / (SELECT ln(1 + max(n)) FROM counts), 6) AS popularity FROM counts),
    pairs AS (SELECT user_id, app_id FROM people CROSS JOIN (SELECT app_id FROM bridge UNION SELECT app_id FROM inter)
        ANTI JOIN inter USING (user_id, app_id)),
    most AS (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM bridge GROUP BY app_id)),
    heaviest AS (SELECT user_id, sum(weight) AS top FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC) AS k
        FROM profile) WHERE k <= (SELECT n FROM most) GROUP BY 1),
    shares AS (SELECT user_id, tag, weight / top AS share FROM profile JOIN heaviest USING (user_id)),
    content AS (SELECT p.user_id, p.app_id, sum(share) AS content_score FROM pairs p
        JOIN bridge b ON p.app_id = b.app_id JOIN shares s ON s.user_id = p.user_id AND s.tag = b.tag GROUP BY 1, 2),
    weighted AS (SELECT user_id, app_id, {D_WEIGHT} AS w FROM inter),
    of_users AS (SELECT user_id, avg(w) AS m FROM weighted GROUP BY 1), of_items AS (SELECT app_id, avg(w) AS m FROM weighted GROUP BY 1),
    ends AS (SELECT (SELECT min(m) FROM of_users) AS u0, (SELECT max(m) FROM of_users) AS u1,
        (SELECT min(m) FROM of_items) AS i0, (SELECT max(m) FROM of_items) AS i1, (SELECT avg(w) FROM weighted) AS o),
    parts AS (SELECT p.user_id, p.app_id, (coalesce(u.m, o) - u0 + coalesce(i.m, o) - i0) / (u1 - u0 + i1 - i0) AS c,
        coalesce(content_score, 0) AS t, coalesce(popularity, 0) AS p
        FROM pairs p LEFT JOIN content t ON t.user_id = p.user_id AND t.app_id = p.app_id LEFT JOIN popular f ON f.app_id = p.app_id
        LEFT JOIN of_users u ON u.user_id = p.user_id LEFT JOIN of_items i ON i.app_id = p.app_id, ends),
    scored AS (SELECT user_id, app_id, round(c, 6) AS cf_score, round(t, 6) AS content_score,
        p AS popularity_score,
        round(CAST(0.5 AS DOUBLE) * c + CAST(0.3 AS DOUBLE) * t + CAST(0.2 AS DOUBLE) * p, 6) AS final_score FROM parts),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, app_id) AS INTEGER)
        AS place FROM scored)"""


ALL = "SELECT * FROM interactions"
BUCKET = "(user_id * 31 + app_id * 17) % 10"


@query("feat_user", f"""WITH {d_steps(ALL)}, kpis AS ({D_USER_KPIS})
    SELECT k.*, favourite_tag FROM kpis k LEFT JOIN favourite USING (user_id)""")
def feat_user(t: Tables):
    return rounded(gold.user_features(interactions(t), t.fixture("item_tags")), "recommend_rate", "avg_hours")


@query("feat_interactions", f"""
    SELECT user_id, app_id, is_recommended = 'true' AS is_recommended, hours, helpful, funny,
      round({D_WEIGHT}, 6) AS interaction_weight FROM interactions""")
def feat_interactions(t: Tables):
    return rounded(gold.interaction_features(interactions(t)), "interaction_weight")


@query("train_split", f"""
    SELECT user_id, app_id, hours, CASE WHEN {BUCKET} < 2 THEN 'test' ELSE 'train' END AS split FROM interactions""")
def train_split(t: Tables):
    return split(t).select("user_id", "app_id", "hours", "split")


def split(t: Tables) -> DataFrame:
    bucket = F.pmod(F.col("user_id") * 31 + F.col("app_id") * 17, F.lit(10))
    return gold.with_split(interactions(t), bucket)


BEST = ["user_id", "app_id", "final_score", "place"]


@query("hybrid_score", f"""WITH {d_steps(ALL)}
    SELECT user_id, app_id, cf_score, content_score, popularity_score, final_score FROM ranked WHERE place <= 50""")
def hybrid_score(t: Tables):
    """The scores and the blend of the fifty best unseen items of each user."""
    return recommend.recommended(interactions(t), t.fixture("item_tags"), 50).drop("place", "looked")


@query("topn_per_user", f"""WITH {d_steps(ALL)}
    SELECT user_id, app_id, final_score, place FROM ranked WHERE place <= 10""")
def topn_per_user(t: Tables):
    """The ten best of all items that a user hasn't met."""
    return recommend.recommended(interactions(t), t.fixture("item_tags"), 10).select(*BEST)


@query("topn_filled", f"""WITH {d_steps(ALL, "SELECT c_custkey AS user_id FROM customer")}
    SELECT user_id, app_id, final_score, place FROM ranked WHERE place <= 10""")
def topn_filled(t: Tables):
    """Ten unseen items of every customer, also of those who have no interactions."""
    customers = t.customer.select(F.col("c_custkey").alias("user_id"))
    return recommend.recommended(interactions(t), t.fixture("item_tags"), 10, users=customers).select(*BEST)


@query("eval_at_k", f"""WITH {d_steps(f"SELECT * FROM interactions WHERE {BUCKET} >= 2")},
    truth AS (SELECT DISTINCT user_id, app_id FROM interactions WHERE {BUCKET} < 2),
    hits AS (SELECT user_id, count(*) AS h FROM ranked JOIN truth USING (user_id, app_id) WHERE place <= 10 GROUP BY 1),
    per_user AS (SELECT user_id, count(*) AS relevant FROM truth GROUP BY 1)
    SELECT count(*) AS users, CAST(sum(coalesce(h, 0)) AS BIGINT) AS hits,
      round(avg(coalesce(h, 0) / 10), 6) AS precision_at_k, round(avg(coalesce(h, 0) / relevant), 6) AS recall_at_k
    FROM per_user LEFT JOIN hits USING (user_id)""")
def eval_at_k(t: Tables):
    """Recommend from the training part as the job does, score against the held-out part."""
    sides = split(t)
    train, held_out = (sides.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    best = recommend.recommended(train, t.fixture("item_tags"), 10)
    return rounded(recommend.evaluate(best, held_out, 10), "precision_at_k", "recall_at_k")


@query("cf_scores", f"""WITH {d_steps(ALL)}
    SELECT user_id, app_id, TRUE AS is_finite FROM pairs""")
def cf_scores(t: Tables):
    """The trained score of every item that a user hasn't met; factors are not comparable across engines, what is checked is their use."""
    scores = recommend.unseen_scores(interactions(t), t.fixture("item_tags"))
    return scores.select("user_id", "app_id", (F.abs("cf_score") < float("inf")).alias("is_finite"))


@query("als_fit", "SELECT count(DISTINCT (user_id, app_id)) AS pairs, TRUE AS above_chance FROM interactions")
def als_fit(t: Tables):
    """Trained factors score the pairs that they were trained on higher than pairs on average.

    The mean over all users and items is the product of the mean vectors, so no pair is made for it.
    """
    inter = stage(interactions(t), "interactions")
    made = recommend.als_factors(gold.interaction_features(inter))
    users, items = (df.select(k, F.posexplode("vector").alias("at", "x")) for df, k in ((made.users, "user_id"), (made.items, "app_id")))
    means = [df.groupBy("at").agg(F.avg("x").alias(f"m{i}")) for i, df in enumerate((users, items))]
    chance = means[0].join(means[1], "at").agg(F.sum(F.col("m0") * F.col("m1")).alias("chance"))  # one row
    pairs = inter.select("user_id", "app_id").distinct().join(made.users.withColumnRenamed("vector", "u"), "user_id").join(
        made.items.select("app_id", F.col("vector").alias("i")), "app_id")
    product = F.aggregate(F.zip_with("u", "i", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return pairs.agg(F.count("*").alias("pairs"), F.avg(product).alias("mean")).crossJoin(F.broadcast(chance)).select(
        "pairs", (F.col("mean") > F.col("chance")).alias("above_chance"))


@query("similar_items", """
    WITH sets AS (SELECT app_id, list_sort(list(DISTINCT tag)) AS tags FROM item_tags GROUP BY 1),
      named AS (SELECT tags, min(app_id) AS set_id FROM sets GROUP BY 1),
      of_item AS (SELECT app_id, set_id FROM sets JOIN named USING (tags)),
      flat AS (SELECT set_id, len(tags) AS size, unnest(tags) AS tag FROM named),
      pairs AS (SELECT a.set_id AS s, b.set_id AS o, any_value(a.size) AS sa, any_value(b.size) AS sb, count(*) AS shared
        FROM flat a JOIN flat b ON a.tag = b.tag GROUP BY 1, 2)
    SELECT i.app_id, j.app_id AS similar_id, shared / (sa + sb - shared) AS jaccard
    FROM of_item i JOIN pairs ON s = i.set_id JOIN of_item j ON j.set_id = o
    WHERE shared / (sa + sb - shared) >= 0.6 - 1e-9 AND i.app_id <> j.app_id AND i.app_id % 100 = 0""")
def similar_items(t: Tables):
    """What resembles each item whose id is divisible by 100, of all items."""
    tags = t.fixture("item_tags")
    asked = tags.select("app_id").filter("app_id % 100 = 0")
    return recommend.similar_items(recommend.item_sets(tags), recommend.content_similarity(tags), asked)

@query("content_similarity", """
    WITH sets AS (SELECT app_id, list_sort(list(DISTINCT tag)) AS tags FROM item_tags GROUP BY 1),
      named AS (SELECT tags, min(app_id) AS set_id, count(*) AS items FROM sets GROUP BY 1),
      flat AS (SELECT set_id, items, len(tags) AS size, unnest(tags) AS tag FROM named),
      pairs AS (SELECT a.set_id AS set_id_a, b.set_id AS set_id_b, any_value(a.items) AS items_a,
          any_value(b.items) AS items_b, any_value(a.size) AS sa, any_value(b.size) AS sb, count(*) AS shared
        FROM flat a JOIN flat b ON a.tag = b.tag AND a.set_id < b.set_id GROUP BY 1, 2)
    SELECT set_id_a, set_id_b, items_a, items_b, shared / (sa + sb - shared) AS jaccard FROM pairs
    WHERE shared / (sa + sb - shared) >= 0.6 - 1e-9""")
def content_similarity(t: Tables):
    return recommend.content_similarity(t.fixture("item_tags"))


D_PROFILES = f"""
    flat AS (SELECT app_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM item_vectors),
    weighted AS (SELECT user_id, app_id, sum({D_WEIGHT}) AS w FROM interactions GROUP BY 1, 2),
    profiles AS (SELECT user_id, CAST(i - 1 AS INTEGER) AS dimension, sum(w * CAST(x AS DOUBLE)) / sum(w) AS v
      FROM weighted JOIN flat USING (app_id) GROUP BY 1, 2)"""


def user_profiles(t: Tables) -> DataFrame:
    return recommend.user_profiles(gold.interaction_features(interactions(t)), t.fixture("item_vectors"))


@query("embed_user_profile", f"WITH {D_PROFILES} SELECT user_id, dimension, round(v, 6) AS value FROM profiles")
def embed_user_profile(t: Tables):
    """The weighted mean of the vectors of all items that a user has met."""
    return user_profiles(t).select("user_id", F.posexplode("profile").alias("dimension", "value")).withColumn(
        "value", F.round("value", 6))


@query("embed_neighbours", f"""WITH {D_PROFILES},
    cosines AS (SELECT p.user_id, w.app_id, round(sum(v * CAST(x AS DOUBLE)) / (sqrt(sum(v * v))
        * sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS cosine
      FROM weighted w JOIN flat f USING (app_id) JOIN profiles p ON p.user_id = w.user_id AND p.dimension = f.i - 1
      GROUP BY 1, 2)
    SELECT user_id, app_id, cosine, place FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY user_id ORDER BY cosine DESC, app_id) AS INTEGER) AS place FROM cosines) WHERE place <= 3""")
def embed_neighbours(t: Tables):
    """Of all items a user has met those closest to the user's profile."""
    cosines = recommend.profile_neighbours(gold.interaction_features(interactions(t)), t.fixture("item_vectors"))
    return recommend.top_n(cosines, 3, score="cosine")


def d_nearest(k: int) -> str:
    """The nearest of ``pool`` (id, v) for each of ``asked`` (query, v), but for the pairs ``met``."""
    return f"""cosines AS (SELECT query, p.id, round(list_dot_product(a.v, p.v)
        / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(p.v, p.v))), 6) AS cosine
      FROM asked a CROSS JOIN pool p ANTI JOIN met m ON m.query = a.query AND m.id = p.id)
    SELECT query, id, cosine, place FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY query ORDER BY cosine DESC, id) AS INTEGER) AS place FROM cosines) WHERE place <= {k}"""


@query("embed_nearest", f"""WITH pool AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    asked AS (SELECT id AS query, v FROM pool WHERE id % 100 = 0), met AS (SELECT query, query AS id FROM asked),
    {d_nearest(10)}""")
def embed_nearest(t: Tables):
    """For each vector whose id is divisible by 100 the ten nearest of all others, compared one by one."""
    pool, asked = pool_and_asked(t)
    return vectors.nearest(pool, asked, vectors.EXACT)


def pool_and_asked(t: Tables) -> tuple[DataFrame, DataFrame]:
    pool = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return pool, pool.filter("id % 100 = 0").withColumn("seen", F.array("id"))


@query("embed_index", """SELECT count(*) AS queries, count(*) * least(10, (SELECT count(*) - 1 FROM embeddings)) AS pairs,
    TRUE AS recall_reached FROM embeddings WHERE vec_id % 100 = 0""")
def embed_index(t: Tables):
    """Whether the index over all vectors finds at least nine tenths of what the comparison one by one finds."""
    pool, asked = pool_and_asked(t)
    found = vectors.nearest(pool, asked, vectors.fitted(pool))
    row = vectors.recall(found, vectors.nearest(pool, asked, vectors.EXACT))
    return row.select("queries", "pairs", (F.col("recall") >= 0.9).alias("recall_reached"))


@query("embed_unseen", f"""WITH {D_PROFILES},
    pool AS (SELECT app_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM item_vectors),
    asked AS (SELECT user_id AS query, list(v ORDER BY dimension) AS v FROM profiles WHERE user_id % 100 = 0 GROUP BY 1),
    met AS (SELECT DISTINCT user_id AS query, app_id AS id FROM interactions),
    {d_nearest(10)}""")
def embed_unseen(t: Tables):
    """For each user whose id is divisible by 100 the ten items nearest to the profile, of all that the user hasn't met."""
    pool = t.fixture("item_vectors").select(F.col("app_id").alias("id"), F.col("embedding").alias("vector"))
    asked = recommend.profile_queries(user_profiles(t).filter("user_id % 100 = 0"), interactions(t))
    return vectors.nearest(pool, asked, vectors.EXACT)
