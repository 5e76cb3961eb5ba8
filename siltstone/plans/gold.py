"""Silver to gold: tables for business reports and features for models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.context import RunContext
from siltstone.operators import assemble, schema, skew
from siltstone.plans.silver import review_booleans
from siltstone.sources.staging import stage as write_stage

Stage = Callable[[DataFrame, str], DataFrame]


def reviews_bi_schema(store: str) -> T.StructType:
    """The fixed column order and types of the review table for reports."""
    target = T.StructType()
    for name in ("review_id", "app_id", "user_id", "review_text"):
        target = target.add(name, "string")
    target = target.add("review_text_length", "long")
    for name in review_booleans(store):
        target = target.add(name, "boolean")
    target = target.add("hours", "double").add("helpful", "long").add("funny", "long")
    target = target.add("comment_count", "long").add("weighted_vote_score", "double")
    for name in ("author_num_games_owned", "author_num_reviews", "author_playtime_forever",
                 "author_playtime_last_two_weeks"):
        target = target.add(name, "long")
    return (target.add("is_outlier", "boolean").add("quality_issue", "string")
            .add("quality_reason", "string").add("silver_processed_at", "timestamp"))


def reviews_bi(reviews: DataFrame, ctx: RunContext) -> DataFrame:
    """Report-ready reviews: fixed types, keys as text, no source times."""
    return schema.conform(reviews, reviews_bi_schema(ctx.store)).select(
        "*", ctx.batch().alias("batch_date"), ctx.stamp().alias("bi_created_at"))


def item_kpis(interactions: DataFrame) -> DataFrame:
    """Interactions, share of recommendations and mean hours per item."""
    return interactions.groupBy("app_id").agg(
        F.count("*").alias("review_count"),
        F.avg(F.col("is_recommended").cast("double")).alias("recommend_rate"),
        F.avg("hours").alias("avg_hours"))


# Fixed by this engine: least number of interactions of an activity level.
ACTIVITY_LEVELS = {"high": 50, "medium": 20, "low": 0}


def activity_level(count: Column) -> Column:
    level = F.lit(None).cast("string")
    for name, least in sorted(ACTIVITY_LEVELS.items(), key=lambda item: item[1]):
        level = F.when(count >= least, F.lit(name)).otherwise(level)
    return level


def user_kpis(interactions: DataFrame) -> DataFrame:
    """Interactions, distinct items, share of recommendations, hours and activity per user."""
    per_user = interactions.groupBy("user_id").agg(
        F.count("*").alias("interaction_count"),
        F.count_distinct("app_id").alias("item_count"),
        F.avg(F.col("is_recommended").cast("double")).alias("recommend_rate"),
        F.avg("hours").alias("avg_hours"))
    return per_user.withColumn("activity_level", activity_level(F.col("interaction_count")))


def tag_trends(interactions: DataFrame, bridge: DataFrame, value: str = "tag") -> DataFrame:
    """All tags (or genres, categories: ``value``) of each month with their rank by interactions.

    Facts are counted per item and month before they meet the tags, so an item
    with very many facts is a handful of rows in the join; the ranking sees one row per month and tag.
    """
    monthly = interactions.groupBy("app_id", "month").agg(F.count("*").alias("n"))
    counted = (
        monthly.join(bridge.select("app_id", value).distinct(), "app_id")
        .groupBy("month", value).agg(F.sum("n").alias("interaction_count"))
    )
    order = Window.partitionBy("month").orderBy(F.desc("interaction_count"), value)
    return counted.withColumn(f"{value}_rank", F.row_number().over(order))


def platform_summary(items: DataFrame, platforms: tuple[str, ...] = ("win", "mac", "linux")) -> DataFrame:
    """Items and mean price per platform, free against paid."""
    flags = F.array(*[F.struct(F.lit(p).alias("platform"), F.col(p).alias("runs")) for p in platforms])
    return (
        items.select("is_free", "price", F.inline(flags)).filter("runs")
        .groupBy("platform", "is_free")
        .agg(F.count("*").alias("item_count"), F.avg("price").alias("avg_price"))
    )


def item_features(items: DataFrame, interactions: DataFrame, bridge: DataFrame) -> DataFrame:
    """Items with their tags, KPIs and popularity (log of the count, scaled to 0..1)."""
    kpis = item_kpis(interactions)
    tags = assemble.sorted_set(bridge, "app_id", "tag", "tags")
    joined = assemble.master_table(items, [tags, kpis]).fillna({"review_count": 0})
    most = kpis.agg(F.log1p(F.max("review_count"))).scalar()
    return joined.withColumn("popularity", F.coalesce(F.log1p("review_count") / F.nullif(most, F.lit(0.0)), F.lit(0.0)))


#: Pairs of a user and an item whose tags a task adds up.
PROFILE_ROWS = 500_000


def user_items(interactions: DataFrame, stage: Stage = write_stage) -> DataFrame:
    """(user_id, app_id, times), written."""
    return stage(interactions.groupBy("user_id", "app_id").agg(F.count("*").alias("times")), "user-items")


def _tagged_by_user(pairs: DataFrame, tags: DataFrame, how: str) -> DataFrame:
    """The pairs with the tags of their items, dealt by user."""
    tagged = skew.lookup_join(pairs, tags, ["app_id"], how=how)
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // PROFILE_ROWS))
    return tagged.repartition(tasks, "user_id")


def tag_profile(interactions: DataFrame, bridge: DataFrame, stage: Stage = write_stage) -> DataFrame:
    """(user_id, tag, weight): how many of the user's interactions carry the tag.

    Facts are counted per user and item first, and written, as the join reads them twice; the tags of an item come in one
    row, through a join that holds up when one item has a large share of the users. The rows meet by user before their tags are
    listed, in as many tasks as there are ``PROFILE_ROWS``, so a task's weights don't grow with the input.
    """
    tagged = _tagged_by_user(user_items(interactions, stage), assemble.sorted_set(bridge, "app_id", "tag", "tags"), "inner")
    return (
        tagged.select("user_id", "times", F.explode("tags").alias("tag"))
        .groupBy("user_id", "tag").agg(F.sum("times").alias("weight"))
    )


def _lists(batch: pa.Table) -> pa.RecordBatch:
    """The rows of whole users, a user's rows in one run, to a row for each user."""
    user = batch["user_id"].combine_chunks()
    coded = user.dictionary_encode()
    owner = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)  # in the order of the runs
    order = np.argsort(owner, kind="stable")
    items = batch["app_id"].combine_chunks().take(pa.array(order))
    tags = batch["tags"].combine_chunks()
    size = pc.fill_null(tags.value_lengths(), 0).to_numpy(zero_copy_only=False)
    tag, of = tags.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(owner, size)
    times = np.repeat(batch["times"].to_numpy(), size)
    key = (of << 32) + tag
    by_key = np.argsort(key, kind="stable")
    key, times = key[by_key], times[by_key]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    weight, key = np.add.reduceat(times, first) if len(first) else times, key[first]
    of, tag = key >> 32, key & 0xFFFFFFFF
    best = np.lexsort((-tag, -weight, of))
    users = len(coded.dictionary)
    ends = lambda x: pa.array(np.concatenate([[0], np.cumsum(np.bincount(x, minlength=users))]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [coded.dictionary, pa.ListArray.from_arrays(ends(of), pa.array(tag[best].astype(np.int32))),
         pa.ListArray.from_arrays(ends(of), pa.array(weight[best])), pa.ListArray.from_arrays(ends(owner), items)],
        ["user_id", "tags", "weights", "seen"])


def tag_lists(pairs: DataFrame, tags: DataFrame) -> DataFrame:
    """(user_id, tags, weights, seen): the user's tags, heaviest first, how many interactions carry each, and the items met.

    ``pairs`` from ``user_items``, with no null in it, ``tags``: (app_id, tags array<int>). The weights are those of ``tag_profile``, added up for some thousand
    pairs at a time without a row for each tag of a pair. Rows come sorted by user, so a task holds one batch and the user that it ends with.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            user = batch.column("user_id")
            if held and user[0] != held[-1].column("user_id")[-1]:
                yield _lists(pa.Table.from_batches(held))
                held = []
            runs = pc.run_end_encode(user)
            at = runs.run_ends[-2].as_py() if len(runs.run_ends) > 1 else 0
            if at:
                yield _lists(pa.Table.from_batches([*held, batch.slice(0, at)]))
                held = []
            held.append(batch.slice(at))
        if held:
            yield _lists(pa.Table.from_batches(held))

    kinds = {c: pairs.schema[c].dataType.simpleString() for c in ("user_id", "app_id")}
    rows = _tagged_by_user(pairs, tags, "left").select("user_id", "app_id", "times", "tags")
    return rows.sortWithinPartitions("user_id").mapInArrow(
        run, f"user_id {kinds['user_id']}, tags array<int>, weights array<long>, seen array<{kinds['app_id']}>")


def favourite_tag(profile: DataFrame) -> DataFrame:
    """The heaviest tag of each user; of equal ones the last in order."""
    return profile.groupBy("user_id").agg(F.max_by("tag", F.struct("weight", "tag")).alias("favourite_tag"))


def user_features(interactions: DataFrame, bridge: DataFrame, users: DataFrame | None = None, stage: Stage = write_stage) -> DataFrame:
    """User KPIs, the favourite tag and, where the user table is given, owned items and reviews."""
    owned = None if users is None else users.select(
        "user_id", F.col("products").alias("owned_items"), F.col("reviews").alias("written_reviews"))
    return assemble.master_table(
        user_kpis(interactions), [favourite_tag(tag_profile(interactions, bridge, stage)), owned], "user_id")


def interaction_weight(recommended: Column, hours: Column, helpful: Column) -> Column:
    """1 for a recommendation, plus the logs of the hours and (a tenth of) the helpful votes."""
    return (
        F.coalesce(recommended.cast("double"), F.lit(0.0))
        + F.log1p(F.greatest(F.coalesce(hours, F.lit(0.0)), F.lit(0.0)))
        + 0.1 * F.log1p(F.greatest(F.coalesce(helpful.cast("double"), F.lit(0.0)), F.lit(0.0)))
    )


def interaction_features(interactions: DataFrame) -> DataFrame:
    """Interactions with their weight; one projection, no shuffle."""
    weight = interaction_weight(F.col("is_recommended"), F.col("hours"), F.col("helpful"))
    kept = schema.present(interactions, [
        "user_id", "app_id", "is_recommended", "hours", "helpful", "funny", "review_length"])
    return interactions.select(*kept, weight.alias("interaction_weight"))


def with_split(interactions: DataFrame, bucket: Column | None = None, holdout: int = 2) -> DataFrame:
    """Mark each user-item pair ``train`` or ``test``; ``holdout`` tenths are for the test.

    The bucket is a hash of the pair, so all rows of a pair are on the same side
    whatever the partitioning.
    """
    bucket = F.pmod(F.xxhash64("user_id", "app_id"), F.lit(10)) if bucket is None else bucket
    return interactions.withColumn("split", F.when(bucket < holdout, "test").otherwise("train"))
