"""Bronze to silver: clean, judge, split, mark outliers.

Each function turns bronze frames into a valid and a rejected frame. The judged
rows are staged once (see ``sources.staging``); the split, the thresholds and both
outputs then read the staged table with only the columns they need. Text lengths
are staged with them, so no threshold reads the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.functions import clean
from siltstone.operators import assemble, dedup, outliers, rules, schema
from siltstone.sources.readers import ROW_ID
from siltstone.sources.staging import stage as write_stage

# Cut-offs and limits.
OLDEST_TIME = "1900-01-01 00:00:00"
USER_COUNT_LIMIT = 10_000_000
TEXT_LENGTH_LIMIT = 200_000
RELEASE_DAYS_AHEAD = 30

# Raw review columns and their silver names.
REVIEW_NAMES = {
    "recommendationid": "review_id",
    "appid": "app_id",
    "author_{store}id": "user_id",
    "author_playtime_at_review": "hours",
    "votes_up": "helpful",
    "votes_funny": "funny",
    "review": "review_text",
    "voted_up": "is_recommended",
}
REVIEW_KEYS = ["review_id", "app_id", "user_id"]
REVIEW_COUNTS = [
    "author_num_games_owned",
    "author_num_reviews",
    "author_playtime_forever",
    "author_playtime_last_two_weeks",
    "hours",
    "helpful",
    "funny",
    "comment_count",
]
REVIEW_DOUBLES = ["hours", "weighted_vote_score"]
REVIEW_TIMES = ["timestamp_created", "timestamp_updated"]

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Silver:
    valid: DataFrame
    rejected: DataFrame


def review_names(store: str) -> dict[str, str]:
    """``REVIEW_NAMES`` with the store's own column names."""
    return {old.format(store=store): new for old, new in REVIEW_NAMES.items()}


def review_booleans(store: str) -> list[str]:
    return [
        "is_recommended",
        f"{store}_purchase",
        "received_for_free",
        "written_during_early_access",
        f"hidden_in_{store}_china",
    ]


def _order(df: DataFrame, order_by: list[str] | None) -> list[str]:
    """The given order, else the file position, else all columns."""
    if order_by:
        return order_by
    return ROW_ID if set(ROW_ID) <= set(df.columns) else df.columns


def _unique_order(df: DataFrame, order_by: list[str] | None) -> list[str]:
    if order_by is None and not set(ROW_ID) <= set(df.columns):
        raise ValueError("give order_by, or read the table with its row ids")
    return order_by or ROW_ID


def _with_text(df: DataFrame) -> DataFrame:
    """Reasons as ``|``-joined text, without the helper columns."""
    text = {"quality_issue": rules.as_text(F.col(rules.ISSUES))}
    if outliers.REASONS in df.columns:
        text[outliers.REASONS] = rules.as_text(F.col(outliers.REASONS))
    else:
        text[outliers.REASONS] = F.lit(None).cast("string")
    return df.withColumns(text).drop(rules.ISSUES, dedup.DUPLICATE, *ROW_ID)


def _split(judged: DataFrame, rule_set: list[rules.Rule]) -> tuple[DataFrame, DataFrame]:
    rejected = rules.is_rejected(rule_set)
    return judged.filter(~rejected), judged.filter(rejected)


def silver_reviews(df: DataFrame, ctx: RunContext, stage: Stage = write_stage,
                   accuracy: int | None = None, time_text: str = "time") -> Silver:
    """Reviews: only key issues and repeated ids reject; the rest stays annotated.

    A key column that is not there rejects every row. ``time_text`` tells how the source
    writes times as text: ``"time"`` or ``"epoch"``.
    """
    df = clean.clean_strings(schema.rename_present(df, review_names(ctx.store)))
    longs = [c for c in [*REVIEW_KEYS, *REVIEW_COUNTS] if c not in REVIEW_DOUBLES]
    booleans = schema.present(df, review_booleans(ctx.store))
    times = schema.present(df, REVIEW_TIMES)
    df = df.withColumns({
        **{c: clean.to_long(df, c) for c in schema.present(df, longs)},
        **{c: clean.to_double(df, c) for c in schema.present(df, REVIEW_DOUBLES)},
        **{c: clean.to_boolean(F.col(c)) for c in booleans},
        **{c: clean.to_timestamp(df, c, time_text) for c in times},
        "silver_processed_at": ctx.stamp(),
    })
    df = dedup.mark_all_copies(df, ["review_id"], stage) if "review_id" in df.columns else (
        df.withColumn(dedup.DUPLICATE, F.lit(False)))

    oldest = F.lit(datetime.fromisoformat(OLDEST_TIME)).cast("timestamp_ntz").cast("timestamp")
    rule_set = [
        *[rule for c in REVIEW_KEYS for rule in rules.column_exists(df, c)],
        *[rules.not_null(c, f"missing_{c}") for c in schema.present(df, REVIEW_KEYS)],
        rules.Rule("duplicate_review_id", F.col(dedup.DUPLICATE)),
        *[rules.empty_text(c, f"empty_{c}", hard=False) for c in schema.present(df, ["review_text"])],
        *[rules.non_negative(c, hard=False) for c in schema.present(df, REVIEW_COUNTS)],
        *[rules.invalid_boolean(c, hard=False) for c in booleans],
        *[rules.earlier_than(c, oldest, f"ancient_{c}", hard=False) for c in times],
        *[rules.in_range(c, 0.0, 1.0, f"invalid_{c}", hard=False)
          for c in schema.present(df, ["weighted_vote_score"])],
    ]
    lengths = {f"{c}_length": F.length(c) for c in schema.present(df, ["review_text"])}
    judged = rules.annotate(df, rule_set).withColumns(
        {c: F.when(F.col(c) >= oldest, F.col(c)) for c in times} | lengths)
    judged = stage(judged, "reviews")

    valid, rejected = _split(judged, rule_set)
    counts = schema.present(valid, REVIEW_COUNTS)
    valid = outliers.flag_and_cap(valid, [*counts, *lengths], counts, accuracy=accuracy)
    return Silver(_with_text(valid), _with_text(rejected.drop(*lengths)))


# The columns of each source of the item table and their order in it.
BASE_COLUMNS = [
    "title", "date_release", "win", "mac", "linux", "rating", "positive_ratio", "user_reviews",
    "price_final", "price_original", "discount", "{store}_deck",
]
STORE_COLUMNS = ["name", "release_date", "is_free", "price_overview", "languages", "type"]
META_COLUMNS = ["description", "tags"]
TEXT_COLUMNS = ["summary", "extensive", "about"]
USAGE_COLUMNS = [
    "developer", "publisher", "owners", "average_forever", "average_2weeks", "median_forever",
    "median_2weeks", "ccu",
]
ARRAYS = {"genre": "genres", "tag": "tags_insight", "category": "categories"}
GAME_COLUMNS = [
    "app_id", "title", "{store}_name", "game_name", "date_release", "{store}_release_date",
    "release_date_final", "win", "mac", "linux", "rating", "positive_ratio", "user_reviews",
    "price_final", "price_original", "discount", "{store}_deck", "{store}_is_free", "is_free_clean",
    "{store}_price_overview", "{store}_languages", "{store}_type", "description", "tags", "summary",
    "extensive", "about", "genres", "tags_insight", "categories", "review_count_all_reviews",
    "positive_review_count", "negative_review_count", "avg_votes_up", "avg_votes_funny",
    "recommendation_event_count", "avg_recommendation_hours", "avg_helpful", "avg_funny",
    "recommended_count", "developer", "publisher", "owners", "average_forever", "average_2weeks",
    "median_forever", "median_2weeks", "ccu",
]
GAME_NUMBERS = [
    "positive_ratio", "user_reviews", "price_final", "price_original", "discount",
    "review_count_all_reviews", "positive_review_count", "negative_review_count", "avg_votes_up",
    "avg_votes_funny", "recommendation_event_count", "avg_recommendation_hours", "avg_helpful",
    "avg_funny", "recommended_count", "average_forever", "average_2weeks", "median_forever",
    "median_2weeks", "ccu",
]
GAME_NON_NEGATIVE = [
    "positive_ratio", "user_reviews", "price_final", "price_original", "discount",
    "review_count_all_reviews", "positive_review_count", "negative_review_count",
    "recommendation_event_count",
]
GAME_OUTLIERS = [
    "price_final", "price_original", "user_reviews", "review_count_all_reviews",
    "recommendation_event_count",
]


def _for_store(names: list[str], store: str) -> list[str]:
    return [n.format(store=store) for n in names]


def _source(df: DataFrame | None, key: str = "app_id") -> DataFrame | None:
    if df is None or key not in df.columns:
        return None
    return schema.normalize_key(schema.drop_metadata(clean.clean_strings(df)), key, "app_id")


def _one_per_item(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """The first row of each item, with the columns to carry over."""
    slim = schema.select_as(df, "app_id", {**renames, **{c: c for c in ROW_ID}})
    placed = set(ROW_ID) <= set(slim.columns)
    return dedup.keep_first(slim, ["app_id"], _order(slim, None), unique=placed).drop(*ROW_ID)


def silver_games(sources: Mapping[str, DataFrame | None], ctx: RunContext, stage: Stage = write_stage,
                 accuracy: int | None = None) -> Silver:
    """The item master table.

    ``sources``: ``base`` and, where they exist, ``store_games``, ``metadata``,
    ``promotional``, ``usage``, ``reviews`` (key ``appid``) and ``interactions``.
    """
    store = ctx.store
    base = _source(sources["base"])
    store_games = _source(sources.get("store_games"))
    events = _source(sources.get("interactions"))
    reviews = _source(sources.get("reviews"), "appid")

    def satellite(name: str, columns: list[str]) -> DataFrame | None:
        df = _source(sources.get(name))
        return None if df is None else _one_per_item(df, {c: c for c in columns})

    games = assemble.master_table(
        _one_per_item(base, {c: c for c in _for_store(BASE_COLUMNS, store)}),
        [
            None if store_games is None else _one_per_item(
                store_games, {c: f"{store}_{c}" for c in STORE_COLUMNS}),
            satellite("metadata", META_COLUMNS),
            satellite("promotional", TEXT_COLUMNS),
            satellite("usage", USAGE_COLUMNS),
            None if reviews is None else assemble.reviews_per_item(reviews),
            assemble.interactions_per_item(base if events is None else events),
            *[
                assemble.sorted_set(store_games, "app_id", value, name)
                for value, name in ARRAYS.items()
                if store_games is not None and value in store_games.columns
            ],
        ])

    dates = schema.present(games, ["date_release", f"{store}_release_date"])
    games = games.withColumns({c: clean.to_date(F.col(c)) for c in dates})
    derived = {"game_name": clean.first_present(games, ["title", f"{store}_name", "game_from_reviews"])}
    if dates:
        derived["release_date_final"] = clean.first_present(games, dates)
    if f"{store}_is_free" in games.columns:
        derived["is_free_clean"] = clean.flag_to_boolean(games, f"{store}_is_free")
    games = games.withColumns(derived)
    games = schema.select_present(games, _for_store(GAME_COLUMNS, store))
    games = games.withColumns({c: clean.to_double(games, c) for c in schema.present(games, GAME_NUMBERS)})

    rule_set = [
        rules.not_null("app_id", "missing_app_id"),
        rules.empty_text("game_name", "missing_game_name"),
        *[rules.non_negative(c) for c in schema.present(games, GAME_NON_NEGATIVE)],
        *[rules.in_range(c, 0.0, 100.0, f"invalid_{c}")
          for c in schema.present(games, ["positive_ratio", "discount"])],
        *[rules.too_far_ahead(c, ctx.today, RELEASE_DAYS_AHEAD, "release_date_too_far_in_future")
          for c in schema.present(games, ["release_date_final"])],
    ]
    judged = rules.annotate(games, rule_set).withColumn("game_name_length", F.length("game_name"))
    valid, rejected = _split(stage(judged, "games"), rule_set)
    counts = schema.present(valid, GAME_OUTLIERS)
    valid = outliers.flag_and_cap(valid, [*counts, "game_name_length"], counts, accuracy=accuracy)
    return Silver(_with_text(valid), _with_text(rejected.drop("game_name_length")))


def silver_users(df: DataFrame, ctx: RunContext, stage: Stage = write_stage,
                 order_by: list[str] | None = None, accuracy: int | None = None) -> Silver:
    """Users: any issue rejects; the first row of a user stays, its copies do not."""
    df = clean.clean_strings(df)
    counts = schema.present(df, ["products", "reviews"])
    ids = schema.present(df, ["user_id"])
    df = df.withColumns({
        **{c: clean.to_long(df, c) for c in ids},
        **{c: clean.to_int(df, c) for c in counts},
        "silver_processed_at": ctx.stamp(),
    })
    if ids:
        df = dedup.mark_later_copies(df, ids, _unique_order(df, order_by), stage)
    rule_set = [
        *rules.column_exists(df, "user_id"),
        *[rules.not_null(c, f"missing_{c}") for c in ids],
        *[rule for c in counts for rule in (rules.non_negative(c), rules.upper_limit(c, USER_COUNT_LIMIT))],
        *[rules.Rule(f"duplicate_{c}", F.col(dedup.DUPLICATE)) for c in ids],
    ]
    judged = stage(rules.annotate(df, rule_set), "users")
    valid, rejected = _split(judged, rule_set)
    return Silver(_with_text(outliers.flag_and_cap(valid, counts, counts, accuracy=accuracy)),
                  _with_text(rejected))


def silver_bridge(df: DataFrame, value: str, stage: Stage = write_stage,
                  accuracy: int | None = None) -> Silver:
    """Item-to-value pairs: normalized, judged, then distinct."""
    pairs = df.select(clean.to_long(df, "app_id").alias("app_id"),
                      clean.normalize_value(F.col(value)).alias(value))
    rule_set = [
        rules.not_null("app_id", "missing_app_id"),
        rules.all_empty([value], f"missing_{value}"),
    ]
    valid, rejected = _split(rules.annotate(pairs, rule_set), rule_set)
    # A valid row has no issue, so the pair alone identifies it. The distinct pairs
    # are staged: finding them is the costly step, judging is one projection.
    valid = stage(valid.select("app_id", value).distinct(), f"bridge-{value}").withColumns({
        "value_length": F.length(value),
        rules.ISSUES: F.array().cast("array<string>"),
    })
    return Silver(_with_text(outliers.flag_and_cap(valid, ["value_length"], accuracy=accuracy)),
                  _with_text(rejected))


def silver_game_text(df: DataFrame, ctx: RunContext, stage: Stage = write_stage,
                     order_by: list[str] | None = None, accuracy: int | None = None) -> Silver:
    """Long texts without their markup, with lengths, one row per item."""
    order = _unique_order(df, order_by)
    texts = schema.present(df, TEXT_COLUMNS)
    df = df.select(
        clean.to_long(df, "app_id").alias("app_id"), *texts,
        *[clean.clean_html(F.col(c)).alias(f"{c}_clean") for c in texts], *order)
    lengths = [f"{c}_len" for c in texts]
    df = df.withColumns({f"{c}_len": F.length(f"{c}_clean") for c in texts} | {"silver_processed_at": ctx.stamp()})
    df = dedup.mark_later_copies(df, ["app_id"], order, stage)
    rule_set = [
        rules.not_null("app_id", "missing_app_id"),
        rules.all_empty([f"{c}_clean" for c in texts], "all_text_fields_empty"),
        *[rules.upper_limit(c, TEXT_LENGTH_LIMIT) for c in lengths],
        rules.Rule("duplicate_app_id", F.col(dedup.DUPLICATE)),
    ]
    judged = stage(rules.annotate(df, rule_set), "game-text")
    valid, rejected = _split(judged, rule_set)
    return Silver(_with_text(outliers.flag_and_cap(valid, lengths, accuracy=accuracy)), _with_text(rejected))
