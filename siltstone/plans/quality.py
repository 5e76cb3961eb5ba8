"""Which columns the quality reports look at.

Lists name a column by its raw and by its silver name where the two differ, so a
rename between the layers does not drop it from a report. Names that a table does
not have are passed over if they are known: exports differ. Any other name is an error.
"""

from __future__ import annotations

from siltstone.plans import silver
from siltstone.reports.histograms import Bins

# Columns compared between bronze and silver.
PROFILE_COLUMNS = {
    "reviews": [
        "review_id", "app_id", "author_{store}id", "user_id", "review", "review_text", "voted_up",
        "is_recommended", "weighted_vote_score", "timestamp_created", "timestamp_updated",
        "author_num_games_owned", "author_num_reviews", "author_playtime_forever", "votes_up", "helpful",
        "votes_funny", "funny", "comment_count", "review_text_length", "quality_issue", "is_outlier",
    ],
    "games": [
        "app_id", "name", "game_name", "price_final", "price_original", "discount_percent", "discount",
        "required_age", "is_free", "is_free_clean", "metacritic_score", "recommendation_count",
        "recommendation_event_count", "quality_issue", "is_outlier",
    ],
    "users": ["user_id", "products", "reviews", "quality_issue", "is_outlier"],
}


def profile_columns(store: str) -> dict[str, list[str]]:
    """``PROFILE_COLUMNS`` with the store's own column names."""
    return {table: [c.format(store=store) for c in names] for table, names in PROFILE_COLUMNS.items()}


# Names in the lists that older exports have and the silver tables don't carry on.
RETIRED = {"games": ["name", "discount_percent", "required_age", "is_free", "metacritic_score", "recommendation_count"]}
JUDGED = ["quality_issue", "is_outlier"]


def known_columns(store: str) -> dict[str, list[str]]:
    """All columns that a table may have in some layer; a name in none of them is misspelt."""
    renamed = silver.review_names(store)
    return {
        "reviews": [*renamed, *renamed.values(), *silver.REVIEW_COUNTS, *silver.REVIEW_DOUBLES, *silver.REVIEW_TIMES,
                    *silver.review_booleans(store), "review_text_length", *JUDGED],
        "games": [*(c.format(store=store) for c in silver.GAME_COLUMNS), *RETIRED["games"], *JUDGED],
        "users": ["user_id", "products", "reviews", *JUDGED],
    }


# Columns of the interquartile-range report.
OUTLIER_COLUMNS = {
    "reviews": [
        "author_num_games_owned", "author_num_reviews", "author_playtime_forever",
        "author_playtime_last_two_weeks", "hours", "helpful", "funny", "comment_count", "review_text_length",
    ],
    "games": [
        "price_final", "price_original", "discount_percent", "discount", "required_age", "metacritic_score",
        "recommendation_count", "recommendation_event_count",
    ],
    "users": ["products", "reviews"],
}

# Bucket sizes and upper limits of the histograms.
HISTOGRAMS = {
    "reviews": [
        Bins("author_num_games_owned", 10, 500), Bins("author_num_reviews", 5, 200),
        Bins("author_playtime_forever", 1000, 50000), Bins("author_playtime_last_two_weeks", 200, 10000),
        Bins("author_playtime_at_review", 500, 30000), Bins("hours", 500, 30000),
        Bins("votes_up", 10, 500), Bins("helpful", 10, 500), Bins("votes_funny", 5, 200), Bins("funny", 5, 200),
        Bins("comment_count", 5, 200), Bins("review_text_length", 50, 3000), Bins("weighted_vote_score", 0.05, 1.0),
    ],
    "games": [
        Bins("price_final", 5, 200), Bins("price_original", 5, 200), Bins("discount_percent", 5, 100),
        Bins("discount", 5, 100), Bins("metacritic_score", 5, 100), Bins("recommendation_count", 1000, 50000),
        Bins("recommendation_event_count", 1000, 50000), Bins("required_age", 2, 30),
    ],
    "users": [Bins("products", 10, 500), Bins("reviews", 5, 200)],
}

# Fixed by this engine: raw columns whose values are counted.
DISTRIBUTION_COLUMNS = {
    "bronze_all_reviews": ["voted_up", "language"],
    "bronze_rec_games": ["win", "mac", "linux", "rating"],
    "bronze_rec_recommendations": ["is_recommended"],
    "bronze_insight_games": ["type", "is_free"],
    "bronze_insight_tags": ["tag"],
    "bronze_insight_genres": ["genre"],
    "bronze_insight_categories": ["category"],
}

# The bronze table that each silver table is made of.
BRONZE_OF = {
    "reviews": "all_reviews",
    "games": "rec_games",
    "users": "rec_users",
    "game_text": "insight_descriptions",
    "game_tags": "insight_tags",
    "game_categories": "insight_categories",
    "game_genres": "insight_genres",
}
REPORTED = ["reviews", "games", "users"]
