"""The batch jobs, from files to files.

    spark-submit run.py silver-reviews --root /data --batch-date 2024-01-01
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.functions import clean
from siltstone.operators import assemble, schema
from siltstone.operators.outliers import FLAG
from siltstone.plans import gold, quality, recommend, silver, vectors
from siltstone.reports import columns, histograms, issues, outliers, overview, profile
from siltstone.sources import ingest, readers, sinks
from siltstone.sources.layout import Layout, read_batch, read_batch_if_any, read_table_to
from siltstone.sources.staging import staged_tables


@dataclass(frozen=True)
class Job:
    """What every job needs: the session, where tables are, and the run."""

    spark: SparkSession
    layout: Layout
    ctx: RunContext

    def read(self, path: str, row_id: bool = False) -> DataFrame:
        return read_batch(self.spark, path, self.ctx.batch_date, row_id)

    def read_if_any(self, path: str, row_id: bool = False) -> DataFrame | None:
        found = read_batch_if_any(self.spark, path, self.ctx.batch_date)
        return self.read(path, row_id) if found is not None and row_id else found

    def write(self, df: DataFrame, path: str, rebalance: bool = False) -> None:
        sinks.write_batch(df, path, self.ctx.batch_date, rebalance=rebalance)

    def write_report(self, df: DataFrame, path: str, *order: str | Column) -> None:
        """A report has few rows: one file, sorted in the task that writes it."""
        sinks.write_batch(df, path, self.ctx.batch_date, num_partitions=1, order=order)

    def write_silver(self, name: str, made: silver.Silver) -> None:
        """Both sides; the writes count their rows for the overview."""
        batch, metrics = self.ctx.batch_date, self.layout.metrics
        flagged = F.col(FLAG) if FLAG in made.valid.columns else None
        sinks.write_measured(made.valid, self.layout.silver(name), batch, metrics, f"silver/{name}", flagged)
        sinks.write_measured(made.rejected, self.layout.rejected(name), batch, metrics, f"rejected/{name}", rebalance=True)

    def layers(self, name: str) -> overview.Layers:
        return overview.Layers(
            self.read_if_any(self.layout.bronze(quality.BRONZE_OF[name])),
            self.read_if_any(self.layout.silver(name)), self.read_if_any(self.layout.rejected(name)))


def bronze_ingest(job: Job) -> None:
    ingest.ingest(job.spark, job.layout, job.ctx)


def bronze_profile(job: Job) -> None:
    """Profile the raw sources that can be found, under their normal names: this batch, and all batches up to it.

    The latter is made of the summaries that each batch leaves; no earlier data are read.
    """
    tables = {}
    for source in job.layout.sources:
        raw = readers.if_any(lambda: ingest.read_source(
            job.spark, source, job.layout.raw(source, job.ctx.batch_date)))
        if raw is not None:
            tagged = ingest.with_ingest_metadata(
                raw, job.ctx, source.name, file_column=None, batch_column=None, time_column="ingestion_ts")
            tables[f"bronze_{source.name}"] = schema.normalize_names(tagged)
    job.write(profile.summarize(tables), job.layout.gold("data_summaries"))
    for name, rows in {"data_quality": job.read(job.layout.gold("data_summaries")),
                       "data_quality_to_date": read_table_to(job.spark, job.layout.gold("data_summaries"), job.ctx.batch_date)}.items():
        report = profile.profile_of(rows).withColumn("profile_ts", job.ctx.stamp())
        job.write_report(report, job.layout.gold(name), "table_name", "column_name")
    frames = [
        profile.profile_distribution(tables[name], name, found)
        for name, wanted in quality.DISTRIBUTION_COLUMNS.items() if name in tables
        for found in [schema.present(tables[name], wanted)] if found
    ]
    if frames:
        job.write(schema.union_all(frames), job.layout.gold("data_distribution"))


def silver_reviews(job: Job) -> None:
    reviews = job.read(job.layout.bronze("all_reviews"))
    with staged_tables(job.spark) as stage:
        job.write_silver("reviews", silver.silver_reviews(reviews, job.ctx, stage))


def silver_games(job: Job) -> None:
    names = {"base": "rec_games", "store_games": "insight_games", "metadata": "rec_games_meta",
             "promotional": "insight_promotional", "usage": "insight_usage", "reviews": "insight_reviews",
             "interactions": "rec_recommendations"}
    sources = {role: job.read_if_any(job.layout.bronze(name), row_id=True) for role, name in names.items()}
    if sources["base"] is None:
        raise ValueError("no base table of games in this batch")
    with staged_tables(job.spark) as stage:
        job.write_silver("games", silver.silver_games(sources, job.ctx, stage))


def silver_users(job: Job) -> None:
    users = job.read(job.layout.bronze("rec_users"), row_id=True)
    with staged_tables(job.spark) as stage:
        job.write_silver("users", silver.silver_users(users, job.ctx, stage))


def silver_bridges(job: Job) -> None:
    for value, name in {"tag": "game_tags", "category": "game_categories", "genre": "game_genres"}.items():
        pairs = job.read(job.layout.bronze(quality.BRONZE_OF[name]))
        with staged_tables(job.spark) as stage:
            job.write_silver(name, silver.silver_bridge(pairs, value, stage))


def silver_game_text(job: Job) -> None:
    texts = job.read(job.layout.bronze("insight_descriptions"), row_id=True)
    with staged_tables(job.spark) as stage:
        job.write_silver("game_text", silver.silver_game_text(texts, job.ctx, stage))


def quality_issues(job: Job) -> None:
    datasets = {n: (layers.bronze, layers.rejected) for n in quality.REPORTED for layers in [job.layers(n)]}
    job.write_report(issues.issue_report(job.spark, job.ctx, datasets), job.layout.quality("issues"),
                     "table_name", F.desc("issue_count"), "issue_name")


def quality_columns(job: Job) -> None:
    datasets = {n: (layers.bronze, layers.silver) for n in quality.REPORTED for layers in [job.layers(n)]}
    report = columns.column_report(job.spark, job.ctx, datasets, quality.profile_columns(job.ctx.store),
                                   on_missing="error", known=quality.known_columns(job.ctx.store))
    job.write_report(report, job.layout.quality("columns"), "table_name", "column_name")


def quality_outliers(job: Job) -> None:
    tables = {n: job.layers(n).silver for n in quality.REPORTED}
    report = outliers.outlier_report(job.spark, job.ctx, tables, quality.OUTLIER_COLUMNS,
                                     on_missing="error", known=quality.known_columns(job.ctx.store))
    job.write_report(report, job.layout.quality("outliers"), "table_name", "column_name")


def quality_histograms(job: Job) -> None:
    tables = {n: job.layers(n).silver for n in quality.REPORTED}
    report = histograms.histogram_report(job.spark, job.ctx, tables, quality.HISTOGRAMS,
                                         on_missing="error", known=quality.known_columns(job.ctx.store))
    job.write_report(report, job.layout.quality("histograms"), "table_name", "column_name", "bucket_start")


def quality_overview(job: Job) -> None:
    """From what the writes have counted: no table is read."""
    written = sinks.written_counts(job.spark, job.layout.metrics, job.ctx.batch_date)
    counts = overview.written_layers(written, quality.BRONZE_OF)
    report = overview.overview_of(job.spark, job.ctx, list(quality.BRONZE_OF), counts)
    job.write_report(report, job.layout.quality("overview"), "table_name")


def gold_reviews_bi(job: Job) -> None:
    job.write(gold.reviews_bi(job.read(job.layout.silver("reviews")), job.ctx), job.layout.gold("reviews_bi"))


def _interactions(job: Job) -> DataFrame:
    """Valid reviews as user-item interactions."""
    reviews = job.read(job.layout.silver("reviews"))
    return reviews.select(
        "user_id", "app_id", *schema.present(reviews, ["is_recommended", "hours", "helpful", "funny"]),
        F.col("review_text_length").alias("review_length"),
        F.date_format("timestamp_created", "yyyy-MM").alias("month"))


def gold_tables(job: Job) -> None:
    """KPIs, trends, platforms, features and training interactions."""
    facts, tags = _interactions(job), job.read(job.layout.silver("game_tags"))
    games, texts = (job.read(job.layout.silver(n)) for n in ("games", "game_text"))
    users = job.read(job.layout.silver("users"))
    items = games.select("app_id", *schema.present(games, [
        "game_name", "genres", "categories", "release_date_final", "positive_ratio"]),
        F.col("is_free_clean").alias("is_free"), F.col("price_final").alias("price"),
        *[clean.to_boolean(F.col(c)).alias(c) for c in ("win", "mac", "linux")])
    described = assemble.master_table(items, [schema.select_present(texts, ["app_id", "about_clean"])])
    features = gold.interaction_features(facts)
    with staged_tables(job.spark) as stage:
        made = {
            "game_kpis": gold.item_kpis(facts),
            "user_kpis": gold.user_kpis(facts),
            "tag_trends": gold.tag_trends(facts, tags),
            "genre_trends": gold.tag_trends(facts, job.read(job.layout.silver("game_genres")), value="genre"),
            "category_trends": gold.tag_trends(
                facts, job.read(job.layout.silver("game_categories")), value="category"),
            "platform_summary": gold.platform_summary(items),
            "game_features": gold.item_features(described, facts, tags),
            "user_features": gold.user_features(facts, tags, users, stage),
            "training_interactions": gold.with_split(features),
            "game_similarity": recommend.content_similarity(tags, stage=stage),
            "game_tag_sets": recommend.tag_sets(tags),
            "game_set_of_item": recommend.item_sets(tags),
        }
        for name, df in made.items():
            job.write(df, job.layout.gold(name))


def gold_recommendations(job: Job, n: int = 10) -> None:
    """Blended scores of each user's best items, the first ``n`` of them, and their evaluation on the held-out pairs."""
    pairs = job.read(job.layout.gold("training_interactions"))
    tags = job.read(job.layout.silver("game_tags"))
    train, held_out = (pairs.filter(F.col("split") == s) for s in ("train", "test"))
    with staged_tables(job.spark) as stage:
        scores = recommend.recommended(train, tags, 5 * n, recommend.als_factors, stage=stage)
        job.write(scores.drop("looked"), job.layout.gold("predictions"))
    best = job.read(job.layout.gold("predictions")).filter(F.col("place") <= n)
    job.write(best.select("user_id", "app_id", "final_score", "place"), job.layout.gold("recommendations"))
    scores = recommend.evaluate(job.read(job.layout.gold("recommendations")), held_out, n)
    job.write_report(scores, job.layout.gold("recommendation_evaluation"))


def gold_embeddings(job: Job, k: int = 10) -> None:
    """User profiles, the nearest items of each item, and of each user those not met; nothing without item vectors.

    The vectors, (app_id, embedding), are made elsewhere and loaded as the bronze table ``item_embeddings``.
    """
    items = job.read_if_any(job.layout.bronze("item_embeddings"))
    if items is None:
        return
    train = job.read(job.layout.gold("training_interactions"))
    pool = items.select(F.col("app_id").alias("id"), F.col("embedding").alias("vector"))
    index = vectors.fitted(pool, k)
    with staged_tables(job.spark) as stage:
        profiles = recommend.user_profiles(train, items.select("app_id", "embedding"), stage)
        job.write(profiles, job.layout.gold("user_embedding_profiles"))
    profiles = job.read(job.layout.gold("user_embedding_profiles"))
    asked = {"item_neighbours": pool.withColumn("seen", F.array("id")), "user_neighbours": recommend.profile_queries(profiles, train)}
    names = {"item_neighbours": ("app_id", "similar_id"), "user_neighbours": ("user_id", "app_id")}
    with staged_tables(job.spark) as stage:
        for name, queries in asked.items():
            of, near = names[name]
            found = vectors.nearest(pool, queries, index, k, stage).withColumnsRenamed({"query": of, "id": near})
            job.write(found, job.layout.gold(name))


def _published(job: Job) -> dict[str, str]:
    tables = {"silver_reviews_bi": job.layout.gold("reviews_bi")}
    names = list(quality.BRONZE_OF)
    tables |= {f"silver_{n}": job.layout.silver(n) for n in names if n != "reviews"}
    tables |= {f"silver_quality_{n}": job.layout.quality(n)
               for n in ("issues", "columns", "outliers", "histograms", "overview")}
    return tables | {f"rejected_{n}": job.layout.rejected(n) for n in names}


def publish(job: Job) -> None:
    """Replace the published tables by this batch, then count their rows."""
    paths = _published(job)
    sinks.publish_tables({name: job.read(path) for name, path in paths.items()}, path=job.layout.gold("published"))
    counts = sinks.row_counts(sinks.published(job.spark, paths, path=job.layout.gold("published")))
    job.write_report(counts, job.layout.gold("published_row_counts"))


# In the order in which a batch runs them.
JOBS: dict[str, Callable[[Job], None]] = {
    "bronze-ingest": bronze_ingest,
    "bronze-profile": bronze_profile,
    "silver-reviews": silver_reviews,
    "silver-games": silver_games,
    "silver-users": silver_users,
    "silver-bridges": silver_bridges,
    "silver-game-text": silver_game_text,
    "quality-issues": quality_issues,
    "quality-columns": quality_columns,
    "quality-outliers": quality_outliers,
    "quality-histograms": quality_histograms,
    "quality-overview": quality_overview,
    "gold-reviews-bi": gold_reviews_bi,
    "gold-tables": gold_tables,
    "gold-recommendations": gold_recommendations,
    "gold-embeddings": gold_embeddings,
    "publish": publish,
}


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one job of a batch, or all of them in order.")
    parser.add_argument("job", choices=[*JOBS, "all"])
    parser.add_argument("--root", required=True, help="folder or bucket of the layers")
    parser.add_argument("--batch-date", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, help="today, for the rule on future dates")
    parser.add_argument("--store", required=True, help="prefix of the store's own columns")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"siltstone-{args.job}").getOrCreate()
    try:
        job = Job(spark, Layout(args.root.rstrip("/")),
                  RunContext(args.batch_date, as_of=args.as_of, store=args.store))
        for name in JOBS if args.job == "all" else [args.job]:
            JOBS[name](job)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
