"""A whole batch from raw files to published tables, run twice."""

from __future__ import annotations

import csv
import gzip
import json
from pathlib import Path

import pytest

from siltstone.plans import quality
from siltstone.plans.jobs import JOBS, Job
from siltstone.reports.histograms import Bins
from siltstone.sources.layout import Layout


def write_csv(path: Path, header: list[str], rows: list[list], packed: bool = False) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    opener = gzip.open if packed else open
    with opener(path, "wt", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([header, *rows])


def raw_batch(root: Path, batch: str, users: int = 12) -> None:
    raw = root / "raw"
    reviews = []
    for user in range(users):
        for item in range(6):
            if (user + item) % 3 == 0:
                continue
            number = user * 100 + item
            text = f'multi\nline "{item}", {user}' if item % 2 else "  fine "
            reviews.append([number, item, user, 10 * item + user, item, 0, text, "True" if item % 2 else "0",
                            0.5, 1700000000 + number, 1700000100 + number])
    reviews.append(["", 1, 1, 1, 1, 1, "no id", "1", 0.1, 1700000000, 1700000000])
    reviews.append([reviews[0][0], 1, 1, -4, 1, 1, "", "1", 7, 1700000000, 1700000000])
    write_csv(raw / f"all_reviews/batch_date={batch}/a.csv.gz",
              ["recommendationid", "appid", "author_storeid", "author_playtime_at_review", "votes_up", "votes_funny",
               "review", "voted_up", "weighted_vote_score", "timestamp_created", "timestamp_updated"], reviews, True)
    rec = raw / f"recommendations/batch_date={batch}"
    write_csv(rec / "games.csv", ["app_id", "title", "date_release", "win", "mac", "linux", "rating",
                                  "positive_ratio", "user_reviews", "price_final", "price_original", "discount"],
              [[i, f"Game {i}", "2020-01-0" + str(i + 1), "true", "false", "true", "Good", 90 + 5 * (i == 5),
                i * 10, 9.99, 19.99, 50] for i in range(6)]
              + [[5, "Game 5", "2020-01-06", "true", "false", "true", "Good", 95, 50, 9.99, 19.99, 50],
                 [6, "N/A", "2020-01-06", "true", "false", "true", "Bad", 190, 50, -1, 19.99, 50],
                 ["", "No id", "2020-01-06", "true", "false", "true", "Bad", 19, 50, 1, 1.99, 50]])
    write_csv(rec / "users.csv", ["user_id", "products", "reviews"],
              [[u, 10 * u, u] for u in range(users)] + [[0, 1, 1], ["", 5, 5], [77, -1, 20_000_000]])
    write_csv(rec / "recommendations.csv", ["app_id", "helpful", "funny", "date", "is_recommended", "hours", "user_id",
                                            "review_id"],
              [[i % 6, i, 0, "2020-01-01", "true" if i % 2 else "false", 1.5 * i, i, i] for i in range(20)])
    (rec / "games_metadata.json").write_text(json.dumps(
        [{"app_id": i, "description": f"About {i}", "tags": ["a", "b"]} for i in range(6)]))
    insight = raw / f"insights/batch_date={batch}"
    write_csv(insight / "games/p.csv", ["app_id", "name", "release_date", "is_free", "type"],
              [[i, f"Store {i}", "2019-05-05", i % 2, "game"] for i in range(6)])
    for kind, column in {"genres": "genre", "tags": "tag", "categories": "category"}.items():
        write_csv(insight / f"{kind}/p.csv", ["app_id", column],
                  [[i, v] for i in range(6) for v in (f" {kind} {i % 2}", "Common  One", "")] + [["", "orphan"]])
    html = [[i, f"<p>Short {i}</p>", f"<div>Long\n {i}</div>", "<br>" if i else ""] for i in range(6)]
    write_csv(insight / "descriptions/p.csv", ["app_id", "summary", "extensive", "about"],
              html + [[0, "<p>again</p>", "", ""], [9, "<p></p>", "", " "]])
    write_csv(insight / "promotional/p.csv", ["app_id", "summary", "extensive", "about"], html)
    write_csv(insight / "reviews/p.csv", ["appid", "votes_up", "votes_funny", "voted_up", "game"],
              [[i % 6, i, 1, "1" if i % 2 else "no", f"Game {i % 6}"] for i in range(30)])
    write_csv(insight / "usage/p.csv", ["app_id", "developer", "owners", "average_forever", "ccu"],
              [[i, "Dev", "0 .. 20,000", 5, i] for i in range(6)])


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    from datetime import date, datetime, timezone

    from siltstone.context import RunContext

    root = tmp_path_factory.mktemp("lake")
    raw_batch(root, "2024-01-01")
    job = Job(spark, Layout(str(root)), RunContext(
        "2024-01-01", datetime(2024, 1, 1, tzinfo=timezone.utc), date(2024, 1, 1)))
    items = [(i, [float(i % 2), 1.0, 0.1 * i]) for i in range(6)]
    spark.createDataFrame(items, "app_id bigint, embedding array<float>").write.parquet(
        job.layout.bronze("item_embeddings") + "/batch_date=2024-01-01")
    for run in JOBS.values():
        run(job)
    return job


def test_reviews_split(batch):
    valid, rejected = (batch.read(p("reviews")) for p in (batch.layout.silver, batch.layout.rejected))
    issues = {r.review_id: r.quality_issue for r in rejected.collect()}
    assert issues[None] == "missing_review_id"
    assert rejected.filter("quality_issue LIKE '%duplicate_review_id%'").count() == 2
    bronze = batch.read(batch.layout.bronze("all_reviews"))
    assert valid.count() + rejected.count() == bronze.count()
    assert valid.filter("review_text LIKE 'multi%'").count() > 0
    assert valid.filter("timestamp_created IS NULL OR is_recommended IS NULL").count() == 0


def test_games(batch):
    valid = batch.read(batch.layout.silver("games"))
    rows = {r.app_id: r for r in valid.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 5]
    assert rows[1].is_free_clean is True and rows[2].is_free_clean is False
    assert rows[3].review_count_all_reviews == 5 and rows[3].tags == ["a", "b"]
    assert rows[0].recommendation_event_count == 4
    assert str(rows[0].release_date_final) == "2020-01-01" and rows[0].store_name == "Store 0"
    bad = batch.read(batch.layout.rejected("games")).collect()
    assert [r.quality_issue for r in bad] == ["missing_game_name|negative_price_final|invalid_positive_ratio"]


def test_users_and_text_keep_first(batch):
    rejected = {r.quality_issue for r in batch.read(batch.layout.rejected("users")).collect()}
    assert rejected == {"missing_user_id", "duplicate_user_id", "negative_products|hard_limit_exceeded_reviews"}
    text = {r.app_id: r for r in batch.read(batch.layout.silver("game_text")).collect()}
    assert text[0].summary_clean == "Short 0" and text[1].extensive_clean == "Long 1"
    rejected = {r.quality_issue for r in batch.read(batch.layout.rejected("game_text")).collect()}
    assert rejected == {"duplicate_app_id", "all_text_fields_empty"}


def test_bridges(batch):
    tags = {(r.app_id, r.tag) for r in batch.read(batch.layout.silver("game_tags")).collect()}
    assert (0, "common one") in tags and (1, "tags 1") in tags and len(tags) == 12


def batch_overview(batch) -> dict:
    from siltstone.reports import overview

    frames = {n: batch.layers(n) for n in quality.BRONZE_OF}
    return {r.table_name: r for r in overview.overview(batch.spark, batch.ctx, frames).collect()}


def test_reports(batch):
    overview = {r.table_name: r for r in batch.read(batch.layout.quality("overview")).collect()}
    assert set(overview) == set(quality.BRONZE_OF)
    assert overview["users"].row_delta == 0 and overview["games"].row_delta == 2
    counted = batch_overview(batch)  # by reading the tables
    assert {n: r.asDict() for n, r in overview.items()} == {n: r.asDict() for n, r in counted.items()}
    issues = batch.read(batch.layout.quality("issues"))
    assert issues.filter("table_name = 'games'").count() == 3
    assert batch.read(batch.layout.quality("columns")).filter("column_name = 'helpful'").first().silver_null_count == 0
    assert batch.read(batch.layout.quality("histograms")).filter("table_name = 'users'").count() > 0
    assert batch.read(batch.layout.quality("outliers")).filter("table_name = 'users'").count() == 2
    profile = batch.read(batch.layout.gold("data_quality"))
    assert profile.select("table_name").distinct().count() == 13
    assert profile.filter("table_name = 'bronze_rec_users' AND column_name = 'user_id'").first().distinct_count == 13
    spread = batch.read(batch.layout.gold("data_distribution")).filter("column_name = 'rating' AND value_rank = 1")
    assert spread.first().value == "Good" and spread.first().distinct_count == 2


@pytest.mark.parametrize(("job", "lists", "wrong"), [
    ("quality-columns", "PROFILE_COLUMNS", ["product"]), ("quality-outliers", "OUTLIER_COLUMNS", ["product"]),
    ("quality-histograms", "HISTOGRAMS", [Bins("product", 10)])])
def test_misspelt_columns_are_errors(batch, monkeypatch, job, lists, wrong):
    monkeypatch.setitem(getattr(quality, lists), "users", wrong)
    with pytest.raises(ValueError, match="product"):
        JOBS[job](batch)


def test_gold(batch):
    bi = batch.read(batch.layout.gold("reviews_bi"))
    assert dict(bi.dtypes)["review_id"] == "string" and "timestamp_created" not in bi.columns
    kpis = {r.app_id: r for r in batch.read(batch.layout.gold("game_kpis")).collect()}
    assert kpis[1].recommend_rate == 1.0
    users = {r.user_id: r for r in batch.read(batch.layout.gold("user_features")).collect()}
    assert users[3].owned_items == 30 and users[3].favourite_tag is not None
    items = {r.app_id: r for r in batch.read(batch.layout.gold("game_features")).collect()}
    assert items[0].tags == ["common one", "tags 0"] and 0 < items[1].popularity <= 1
    assert batch.read(batch.layout.gold("genre_trends")).filter("genre_rank = 1").count() == 1
    evaluation = batch.read(batch.layout.gold("recommendation_evaluation")).first()
    assert evaluation.users > 0
    best = batch.read(batch.layout.gold("recommendations"))
    train = batch.read(batch.layout.gold("training_interactions")).filter("split = 'train'")
    assert best.join(train, ["user_id", "app_id"], "left_semi").count() == 0


def test_embeddings(batch):
    train = batch.read(batch.layout.gold("training_interactions"))
    near = batch.read(batch.layout.gold("item_neighbours"))
    assert near.count() == 6 * 5 and near.filter("app_id = similar_id").count() == 0
    assert {(r.app_id, r.similar_id) for r in near.filter("place = 1").collect()} >= {(0, 2), (1, 3), (5, 3)}
    unseen = batch.read(batch.layout.gold("user_neighbours"))
    assert unseen.count() > 0 and unseen.join(train, ["user_id", "app_id"], "left_semi").count() == 0


def test_published_counts(batch):
    counts = {r.table_name: r.row_count for r in batch.read(batch.layout.gold("published_row_counts")).collect()}
    assert len(counts) == 19
    assert counts["silver_users"] == batch.read(batch.layout.silver("users")).count()


def test_second_batch_keeps_the_first(batch):
    from dataclasses import replace

    before = batch.read(batch.layout.silver("users")).count()
    raw_batch(Path(batch.layout.root), "2024-01-02", users=3)
    later = replace(batch, ctx=replace(batch.ctx, batch_date="2024-01-02"))
    for name in ("bronze-ingest", "bronze-profile", "silver-users"):
        JOBS[name](later)
        JOBS[name](later)
    ids = "table_name = 'bronze_rec_users' AND column_name = 'user_id'"
    first, second, both = (table.read(table.layout.gold(name)).filter(ids).first() for table, name in (
        (batch, "data_quality"), (later, "data_quality"), (later, "data_quality_to_date")))
    assert both.row_count == first.row_count + second.row_count
    assert (first.distinct_count, second.distinct_count, both.distinct_count) == (13, 4, 13)
    assert batch.read(batch.layout.silver("users")).count() == before
    assert later.read(later.layout.silver("users")).count() == 3
