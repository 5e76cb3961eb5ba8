"""What holds whatever the partitioning and the input."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltstone.checks import gold_checks, silver_checks
from siltstone.checks.registry import Tables
from siltstone.operators import outliers, quantiles
from siltstone.plans import gold, recommend
from tools.check_oracle import rows

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture
def tables(spark):
    return Tables(spark, str(TABLES))


@pytest.mark.parametrize("name", ["reviews", "users", "game_text"])
def test_no_row_is_lost(tables, name):
    made = silver_checks.BUILD[name](tables)
    bronze = tables.fixture(silver_checks.SETS[name][0])
    assert made.valid.count() + made.rejected.count() == bronze.count()
    assert made.valid.select("src_key").intersect(made.rejected.select("src_key")).count() == 0


def test_keys_of_valid_rows_are_unique(tables):
    for name, keys in {"reviews": ["review_id"], "users": ["user_id"], "game_text": ["app_id"],
                       "games": ["app_id"], "game_tags": ["app_id", "tag"]}.items():
        valid = silver_checks.BUILD[name](tables).valid
        assert valid.count() == valid.select(*keys).distinct().count()


def test_capped_values_stay_below_the_threshold(tables):
    column = "l_extendedprice"
    capped = outliers.flag_and_cap(tables.lineitem, [column], [column], quantile=0.9)
    limit = quantiles.exact_quantiles(tables.lineitem, [column], [0.9]).first().value
    assert capped.agg(F.max(f"{column}_capped")).first()[0] == limit
    above = tables.lineitem.filter(F.col(column) > limit).count()
    assert capped.filter("is_outlier").count() == above > 0


def test_result_does_not_depend_on_partitioning(spark, tables):
    """One shuffle partition and input in reverse order against many."""
    def run(frame):
        interactions = frame(gold_checks.interactions(tables))
        bridge = frame(tables.fixture("item_tags"))
        users = silver_checks.silver.silver_users(
            frame(tables.fixture("dirty_customer")), tables.ctx, lambda df, name: df, order_by=["src_key"])
        features = gold.user_features(interactions, bridge)
        best = recommend.recommended(interactions, bridge, 3).drop("looked")
        kept = users.valid.drop("silver_processed_at")
        return [rows(df.columns, df.collect()) for df in (kept, features, best)]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = run(lambda df: df.coalesce(1).orderBy(*[F.desc(c) for c in df.columns]))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        many = run(lambda df: df.repartition(7))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many


def test_whole_hash_split_keeps_pairs_together(tables):
    halves = gold.with_split(gold_checks.interactions(tables))
    assert halves.groupBy("user_id", "app_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    share = halves.filter("split = 'test'").count() / halves.count()
    assert 0.1 < share < 0.3


def test_every_interaction_meets_a_vector(tables):
    vectors = tables.fixture("item_vectors")
    inter = tables.fixture("interactions")
    assert vectors.count() == vectors.select("app_id").distinct().count()
    assert inter.join(vectors, "app_id").count() == inter.count()
    best = gold_checks.embed_neighbours(tables)
    met = inter.groupBy("user_id").agg(F.least(F.count_distinct("app_id"), F.lit(3)).alias("n"))
    assert best.count() == met.agg(F.sum("n")).first()[0]
