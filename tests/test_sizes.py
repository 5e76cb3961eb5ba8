"""Plans whose sizes must not grow with the wrong thing."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import pytest

from siltstone.checks import gold_checks
from siltstone.checks.registry import QUERIES, Tables
from siltstone.plans import gold

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def nothing_is_small(spark):
    """As with large tables: a join is broadcast only where the code says so."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def test_quantile_sketch_does_not_sort_the_table(spark):
    """The ranks of a few sketched values are counted without dealing all rows of a column to one task."""
    with nothing_is_small(spark):
        text = plan(QUERIES["quantile_sketch"](spark, str(TABLES)))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_distinct_counts_do_not_copy_rows(spark):
    """No row is expanded for each counted column, with a sketch for each of its values."""
    assert "Expand" not in plan(QUERIES["agg_distinct_approx"](spark, str(TABLES)))


def test_tag_profile_deals_by_rows(spark, no_stage, monkeypatch):
    """The tags of a user's items are added up where the user's rows are, in tasks of bounded size."""
    monkeypatch.setattr(gold, "PROFILE_ROWS", 100)
    t = Tables(spark, str(TABLES))
    inter = gold_checks.interactions(t)
    made = gold.tag_profile(inter, t.fixture("item_tags"), no_stage)
    tasks = -(-inter.select("user_id", "app_id").distinct().count() // 100)
    text = plan(made)
    assert "hashpartitioning(user_id" in text and f", {tasks}), REPARTITION_BY_NUM" in text
    assert text.index("Generate") < text.index("REPARTITION_BY_NUM") and "Exchange" not in text[:text.index("Generate")]
