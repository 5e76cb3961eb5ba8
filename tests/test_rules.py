from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from siltstone.operators import outliers, rules
from siltstone.plans import silver


def judge(spark, rows, schema, rule_set, **kwargs):
    df = rules.annotate(spark.createDataFrame(rows, schema), rule_set, **kwargs)
    return [r[rules.ISSUES] for r in df.collect()]


def test_all_issues_in_order_and_null_does_not_fire(spark):
    rule_set = [rules.not_null("a", "missing_a"), rules.non_negative("b"), rules.upper_limit("b", 10),
                rules.in_range("c", 0.0, 1.0)]
    rows = [(None, -1, 2.0), (1, None, None), (1, 11, 1.0)]
    schema = "a int, b int, c double"
    assert judge(spark, rows, schema, rule_set) == [
        ["missing_a", "negative_b", "invalid_range_c"], [], ["hard_limit_exceeded_b"]]
    assert judge(spark, rows, schema, rule_set, mode="first") == [["missing_a"], [], ["hard_limit_exceeded_b"]]


def test_texts_times_dates(spark):
    rule_set = [rules.empty_text("t", "empty_t"), rules.all_empty(["t", "u"], "all_empty"),
                rules.time_order("s", "e", "ends_early"), rules.too_far_ahead("e", date(2024, 1, 1), 30, "far")]
    rows = [("  ", "", date(2024, 1, 2), date(2024, 1, 1)), ("", None, None, date(2024, 1, 31)),
            ("x", None, date(2024, 1, 1), date(2024, 2, 1))]
    assert judge(spark, rows, "t string, u string, s date, e date", rule_set) == [
        ["empty_t", "ends_early"], ["empty_t", "all_empty"], ["far"]]


def test_text_form_and_back(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "i array<string>")
    text = df.select(rules.as_text(F.col("i")).alias("t"))
    assert [r.t for r in text.collect()] == ["a|b", None, None]
    assert [r.o for r in text.select(rules.from_text(F.col("t")).alias("o")).collect()] == [["a", "b"], [], []]


def test_rejection_is_by_membership(spark):
    """``soft_x`` contains the hard name ``x`` as text but is another issue."""
    rule_set = [rules.Rule("x", F.col("v") == 1), rules.Rule("soft_x", F.col("v") == 2, hard=False)]
    df = rules.annotate(spark.createDataFrame([(1,), (2,), (3,)], "v int"), rule_set)
    assert [r.v for r in df.filter(rules.is_rejected(rule_set)).collect()] == [1]


def test_missing_key_column_rejects_all(spark, ctx, no_stage):
    users = spark.createDataFrame([("1", "2"), ("3", "4")], "products string, reviews string")
    made = silver.silver_users(users, ctx, no_stage, order_by=["products"])
    assert made.valid.count() == 0
    assert {r.quality_issue for r in made.rejected.collect()} == {"missing_user_id_column"}


def test_rejected_first_row_takes_its_copies_along(spark, ctx, no_stage):
    """Row 1 of a key is numbered before it is judged."""
    users = spark.createDataFrame([(1, "7", "-1"), (2, "7", "1")], "n int, user_id string, products string")
    made = silver.silver_users(users, ctx, no_stage, order_by=["n"])
    assert made.valid.count() == 0
    assert {r.n: r.quality_issue for r in made.rejected.collect()} == {1: "negative_products", 2: "duplicate_user_id"}


def test_every_copy_of_a_review_is_rejected(spark, ctx, no_stage):
    reviews = spark.createDataFrame(
        [(1, 1, 1, "a"), (1, 1, 1, "a"), (2, 1, 1, "b"), (3, None, 1, "c"), (4, 1, 1, "")],
        "recommendationid int, appid int, author_storeid int, review string")
    made = silver.silver_reviews(reviews, ctx, no_stage)
    assert sorted(r.review_id for r in made.rejected.collect()) == [1, 1, 3]
    assert {r.review_id: r.quality_issue for r in made.valid.collect()} == {2: None, 4: "empty_review_text"}


def test_outlier_columns(spark):
    df = spark.createDataFrame([(i, None) for i in range(1, 101)] + [(None, None)], "a int, b double")
    out = outliers.flag_and_cap(df, ["a", "b"], ["a", "b"], quantile=0.95)
    rows = {r.a: r for r in out.collect()}
    assert rows[96].outlier_reasons == ["p999_outlier_a"] and rows[96].is_outlier
    assert rows[95].outlier_reasons == [] and not rows[95].is_outlier
    assert rows[100].a_capped == 95.0 and rows[3].a_capped == 3.0 and rows[None].a_capped is None
    assert dict(out.dtypes)["a_capped"] == "double" and rows[3].b_capped is None
    over = outliers.flag_and_cap(df, ["a"], ["a"], quantile=0.95, keep_original=False)
    assert over.agg(F.max("a"), F.count_if("is_outlier")).first()[:] == (95.0, 5)
    none = outliers.flag_and_cap(df)
    assert none.filter("is_outlier").count() == 0
    sketch = outliers.flag_and_cap(df, ["a"], quantile=0.95, accuracy=1000)
    assert sketch.filter("is_outlier").count() == 5
