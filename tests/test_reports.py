from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import assemble
from siltstone.reports import columns, histograms, issues, outliers, overview, profile


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "a int, b double, quality_issue string, is_outlier boolean")


def types(schema: str) -> list:
    return [(f.name, f.dataType.simpleString()) for f in T._parse_datatype_string(schema)]


def test_reports_without_tables_are_empty_and_typed(spark, ctx):
    assert issues.issue_report(spark, ctx, {"t": (None, None)}).dtypes == types(issues.ISSUE_SCHEMA)
    assert columns.column_report(spark, ctx, {"t": (None, None)}, {"t": ["a"]}).dtypes == types(columns.COLUMN_SCHEMA)
    assert outliers.outlier_report(spark, ctx, {"t": None}, {"t": ["a"]}).dtypes == types(outliers.OUTLIER_SCHEMA)
    assert histograms.histogram_report(spark, ctx, {"t": None}, {"t": []}).dtypes == types(histograms.HISTOGRAM_SCHEMA)
    with pytest.raises(ValueError):
        profile.profile_tables({"t": None})


def test_overview_of_missing_layers(spark, ctx, empty):
    got = overview.overview(spark, ctx, {"gone": overview.Layers(None, None, None),
                                         "empty": overview.Layers(empty, empty, empty)})
    assert sorted(got.dtypes) == sorted(types(overview.OVERVIEW_SCHEMA))
    rows = {r.table_name: r for r in got.collect()}
    assert rows["gone"].bronze_row_count == 0 and rows["gone"].column_count_bronze == 0
    assert rows["empty"].rejected_rate == 0.0 and rows["empty"].column_count_silver == 4


def test_report_types_match_their_schema(spark, ctx):
    df = spark.createDataFrame([(1, 2.0, "x|y", True), (None, 3.0, "x", False)],
                               "a int, b double, quality_issue string, is_outlier boolean")
    report = issues.issue_report(spark, ctx, {"t": (df, df)})
    assert report.dtypes == types(issues.ISSUE_SCHEMA)
    assert [(r.issue_name, r.issue_count, r.issue_rate_on_rejected) for r in report.collect()] == [
        ("x", 2, 1.0), ("y", 1, 0.5)]
    assert columns.column_report(spark, ctx, {"t": (df, df)}, {"t": ["a"]}).dtypes == types(columns.COLUMN_SCHEMA)
    assert outliers.outlier_report(spark, ctx, {"t": df}, {"t": ["a", "b"]}).dtypes == types(outliers.OUTLIER_SCHEMA)
    spec = {"t": [histograms.Bins("a", 5)]}
    assert histograms.histogram_report(spark, ctx, {"t": df}, spec).dtypes == types(histograms.HISTOGRAM_SCHEMA)
    assert profile.profile_table(df, "t").dtypes == types(profile.PROFILE_SCHEMA)


def test_empty_table_counts_zero_not_null(empty):
    rows = {r.column_name: r for r in profile.profile_table(empty, "t").collect()}
    assert (rows["a"].row_count, rows["a"].null_count, rows["a"].null_ratio) == (0, 0, 0.0)
    assert rows["b"].min_value is None and rows["quality_issue"].data_type == "StringType()"
    text_only = profile.profile_numeric(empty.select("quality_issue"), "t")
    assert text_only.count() == 0 and text_only.dtypes == types(profile.NUMERIC_SCHEMA)


def test_all_null_column_keeps_its_row(spark, ctx):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    report = outliers.outlier_report(spark, ctx, {"t": df}, {"t": ["a", "b"]})
    row = {r.column_name: r for r in report.collect()}["a"]
    assert (row.row_count, row.non_null_count, row.outlier_count, row.outlier_rate) == (2, 0, 0, 0.0)
    assert row.q1 is None and row.created_at is not None


def test_histogram_keeps_negatives_and_drops_the_overflow(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (4.9,), (10.0,), (10.1,), (None,)], "v double")
    got = {r.bucket_start: (r.bucket_end, r.bin_count) for r in
           histograms.histogram(df, "t", [histograms.Bins("v", 5, 10)]).collect()}
    assert got == {-5.0: (0.0, 1), 0.0: (5.0, 2), 10.0: (15.0, 1)}


def test_missing_columns_are_an_error_on_request(spark, ctx, empty):
    with pytest.raises(ValueError, match="gone"):
        outliers.outlier_report(spark, ctx, {"t": empty}, {"t": ["gone"]}, on_missing="error")
    with pytest.raises(ValueError, match="gone"):
        columns.column_report(spark, ctx, {"t": (empty, empty)}, {"t": ["gone"]}, on_missing="error")


def test_column_of_one_layer_only(spark, ctx):
    old = spark.createDataFrame([(None,), (1,)], "old int")
    new = spark.createDataFrame([(2,)], "new int")
    rows = {r.column_name: r for r in columns.column_report(
        spark, ctx, {"t": (old, new)}, {"t": ["old", "new"]}).collect()}
    assert rows["old"].null_rate_improvement == 0.5 and rows["old"].silver_row_count is None
    assert rows["new"].silver_distinct_count == 1 and rows["new"].bronze_row_count is None


def test_master_table_rejects_repeated_columns(spark):
    base = spark.createDataFrame([(1, "a")], "app_id int, x string")
    with pytest.raises(ValueError, match="x"):
        assemble.master_table(base, [base])
    counts = assemble.reviews_per_item(spark.createDataFrame([(1,), (1,)], "app_id int"))
    row = assemble.master_table(base, [None, counts]).first()
    assert row.review_count_all_reviews == 2 and row.positive_review_count is None


def test_merged_profile_equals_that_of_the_union(spark):
    """Batches of different sizes, one empty; numbers far from 0 with a small spread; nulls, maps and columns without values."""
    df = spark.range(5000).select(
        (1e9 + F.col("id") % 7).alias("far"), F.when(F.col("id") % 3 > 0, F.col("id") % 1000).alias("some"),
        F.concat(F.lit("k"), F.col("id")).alias("text"), F.lit(None).cast("int").alias("none"),
        F.create_map(F.lit("a"), F.col("id") % 10).alias("map"), F.array(F.col("id") % 20).alias("list"), "id")
    parts = [df.filter("id < 10"), df.filter("id >= 10 and id < 3000"), df.filter("id >= 3000"), df.limit(0)]
    whole = {r.column_name: r for r in profile.profile_table(df.repartition(5), "t").collect()}
    summaries = [profile.summary(p, "t") for p in parts]
    joined = profile.merged(summaries[0].unionByName(summaries[1])).unionByName(profile.merged(summaries[2].unionByName(summaries[3])))
    got = {r.column_name: r for r in profile.profile_of(joined).collect()}
    plain = df.agg(F.stddev("far").alias("s"), F.avg("some").alias("m")).first()
    assert got.keys() == whole.keys() == set(df.columns)
    for name in df.columns:
        for field in ("row_count", "null_count", "null_ratio", "data_type", "min_value", "max_value"):
            assert got[name][field] == whole[name][field], (name, field)
        # Estimates depend a little on the order of merging.
        assert got[name].distinct_count == pytest.approx(whole[name].distinct_count, rel=0.02)
    assert got["far"].stddev_value == pytest.approx(plain.s, rel=1e-9) and got["some"].avg_value == pytest.approx(plain.m)
    assert [got[c].distinct_count for c in ("none", "map", "list", "far")] == [0, 10, 20, 7]
    assert abs(got["text"].distinct_count - 5000) < 200


def test_plans_scan_once(spark, tmp_path):
    """Profiles and histograms of many columns take one scan, with only the columns they need."""
    path = str(tmp_path / "t")
    spark.range(10).select("id", *[F.lit(i).alias(f"c{i}") for i in range(5)]).write.parquet(path)
    df = spark.read.parquet(path)
    for report in (profile.profile_table(df, "t"),
                   histograms.histogram(df, "t", [histograms.Bins(f"c{i}", 2) for i in range(3)]),
                   columns.layer_profile(df, "t", "bronze", ["c0", "c1"])):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
    assert "c3" not in histograms.histogram(
        df, "t", [histograms.Bins("c0", 2)])._jdf.queryExecution().executedPlan().toString()
