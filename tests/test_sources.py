from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siltstone.operators import schema
from siltstone.sources import readers, sinks, staging


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines, ""quoted"""\n2,plain\nx,bad\n')
    table = "id int, text string, _corrupt_record string"
    rows = readers.read_csv(spark, str(tmp_path), table, multi_line=True).collect()
    assert rows[0].text == 'two\nlines, "quoted"' and rows[1].text == "plain"
    assert rows[2].id is None and rows[2]._corrupt_record is not None
    inferred = readers.read_csv(spark, str(tmp_path / "*.csv"), multi_line=True)
    assert inferred.dtypes == [("id", "string"), ("text", "string")] and inferred.count() == 3


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "t": ["x"]},\n {"a": 2, "t": []}]')
    assert readers.read_json(spark, str(tmp_path / "a.json")).count() == 2
    (tmp_path / "b.json").write_text('{"a": 1}\n{"a": 2}\n')
    lines = readers.read_json(spark, str(tmp_path / "b.json"), "a bigint", multi_line=False)
    assert sorted(r.a for r in lines.collect()) == [1, 2]


def test_optional_table(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "nowhere")) is None
    assert readers.empty(spark, "a int").count() == 0
    with pytest.raises(AnalysisException):
        readers.if_any(lambda: spark.sql("SELECT no_such_column"))


def test_partitioned_sink_overwrites_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(6).withColumn("p", F.col("id") % 3), path, partition_cols=["p"])
    sinks.write_parquet(spark.createDataFrame([(10, 1)], "id bigint, p bigint"), path, partition_cols=["p"])
    got = sorted((r.p, r.id) for r in spark.read.parquet(path).collect())
    assert got == [(0, 0), (0, 3), (1, 10), (2, 2), (2, 5)]


def test_sink_sizes(spark, tmp_path):
    sinks.write_parquet(spark.range(100), str(tmp_path / "n"), num_partitions=3)
    sinks.write_parquet(spark.range(100).coalesce(1), str(tmp_path / "m"), max_records_per_file=30)
    assert len(list((tmp_path / "n").glob("part-*"))) == 3
    assert len(list((tmp_path / "m").glob("part-*"))) == 4


def test_publish_to_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS published_here")
    try:
        for size in (3, 5):
            sinks.publish_tables({"numbers": spark.range(size)}, database="published_here")
        tables = sinks.published(spark, ["numbers"], database="published_here")
        assert sinks.row_counts(tables).first().row_count == 5
    finally:
        spark.sql("DROP DATABASE published_here CASCADE")


def test_stage_uses_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda s: str(tmp_path))
    staged = staging.stage(spark.range(5).withColumn("x", F.lit("a")), "five")
    assert staged.count() == 5 and list((tmp_path / "staged").iterdir())
    assert str(tmp_path) in staged.inputFiles()[0]


def test_job_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda s: str(tmp_path))
    with staging.staged_tables(spark) as stage:
        assert stage(spark.range(5), "five").count() == 5
        assert list((tmp_path / "staged").iterdir())
    assert not list((tmp_path / "staged").rglob("*.parquet"))


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" App-ID", "Price (USD)/unit.now")
    assert schema.normalize_names(df).columns == ["app_id", "price_usd_unit_now"]
    with pytest.raises(ValueError, match="collide"):
        schema.normalize_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_rename_and_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "appid int, votes_up int, helpful int")
    assert schema.rename_present(df, {"appid": "app_id", "votes_up": "helpful", "x": "y"}).columns == [
        "app_id", "votes_up", "helpful"]
    assert schema.present(df, ["helpful", "gone"]) == ["helpful"]
    with pytest.raises(ValueError, match="gone"):
        schema.present(df, ["helpful", "gone"], on_missing="error")


def test_key(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "appid string")
    assert [r.app_id for r in schema.normalize_key(df, "appid", "app_id").collect()] == [7]
