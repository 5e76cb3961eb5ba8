"""From documents to token ids: quality, near duplicates, repeats, test items, encoding.

Every stage works on all that its predecessor kept and returns the columns of documents,
the last one the ids in place of the text. Null texts are empty; a row without doc_id takes no part in
comparisons and stays unless its text is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm import bpe, contamination, files, kernel, setjoin, stats, suffixes
from siltstone.sources.staging import stage

#: SQL can express neither the classifier nor the encoding; the tests compare with plain versions.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    files.ship(spark)
    measured = stage(stats.measure(docs), "measured")
    return kernel.accepted(docs, kernel.learn(measured, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Of rows with the same doc_id the one whose text has the least hash stays.
    """
    files.ship(spark)
    found = setjoin.linked(docs, setjoin.Rule(shingle=5, percent=80)).filter("kept and doc_id is not null")
    place = max(["_place", *(f"{c}_" for c in docs.columns)], key=len)
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    named = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi").withColumn(place, F.row_number().over(first))
    return named.filter(F.col(place) == 1).select(*docs.columns).unionByName(docs.filter("doc_id is null"))


@F.pandas_udf(T.StringType())
def _text(kept: pd.Series) -> pd.Series:
    """Text of the bytes that are left; a character of which a byte is gone goes too."""
    return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings of earlier ones; those of which nothing is left go."""
    files.ship(spark)
    others = F.struct(*(c for c in docs.columns if c != "text"))
    found = suffixes.deduplicated(docs.select("doc_id", "text", others.alias("row")))
    left = found.filter("cardinality(spans) = 0 or octet_length(kept) > 0").select("row", "spans", _text("kept").alias("new"))
    left = left.filter(r"cardinality(spans) = 0 or new rlike '[^\\x20\\x09-\\x0D]'")
    columns = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return left.select(*(columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of the benchmark is found."""
    files.ship(spark)
    return contamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    files.ship(spark)
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("suffix array dedup", repeats),
    ("benchmark decontamination", test_items),
    ("bpe encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
