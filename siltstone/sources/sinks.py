"""Writes, publication and checks after a load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.schema import union_all


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_cols: Iterable[str] = (), num_partitions: int | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Parquet sink.

    Without ``num_partitions`` the rows are rebalanced: adaptive execution picks
    the number of files from the actual size and splits a large table partition
    over several tasks. With partition columns only the partitions in ``df`` are
    overwritten.
    """
    keys = list(partition_cols)
    sized = df.repartition(num_partitions) if num_partitions else df.hint("rebalance", *keys)
    writer = sized.write.mode(mode)
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_batch(df: DataFrame, path: str, batch_date: str, num_partitions: int | None = None,
                rebalance: bool = False, order: Iterable[str | Column] = ()) -> None:
    """Replace one batch of a table that is partitioned by ``batch_date``.

    The batch's own folder is overwritten, so a re-run without rows leaves none of the
    old ones, and a file with the schema keeps an empty table readable. Rows are written by the tasks that made them: no shuffle, and files keep the
    order of the input, which is what "first row" means to the later layers.
    ``rebalance`` is for a small share of a large table, which would otherwise be
    one tiny file per task. ``order`` sorts the rows of each file.
    """
    sized = df.repartition(num_partitions) if num_partitions else df.hint("rebalance") if rebalance else df
    sized = sized.sortWithinPartitions(*order) if order else sized
    sized.drop("batch_date").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_date={batch_date}")


def file_bytes(spark: SparkSession, path: str) -> list[int]:
    """The sizes of the data files of a Parquet folder, in any store that Spark writes to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getLen() for f in found if f.getPath().getName().endswith(".parquet")]


def bytes_per_row(written: DataFrame) -> float:
    """Bytes of a written frame in its files, for each of its rows; 0 for one without rows."""
    spark, rows = written.sparkSession, written.count()
    folders = {f.rsplit("/", 1)[0] for f in written.inputFiles()}
    return sum(n for f in folders for n in file_bytes(spark, f)) / rows if rows else 0.0


def write_sized(df: DataFrame, path: str, target: int, row_bytes: float, mode: str = "overwrite") -> int:
    """Write files of about ``target`` bytes, by what a row has taken in a copy that was written before.

    Rows are dealt out evenly over as many tasks as the bytes ask for, so a task that holds most of the rows is cut
    and many small ones are joined; the row limit of a file holds where the rows of this output are longer. Returns the number
    of tasks. The count reads no columns.
    """
    rows = df.count()
    tasks = max(1, round(rows * row_bytes / target))
    even = df.repartition(tasks)
    even.write.mode(mode).option("maxRecordsPerFile", max(1, -(-rows // tasks) * 5 // 4)).parquet(path)
    return tasks


METRICS_SCHEMA = "table_name string, row_count bigint, flagged bigint, columns bigint"


def write_measured(df: DataFrame, path: str, batch_date: str, metrics: str, name: str, flagged: Column | None = None, **how) -> int:
    """``write_batch``, and what was written into the table of metrics of the batch: rows, rows where ``flagged`` holds, columns.

    The counts come from the write itself (an observation), so no table is read again to be counted. A write that
    is repeated replaces its row.
    """
    from pyspark.sql import Observation

    seen = Observation()
    flag = F.lit(0).cast("bigint") if flagged is None else F.count_if(flagged)
    counted = df.observe(seen, F.count(F.lit(1)).alias("row_count"), flag.alias("flagged"))
    write_batch(counted, path, batch_date, **how)
    found = seen.get
    row = (name, found.get("row_count", 0), found.get("flagged", 0), len([c for c in df.columns if c != "batch_date"]))
    df.sparkSession.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{metrics.rstrip('/')}/batch_date={batch_date}/written={name.replace('/', '.')}")
    return row[1]


def written_counts(spark: SparkSession, metrics: str, batch_date: str) -> DataFrame:
    """(table_name, row_count, flagged, columns) of all tables that the batch has written with their counts."""
    return spark.read.schema(METRICS_SCHEMA).parquet(f"{metrics.rstrip('/')}/batch_date={batch_date}/*")


def publish_tables(tables: Mapping[str, DataFrame], database: str | None = None,
                   path: str | None = None) -> None:
    """Replace each published table, in the catalog or as Parquet below ``path``."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if path is not None:
            writer.parquet(f"{path.rstrip('/')}/{name}")
        else:
            writer.saveAsTable(f"{database}.{name}" if database else name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    return union_all(
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def published(spark: SparkSession, names: Iterable[str], database: str | None = None,
              path: str | None = None) -> dict[str, DataFrame]:
    """The tables written by ``publish_tables``."""
    if path is not None:
        return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
    return {n: spark.table(f"{database}.{n}" if database else n) for n in names}
