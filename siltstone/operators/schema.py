"""Column naming, selection and type conformance."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import clean

# Housekeeping columns of the ingest that later layers drop.
METADATA_COLUMNS = [
    "batch_date",
    "bronze_ingested_at",
    "ingested_at",
    "silver_ingested_at",
    "_rescued_data",
    "_corrupt_record",
]


def normal_name(name: str) -> str:
    """Lower case; space, slash, dash and dot become ``_``; brackets go."""
    return name.strip().lower().translate(str.maketrans(" /-.", "____", "()"))


def normalize_names(df: DataFrame) -> DataFrame:
    names = [normal_name(c) for c in df.columns]
    clashes = sorted(n for n, count in Counter(names).items() if count > 1)
    if clashes:
        raise ValueError(f"column names collide after normalization: {clashes}")
    return df.toDF(*names)


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename a column where the old name exists and the new one does not."""
    taken = set(df.columns)
    todo = {}
    for old, new in mapping.items():
        if old in taken and new not in taken:
            todo[old] = new
            taken.add(new)
    return df.withColumnsRenamed(todo) if todo else df


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*METADATA_COLUMNS)


def present(df: DataFrame, names: Iterable[str], on_missing: str = "skip", known: Iterable[str] = ()) -> list[str]:
    """The names that ``df`` has, in the given order.

    With ``on_missing="error"`` a name that is not there is an error, so that a
    renamed column cannot silently shrink a report; ``known`` names may be absent, as some exports lack them.
    """
    names, known = list(names), set(known)
    missing = [n for n in names if n not in df.columns and n not in known]
    if missing and on_missing == "error":
        raise ValueError(f"columns not found: {missing}; table has {df.columns}")
    return [n for n in names if n in df.columns]


def select_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*present(df, names))


def select_as(df: DataFrame, key: str, renames: Mapping[str, str]) -> DataFrame:
    """The key and the columns that exist, under their new names."""
    return df.select(key, *[F.col(o).alias(n) for o, n in renames.items() if o in df.columns])


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast the columns of ``target`` that exist to its types, in its order."""
    return df.select(*[
        F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target if f.name in df.columns
    ])


def normalize_key(df: DataFrame, source: str, key: str) -> DataFrame:
    """Rename the source's key, make it a long, keep the rows that have one."""
    if source != key:
        df = df.withColumnRenamed(source, key)
    return df.withColumn(key, clean.to_long(df, key)).filter(F.col(key).isNotNull())


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column one of the frames lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
