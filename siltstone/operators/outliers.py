"""Upper-quantile outliers: flag and cap against thresholds of the same table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators import quantiles
from siltstone.operators.rules import fired_names

REASONS = "outlier_reasons"
FLAG = "is_outlier"
LIMITS = "_limits"


def thresholds(df: DataFrame, columns: Iterable[str], quantile: float = 0.999,
               accuracy: int | None = None) -> Column:
    """One threshold per column, as a struct; exact unless ``accuracy`` asks for a sketch."""
    columns = list(columns)
    found = (
        quantiles.exact_quantiles(df, columns, [quantile]) if accuracy is None
        else quantiles.sketched_quantiles(df, columns, [quantile], accuracy)
    )
    return quantiles.one_row(found, columns)


def flag_and_cap(df: DataFrame, flag: Iterable[str] = (), cap: Iterable[str] = (),
                 quantile: float = 0.999, accuracy: int | None = None,
                 prefix: str = "p999_outlier_", suffix: str = "_capped",
                 keep_original: bool = True) -> DataFrame:
    """Add the reasons, the capped columns and the flag in one projection.

    The thresholds of all columns come from one subquery and serve both uses.
    """
    flag, cap = list(flag), list(cap)
    columns = list(dict.fromkeys([*flag, *cap]))
    if not columns:
        return df.withColumns({REASONS: F.array().cast("array<string>"), FLAG: F.lit(False)})
    df = df.withColumn(LIMITS, thresholds(df, columns, quantile, accuracy))
    limit = F.col(LIMITS)
    reasons = fired_names({f"{prefix}{c}": F.col(c) > limit.getField(c) for c in flag})
    capped = {
        (f"{c}{suffix}" if keep_original else c):
            F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), limit.getField(c)))
        for c in cap
    }
    flagged = df.withColumns({REASONS: reasons, **capped}).withColumn(FLAG, F.size(REASONS) > 0)
    return flagged.drop(LIMITS)
