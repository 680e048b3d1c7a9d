"""Latest snapshot of every listing (J1/W2/A2) and the logical-key filter (F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """drop rows whose logical key is null (pushed to the Parquet scan)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def latest_dates(df: DataFrame, key: str | Sequence[str], date: str = "date") -> DataFrame:
    """A2: ``max(date)`` per key (partial aggregation before the shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max(date).alias("__latest"))


def latest_snapshot(df: DataFrame, key: str | Sequence[str] = "propertyCode", date: str = "date") -> DataFrame:
    """Keep every row that carries its key's latest date.

    Ties on the last date all stay (same as ``rank() == 1`` over
    ``partition by key order by date desc``), and a null key forms its own
    group.  It is written as aggregate + join back instead of a window so that
    one hot key cannot land in a single sort task: the max is combined map-side,
    and the join is keyed by (key, date), which spreads a hot key over its
    dates and lets adaptive execution split what is still skewed.
    """
    keys = [key] if isinstance(key, str) else list(key)
    latest = latest_dates(df, keys, date)
    renamed = latest.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__latest")
    cond = F.col(date).eqNullSafe(F.col("__latest"))
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(F.col(f"__k{i}"))
    return df.join(renamed, cond, "inner").select(*[df[c] for c in df.columns])
