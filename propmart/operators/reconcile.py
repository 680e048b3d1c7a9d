"""Name reconciliation through lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECONCILED = ("district_n_reconciled", "neighborhood_n_reconciled")


def lookup_for(
    lookup: DataFrame,
    keys: Sequence[str],
    values: Sequence[str] = RECONCILED,
    keep_fanout: bool = False,
) -> DataFrame:
    """A5 + U2: the distinct lookup rows used for one join.

    By default only key + reconciled columns are kept before ``distinct``, so
    two lookup rows that agree on the reconciled names collapse into one.
    ``keep_fanout=True`` keeps the distinct *whole* rows (the source behaviour,
    where a key present in several rows multiplies the joined rows).
    """
    if keep_fanout:
        cols = list(keys) + [c for c in lookup.columns if c not in keys]
        return lookup.select(*cols).distinct()
    return lookup.select(*keys, *[c for c in values if c not in keys]).distinct()


def lookup_conflicts(lookup: DataFrame, keys: Sequence[str], value: str = "neighborhood_n_reconciled") -> DataFrame:
    """Q4 report: keys that map to more than one reconciled name.

    One aggregate; per key only the count and the two extreme names are kept
    (no per-key collection).
    """
    return (
        lookup.groupBy(*keys)
        .agg(
            F.countDistinct(value).alias("n_names"),
            F.min(value).alias("first_name"),
            F.max(value).alias("last_name"),
        )
        .where(F.col("n_names") > 1)
    )


def reconcile(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    take: dict[str, str],
    keep_fanout: bool = False,
) -> DataFrame:
    """Inner equi-join of ``df`` with the lookup, unmatched rows drop.

    ``on`` pairs (column of df, column of lookup); ``take`` maps output column
    -> lookup column, replacing a df column of that name.  SQL semantics: a
    null key never reconciles.

    No job runs when the plan is built: the planner broadcasts a lookup whose
    files are small, and adaptive execution one that turns out small.
    """
    lk_keys = [r for _, r in on]
    lk = lookup_for(lookup, lk_keys, list(take.values()), keep_fanout)
    lk = lk.select(
        *[F.col(r).alias(f"__lk{i}") for i, r in enumerate(lk_keys)],
        *[F.col(src).alias(f"__take_{out}") for out, src in take.items()],
    )
    cond = None
    for i, (left, _) in enumerate(on):
        c = df[left] == F.col(f"__lk{i}")
        cond = c if cond is None else cond & c
    joined = df.join(lk, cond, "inner")
    out = []
    for c in df.columns:
        out.append(F.col(f"__take_{c}").alias(c) if c in take else df[c])
    out.extend(F.col(f"__take_{o}").alias(o) for o in take if o not in df.columns)
    return joined.select(*out)
