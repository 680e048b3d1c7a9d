"""Formatted-zone projections (P1-P6) and the by-name union.

Columns are named in the ``select`` itself (P4: no positional ``_1.._n``
rename after inferring a schema); computed columns use ``withColumn`` (P5).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.operators.reconcile import reconcile
from propmart.schemas import (
    FORMATTED_INCOME_SCHEMA,
    FORMATTED_LISTING_SCHEMA,
    FORMATTED_RENT_SCHEMA,
    INCOME_POPULATION_OUT,
)

_TWO_KEYS = [("Nom_Districte", "district"), ("Nom_Barri", "neighborhood")]
_RECONCILED_NAMES = {"district": "district_n_reconciled", "neighborhood": "neighborhood_n_reconciled"}


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def format_listings(
    listings: DataFrame, lookup: DataFrame, keep_fanout: bool = False
) -> DataFrame:
    """P1 + J4 + P6: latest listings -> the 15 formatted columns.

    The neighborhood is reconciled through the lookup on the neighborhood name
    only; the district stays as listed (Q5).  Numbers are widened to
    bigint/double as the zone stores them (Q15).
    """
    rec = reconcile(
        listings,
        lookup,
        on=[("neighborhood", "neighborhood")],
        take={"neighborhood": "neighborhood_n_reconciled"},
        keep_fanout=keep_fanout,
    )
    return _typed(rec, FORMATTED_LISTING_SCHEMA)


def format_income(
    income: DataFrame, lookup: DataFrame, keep_fanout: bool = False
) -> DataFrame:
    """P2 + J2: income rows with reconciled district/neighborhood names."""
    rec = reconcile(
        income, lookup, on=_TWO_KEYS, take=_RECONCILED_NAMES, keep_fanout=keep_fanout
    )
    rec = rec.withColumnRenamed("Any", "year").withColumnRenamed("Població", INCOME_POPULATION_OUT)
    return _typed(rec, FORMATTED_INCOME_SCHEMA)


def format_rent(
    rent: DataFrame, lookup: DataFrame, keep_fanout: bool = False
) -> DataFrame:
    """P3 + J3: rent rows with reconciled district/neighborhood names."""
    rec = reconcile(
        rent, lookup, on=_TWO_KEYS, take=_RECONCILED_NAMES, keep_fanout=keep_fanout
    )
    return _typed(rec.withColumnRenamed("Any", "year"), FORMATTED_RENT_SCHEMA)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing from a frame is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
