"""Sums of doubles that are the same for every partitioning.

Adding doubles rounds, so a sum depends on the order of the rows.  Here every
value is split, without error, into whole multiples of 2**(32 k); these add up
exactly as integers per ``k``, in any order, and the total is rounded once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = 1 << 32


def _power(k: Column) -> Column:
    """2**(32 k), as a double."""
    return F.pow(F.lit(2.0), k * 32)


def split_double(x: Column) -> Column:
    """An array of (bin k, integer) whose sum of integer * 2**(32 k) is ``x``; 0, NaN and infinities have none.

    The first bin comes from a rounded logarithm; were it one off, the three
    parts would still hold all 53 bits.
    """
    def parts(v: Column) -> Column:
        k = F.floor(F.log2(F.abs(v)) / 32).cast("int")
        whole = lambda r, i: F.when(r >= 0, F.floor(r / _power(k - i))).otherwise(F.ceil(r / _power(k - i))).cast("double")
        top = whole(v, 0)
        rest = v - top * _power(k)
        middle = whole(rest, 1)
        low = whole(rest - middle * _power(k - 1), 2)
        return F.array(*[F.struct((k - i).alias("bin"), p.cast("long").alias("part")) for i, p in ((0, top), (1, middle), (2, low))])

    finite = ~F.isnan(x) & (F.abs(x) <= F.lit(1.7976931348623157e308)) & (x != 0)
    # bound by a lambda, so that the value is computed once
    return F.when(finite, F.filter(F.get(F.transform(F.array(x), parts), F.lit(0)), lambda p: p["part"] != 0))


def _digits(bins: Column, sign: int) -> Column:
    """(carry, digits): digits to base 2**32 of the total of (bin, sum) entries, from the lowest bin to two past the highest.

    A carry below zero says that the total is negative.
    """
    held = F.map_from_entries(bins)
    low, high = F.array_min(F.map_keys(held)), F.array_max(F.map_keys(held)) + 2
    empty = F.struct(F.lit(0).cast("decimal(38,0)").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def add(state: Column, k: Column) -> Column:
        total = (F.coalesce(F.try_element_at(held, k), F.lit(0).cast("decimal(38,0)")) * sign + state["carry"]).cast("decimal(38,0)")
        digit = F.pmod(total, F.lit(BASE).cast("decimal(38,0)")).cast("bigint")
        carry = ((total - digit) / F.lit(BASE).cast("decimal(10,0)")).cast("decimal(38,0)")
        return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits"))

    return F.aggregate(F.sequence(low, high), empty, add)


def _rounded(digits: Column, low: Column) -> Column:
    """The double nearest to digits (lowest first, at bin ``low``) to base 2**32, ties to even.

    The three highest digits are added with the error of the first addition
    kept; a half stands for whatever is below them.
    """
    top = F.array_max(F.transform(digits, lambda d, i: F.when(d != 0, i)))
    digit = lambda i: F.coalesce(F.get(digits, top - i), F.lit(0)).cast("double")
    a, b, c = digit(0) * float(2**64), digit(1) * float(2**32), digit(2)
    below = F.exists(F.slice(digits, 1, F.greatest(top - 2, F.lit(0))), lambda d: d != 0)
    total = a + b
    rest = (b - (total - a)) + c + F.when(below, 0.5).otherwise(0.0)
    half = F.pow(F.lit(2.0), (low + top - 2) * 16)  # twice, as one power might leave the range
    return (total + rest) * half * half


def sum_of_bins(bins: Column) -> Column:
    """The total of (bin, sum) entries, rounded once; null or no entries: 0."""
    low = F.array_min(F.map_keys(F.map_from_entries(bins)))
    up, down = _digits(bins, 1), _digits(bins, -1)
    value = F.when(up["carry"] >= 0, _rounded(up["digits"], low)).otherwise(-_rounded(down["digits"], low))
    return F.when(F.coalesce(F.size(bins), F.lit(0)) > 0, F.coalesce(value, F.lit(0.0))).otherwise(F.lit(0.0))


def exact_sums(df: DataFrame, by: Sequence[str], value: str | Column) -> DataFrame:
    """``by``, total (the exact sum, rounded once) and n (values that are not null) per group.

    Two aggregates that combine map-side: per group and bin, and over the at
    most 70 bins of a group.  NaN and infinities sum up as they do in floating
    point.  A group of nulls has total null and n 0.  Totals below 2**-960 may
    be rounded twice.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    keys = [F.col(c) for c in by]
    one = F.array(F.struct(F.lit(None).cast("int").alias("bin"), F.lit(None).cast("long").alias("part")))
    rows = df.select(*keys, x.alias("__x")).select(*keys, "__x", F.posexplode(F.concat(one, F.coalesce(split_double(F.col("__x")), F.slice(one, 1, 0)))).alias("__i", "__p"))
    first = F.col("__i") == 0
    odd = F.when(first & (F.isnan("__x") | (F.abs("__x") > F.lit(1.7976931348623157e308))), F.col("__x"))
    per_bin = rows.groupBy(*by, F.col("__p.bin").alias("__bin")).agg(
        F.sum(F.col("__p.part").cast("decimal(18,0)")).cast("decimal(38,0)").alias("__sum"), F.count(F.when(first, F.col("__x"))).alias("__n"), F.sum(odd).alias("__odd")
    )
    entry = F.when(F.col("__bin").isNotNull(), F.struct(F.col("__bin").alias("bin"), F.col("__sum").alias("sum")))
    groups = per_bin.groupBy(*by).agg(F.collect_list(entry).alias("__bins"), F.sum("__n").alias("n"), F.sum("__odd").alias("__odd"))
    total = F.when(F.col("n") == 0, F.lit(None)).when(F.col("__odd").isNotNull(), F.col("__odd")).otherwise(sum_of_bins(F.col("__bins")))
    return groups.select(*by, total.alias("total"), "n")


def exact_average(df: DataFrame, by: Sequence[str], value: str | Column, out: str = "avg") -> DataFrame:
    """``by`` and the mean of ``value``, bit by bit the same for every partitioning; null without values."""
    return exact_sums(df, by, value).select(*by, F.try_divide(F.col("total"), F.col("n").cast("double")).alias(out))
