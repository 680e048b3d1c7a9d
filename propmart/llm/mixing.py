"""Mixing sources to target weights by hash-threshold histograms.

Each row has a 60-bit hash.  Per source, the words are summed by hash bucket;
the bucket in which the running sum passes the budget is the only one that is
refined, level by level down to single hashes.  The result is one
threshold per source: rows whose hash is below it are taken once more.
Nothing is sorted except the histograms, and thresholds of a smaller budget
are lower, so mixes are nested.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propmart.llm.common import written

HASH_BITS = 60
LEVEL_BITS = 12  # bits that one histogram tells apart: at most 4,096 buckets per source


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(key: Column, digest: Column, ordinal: Column, seed: str = "mix") -> Column:
    """60-bit hash of a row's id, the MD5 of its text and its number among equal rows; SQL elsewhere can repeat it."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(digest, F.lit("")), ordinal.cast("string"), F.lit(seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Targets per source from rows (source, source_size), one per source.

    Sources in code-point order, null last, get the weights in turn.  Targets
    are proportional to weights, but at most ``most`` times the source's size:
    sources are taken in the order in which a rising level fills them up, and
    the level is shared by those that are not full.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    t = totals.select("source", "source_size", weight.alias("w")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"),
        F.sum("w").over(everything).alias("w_all"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w_before"),
    )
    t = t.withColumn("level", (F.col("budget") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before")))
    t = t.withColumn("full", F.col("cap") / F.col("w") <= F.col("level"))
    shared = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return t.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap")).otherwise(shared * F.col("w")).alias("target"),
    )


def _boundary(hist: DataFrame) -> DataFrame:
    """The first bucket per source whose running sum reaches the budget.

    ``hist`` has source, need, base (words below the histogram), bucket, words.
    """
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    run = hist.withColumn("end", F.col("base") + F.sum("words").over(w))
    return (
        run.filter(F.col("end") >= F.col("need"))
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("end") - F.col("words")).alias("base"), "need")).alias("b"))
        .select("source", "b.need", F.col("b.base").alias("base"), F.col("b.bucket").alias("at"))
    )


def mix_plan(
    sized: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Thresholds per source from rows (source, size, h).

    Returns (source, source_size, target, whole, threshold): every row is
    taken ``whole`` times, and once more when its hash is below ``threshold``.
    Rows of one hash are taken together; the row set nearest to the target is
    chosen, a tie leaving the boundary hash out.  Empty input gives no rows.
    ``sized`` is read three times and should be a written table; later levels
    read only the rows of the boundary buckets.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(totals, weights, share, most).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    )
    plan = written(plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    def finer(rows: DataFrame, state: DataFrame, shift: int) -> DataFrame:
        sums = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        s = state.select(F.col("source").alias("s"), "need", "base")
        return sums.join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def within(rows: DataFrame, state: DataFrame, shift: int) -> DataFrame:
        s = state.select(F.col("source").alias("s"), "at")
        same = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift) == F.col("at"))
        return rows.join(s, same).select("source", "size", "h")

    rows = sized.select("source", "size", "h")
    state = plan.select("source", "need", F.lit(0).cast("long").alias("base"))
    for shift in range(HASH_BITS - LEVEL_BITS, 0, -LEVEL_BITS):
        state = written(_boundary(finer(rows, state, shift)), f"mix-level{shift}")
        rows = written(within(rows, state, shift), f"mix-rows{shift}")
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    units = finer(rows, state, 0).withColumn("end", F.col("base") + F.sum("words").over(run))
    taken = F.col("end") * 2 - F.col("words") < F.col("need") * 2
    thresholds = units.groupBy(F.col("source").alias("s")).agg(
        F.coalesce(F.min(F.when(~taken, F.col("bucket"))), F.max("bucket") + 1).alias("threshold")
    )
    out = plan.join(thresholds, F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select("source", "source_size", "target", "whole", F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold"))


_GROUP = ("doc_id", "source", "digest")


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (of a null text: 0) and digest of each row, its partition and its place there, and the row itself."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", F.col("text").alias("t"))
    rows = rows.select("row", "doc_id", "source", word_count(F.col("t")).alias("size"), F.md5(F.col("t").cast("binary")).alias("digest"))
    return rows.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())


def _same_group() -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in _GROUP]


def _repeated(light: DataFrame) -> DataFrame:
    """Groups of rows of one id, text and source: how many of them lie in earlier partitions, per partition."""
    counts = light.groupBy(*_GROUP, "part").agg(F.count(F.lit(1)).alias("n"))
    several = counts.groupBy(*[F.col(c).alias(f"g_{c}") for c in _GROUP]).agg(F.sum("n").alias("all")).where("all > 1").drop("all")
    joined = counts.join(written(several, "mix-repeated"), reduce(lambda a, b: a & b, _same_group())).select(*_GROUP, "part", "n")
    before = Window.partitionBy(*_GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = joined.select(*[F.col(c).alias(f"g_{c}") for c in _GROUP], F.col("part").alias("g_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return written(firsts, "mix-firsts")


def _hashed(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with h.  Equal rows are numbered within the partition that they lie in, after those of earlier ones."""
    known = rows.join(repeated, reduce(lambda a, b: a & b, [*_same_group(), F.col("part") == F.col("g_part")]), "left")
    single = known.where("before IS NULL").withColumn("ordinal", F.lit(1).cast("long"))
    within = Window.partitionBy(*_GROUP, "part").orderBy("place")
    equal = known.where("before IS NOT NULL").withColumn("ordinal", F.row_number().over(within) + F.col("before"))
    return single.unionByName(equal).withColumn("h", row_hash(F.col("doc_id"), F.col("digest"), F.col("ordinal")))


def _sized(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, h) per row, and the groups of equal rows; no text is written."""
    light = written(_marked(docs.select("doc_id", "source", "text")).drop("row"), "mix-rows")
    repeated = _repeated(light)
    return written(_hashed(light, repeated).select("doc_id", "source", "size", "h"), "mix-sized"), repeated


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words, repeats counted).

    No two rows have one hash but by chance: rows of one id, text and source
    are numbered, and which of them has which number changes nothing.
    """
    sized, _ = _sized(docs)
    plan = written(mix_plan(sized, **options), "mix-plan").withColumnRenamed("source", "s")
    copies = F.col("whole") + (F.col("h") < F.col("threshold")).cast("int")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, repeated or left out.

    Rows without words are kept once: they take nothing from the budget.
    ``docs`` is read twice and should come in the same partitions both times,
    as files do: equal rows are numbered by them.
    """
    sized, repeated = _sized(docs)
    plan = written(mix_plan(sized, **options), "mix-plan").withColumnRenamed("source", "s")
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("whole") + (F.col("h") < F.col("threshold")).cast("int"))
    joined = _hashed(_marked(docs), repeated).join(plan, F.col("source").eqNullSafe(F.col("s")))
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
