"""Bottom-k fingerprints of shingle hashes, with built-in functions only.

The sketch of a text is the ascending array of the k least hashes of its
distinct word shingles.  Sketches of parts merge into the sketch of the whole,
and give the number of distinct shingles, resemblance and containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propmart.llm.common import written

K = 256
SIZE = 5
BUCKETS_PER_PARTITION = 32
MERGED_AT_ONCE = 64


def text_sketch(text: Column, k: int = K, size: int = SIZE) -> Column:
    """Bottom-k sketch of a text's ``size``-word shingles; null or blank: empty.

    Words are runs of characters other than ASCII white space; a text of fewer
    words has one shingle of all its words.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))

    # the words are bound once, by a lambda over an array of one array
    lists = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, hashes(w)).otherwise(F.array().cast("array<bigint>")))
    return F.slice(F.sort_array(F.array_distinct(lists[0])), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches cover."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact for sketches that are not full."""
    unit = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / unit)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two shingle sets; 1 for two empty ones."""
    both = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none."""
    n, j = distinct_shingles(a, k), resemblance(a, b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j * (n + distinct_shingles(b, k)) / ((1 + j) * n)))


def merge_groups(sketches: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from any number of part sketches (key, sketch).

    Merged in rounds over salted groups, so that a key with very many parts is
    never gathered at once: a group holds about ``MERGED_AT_ONCE`` sketches.
    """
    most = sketches.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    rows = sketches.select(F.col(key).alias("key"), F.col(sketch).alias("sketch"))
    smallest = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("sketch")))), 1, k).alias("sketch")
    parts = -(-most // MERGED_AT_ONCE)
    while parts > 1:
        rows = rows.groupBy("key", F.pmod(F.xxhash64("sketch", F.lit(parts)), F.lit(parts)).alias("salt")).agg(smallest).drop("salt")
        rows = written(rows, "sketch-merged")
        parts = -(-parts // MERGED_AT_ONCE)
    return rows.groupBy("key").agg(smallest).select(F.col("key").alias(key), F.col("sketch").alias(sketch))


def fingerprint(sketch: Column) -> Column:
    """A sketch as text: its 64-bit hashes, base64."""
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))), "\r\n", "")


def _longs(values: list[int]) -> Column:
    """An array of numbers as one constant, however many there are."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """Number of descending bounds that are at least ``doc_id``, in two steps; null: after all others."""
    if not bounds:
        return F.when(doc_id.isNull(), 1).otherwise(0)
    width = max(1, int(len(bounds) ** 0.5))
    whole = F.size(F.filter(_longs(bounds[width - 1 :: width]), lambda x: x >= doc_id))  # full groups of bounds
    part = F.size(F.filter(F.slice(_longs(bounds), whole * width + 1, width), lambda x: x >= doc_id))
    return F.when(doc_id.isNull(), len(bounds) + 1).otherwise(whole * width + part)


def with_next(rows: DataFrame, columns: list[str], derived: dict[str, Column], buckets: int) -> DataFrame:
    """Each row with ``columns`` of the next one in descending doc_id, as next_<column>.

    ``derived`` columns are computed after the shuffle and led likewise.  The last
    row's next is the first; null ids come last, rows of one id are ordered by
    text.  Ids are cut into about ``buckets`` runs; the first id of a run also
    visits the run before it, so one shuffle is enough.  The driver holds one
    id per run, and that list is broadcast.
    """
    probabilities = [i / buckets for i in range(1, buckets)]
    found = rows.agg(F.percentile_approx("doc_id", probabilities, max(10_000, 10 * buckets))).first()[0] if probabilities else None
    bounds = sorted(set(found or []), reverse=True)
    bucket = _bucket(F.col("doc_id"), bounds)
    tops = sorted((r.b, r.top) for r in rows.select("doc_id").groupBy(bucket.alias("b")).agg(F.max("doc_id").alias("top")).collect())
    if not tops:
        same = rows.select("*", *[F.col(c).alias(f"next_{c}") for c in columns]).withColumns(derived)
        return same.select("*", *[F.col(c).alias(f"next_{c}") for c in derived])
    numbers = [b for b, _ in tops]
    runs = rows.sparkSession.range(len(tops)).select(
        F.get(_longs(numbers), F.col("id").cast("int")).alias("__own"),
        # the run of null ids has no first id
        F.get(_longs([t for _, t in tops if t is not None]), F.col("id").cast("int")).alias("__top"),
        F.get(_longs(numbers[-1:] + numbers[:-1]), F.col("id").cast("int")).alias("__before"),
    )
    placed = rows.withColumn("__bucket", bucket.cast("long")).join(F.broadcast(runs), F.col("__bucket") == F.col("__own"))
    own = F.struct(F.col("__own").alias("run"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("__before").alias("run"), F.lit(True).alias("guest"))
    at = F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("__top")), F.array(own, guest)).otherwise(F.array(own)))
    dealt = placed.withColumn("__at", at).select(*rows.columns, F.col("__at.run").alias("__run"), F.col("__at.guest").alias("__guest"))
    order = Window.partitionBy("__run").orderBy("__guest", F.col("doc_id").desc_nulls_last(), "text")
    led = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    led = led.withColumns(derived).select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in derived])
    return led.filter(~F.col("__guest")).drop("__run", "__guest")


def edited_text(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by as many first characters of the next (or all)."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - cut).cast("int")), F.substring(next_text, F.lit(1), cut))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_shingles (estimated) and in_edited (estimated
    share of the text's shingles that the edited text keeps).  Null texts are
    empty; the likeness of two empty fingerprints is 1.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    led = with_next(rows, ["text"], {"sketch": text_sketch(F.col("text"), k)}, buckets)
    made = led.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    made = made.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "sketch",
        "next_sketch",
        text_sketch(F.col("edited"), k).alias("edited_sketch"),
    )
    # a generator keeps the optimizer from copying the sketch into every use
    one = made.select("*", F.explode(F.array(F.struct("edited_sketch"))).alias("e")).drop("edited_sketch").withColumn("edited_sketch", F.col("e.edited_sketch"))
    return one.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("in_edited"),
    )
