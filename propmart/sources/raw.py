"""Raw landing readers: listing JSON (S2, S3) and headered CSV.

No reader nulls or drops a value silently.  Files are cut into records by all
tasks (``splitting``).  JSON records are parsed once into variants, which keep
every scalar as written, and CSV cells are text; both are typed by ``conform``
(S8).  What cannot be read at all goes to a quarantine
frame with its file, reason and text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propmart.functions.conform import conform
from propmart.schemas import (
    AVG_PRICE_SCHEMA,
    INCOME_RANGES,
    INCOME_RAW_INDEX_HEADER,
    INCOME_SCHEMA,
    LISTING_OPTIONAL,
    LISTING_SCHEMA,
    LOOKUP_SCHEMA,
    RENT_RANGES,
    RENT_SCHEMA,
)
from propmart.sources.splitting import JsonArray, csv_records, fragments, json_elements, numbered

_BOM = "﻿"

# ---------------------------------------------------------------------------
# JSON
# ---------------------------------------------------------------------------


def json_texts(reader, path: str, glob: str | None = "*.json", json_lines: bool = False, staged: str | None = None) -> DataFrame:
    """(value, source_file) of JSON files: one row per array element, or per line.

    Arrays of any size are cut by as many tasks as Spark has splits for them;
    a folder ``staged`` keeps the cut texts (see ``cut_records``).
    """
    if not json_lines:
        return json_elements(fragments(reader, path, glob, JsonArray.separator.decode()), staged)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select("value", F.col("_metadata.file_name").alias("source_file"))


def json_records(texts: DataFrame) -> DataFrame:
    """One row per record of JSON texts (one record each, or arrays of records).

    Columns source_file, record (variant) and problem.  A text that is no JSON
    gives one row with a problem and its text as ``bad_text``, and so does an
    element that is no object.  Blank texts give no row.  The last value of a
    repeated key counts (a setting of the session).
    """
    texts.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.when(F.startswith("value", F.lit(_BOM)), F.substring("value", 2, 2**31 - 1)).otherwise(F.col("value"))
    parsed = texts.where(F.trim(text) != "").select("source_file", "value", F.try_parse_json(text).alias("v"))
    records = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    rows = parsed.select("source_file", F.when(F.col("v").isNull(), F.col("value")).alias("bad_text"), F.explode(records).alias("record"))
    is_object = F.schema_of_variant("record").startswith("OBJECT")
    keyed = F.try_variant_get("record", "$.propertyCode", "variant").isNotNull()  # the usual case, without a schema
    problem = F.when(F.col("bad_text").isNotNull(), "not JSON").when(keyed, F.lit(None)).when(~F.coalesce(is_object, F.lit(False)), "not a record")
    rows = rows.select("source_file", "record", problem.alias("problem"), "bad_text")
    return rows.withColumn("bad_text", F.when(F.col("problem") == "not a record", F.col("record").cast("string")).otherwise(F.col("bad_text")))


def _as_text(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in dtype.fields])
    return T.StringType()


def record_columns(records: DataFrame, schema: T.StructType, record: str = "record") -> DataFrame:
    """The fields of ``schema`` of each record as text (nested ones by name, X12).

    ``149000.0``, ``"921"`` and whole numbers beyond 2**53 keep their value.
    The fields are taken in one pass over the record.
    """
    fields = F.try_variant_get(record, "$", _as_text(schema).simpleString()).alias("fields")
    return records.select("source_file", fields).select("source_file", "fields.*")


def missing_keys(record: str, names: Sequence[str]) -> Column:
    """Those of ``names`` that a record has no key of."""
    return F.array_except(F.array(*[F.lit(c) for c in names]), F.map_keys(F.try_variant_get(record, "$", "map<string,variant>")))


def listings_from_records(records: DataFrame, on_error: str = "raise") -> DataFrame:
    """Typed listing rows + ``source_file`` of records with a ``problem`` column.

    A record with a problem fails the job (``raise``) or is left to the
    quarantine (``null``).  The test is a filter, so that no projection or
    count can prune it.
    """
    if on_error == "raise":
        message = F.concat(F.lit("unreadable listing record in "), F.col("source_file"), F.lit(": "), F.col("problem"))
        good = records.where(F.when(F.col("problem").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    else:
        good = records.where(F.col("problem").isNull())
    texts = record_columns(good, LISTING_SCHEMA)
    return conform(texts, LISTING_SCHEMA, optional=LISTING_OPTIONAL, on_error=on_error, keep=["source_file"])


def read_listings(spark: SparkSession, path: str, on_error: str = "raise", glob: str | None = "*.json", json_lines: bool = False) -> DataFrame:
    """Listing snapshot files (JSON arrays of records) -> typed rows + ``source_file``.

    One plan for plain, quoted and ``149000.0`` numbers alike: nothing runs at
    call time.  Arrays are cut into records by all the tasks that their splits
    give (two scans, no shuffle of the text); ``json_lines=True`` reads one
    record per line.  An unreadable record costs that record alone.  Absent
    optional columns (parking, neighborhood) read as null; an empty array gives
    no rows.  With ``on_error="null"`` a value that does not fit is null, and
    unreadable records are found by ``quarantined_listings``.
    """
    return listings_from_records(json_records(json_texts(spark.read, path, glob, json_lines)), on_error)


def quarantined_listings(spark: SparkSession, path: str, glob: str | None = "*.json", json_lines: bool = False) -> DataFrame:
    """(source_file, problem, bad_text) of everything ``read_listings`` cannot read."""
    return quarantined_records(json_records(json_texts(spark.read, path, glob, json_lines)))


def quarantined_records(records: DataFrame) -> DataFrame:
    """(source_file, problem, bad_text) of the records with a problem."""
    return records.where(F.col("problem").isNotNull()).select("source_file", "problem", "bad_text")


def absent_columns(records: DataFrame, required: Sequence[str]) -> DataFrame:
    """T5 report: (source_file, column) where no record of the file has the key.

    A key whose values are all null is present.
    """
    missing = missing_keys("record", required)
    # a row per file and set of missing keys; a column is absent that all sets of the file have.  Null stands for a set.
    sets = records.where(F.col("problem").isNull()).select("source_file", missing.alias("missing")).distinct()
    found = sets.select("source_file", F.explode(F.concat("missing", F.array(F.lit(None).cast("string")))).alias("column"))
    found = found.groupBy("source_file", "column").agg(F.count(F.lit(1)).alias("n"))
    per_file = found.groupBy("source_file").agg(F.max(F.when(F.col("column").isNull(), F.col("n"))).alias("n_sets"), F.collect_list(F.struct("column", "n")).alias("found"))
    return per_file.select("source_file", "n_sets", F.inline("found")).where("column IS NOT NULL AND n = n_sets").select("source_file", "column")


def infer_json(records: DataFrame) -> T.StructType:
    """The schema that takes every record, from one mergeable aggregate.

    Fractions are doubles; a column of several types, or of nulls only, is text.
    """
    found = records.where(F.col("problem").isNull()).agg(F.schema_of_variant_agg("record")).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    found = re.sub(r"DECIMAL\(\d+,\s*0\)", "DECIMAL(38,0)", found)
    found = re.sub(r"DECIMAL\(\d+,\s*[1-9]\d*\)", "DOUBLE", found)
    found = re.sub(r"\b(VARIANT|VOID)\b(?=[,>])", "STRING", found)
    return T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found))


def read_json_inferred(spark: SparkSession, path: str, glob: str | None = "*.json") -> DataFrame:
    """S3: any other JSON array files, schema inferred over all of them, + ``source_file``.

    Only files of that suffix are read (F6).  A text that is no JSON, or no
    record, stays as a row with ``_corrupt_record``.
    """
    return records_inferred(json_records(json_texts(spark.read, path, glob)))


def records_inferred(records: DataFrame) -> DataFrame:
    """Records with the columns that ``infer_json`` finds, and ``_corrupt_record`` where there are bad ones."""
    schema = infer_json(records)
    columns = [F.try_variant_get("record", "$['" + f.name.replace("'", "\\'") + "']", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    good = records.where(F.col("problem").isNull()).select(*columns, "source_file")
    bad = records.where(F.col("problem").isNotNull()).select(F.col("bad_text").alias("_corrupt_record"), "source_file")
    return good.unionByName(bad, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# CSV bound by header name
# ---------------------------------------------------------------------------

# Header rows (one per file) are broadcast up to this many files.
HEADER_BROADCAST_FILES = 100_000


def csv_lines(reader, path: str, glob: str | None = "*.csv", encoding: str = "UTF-8") -> DataFrame:
    """Logical lines of CSV files: value, __file, and __start/__n, their order within a file."""
    return csv_records(numbered(fragments(reader, path, glob, encoding=encoding)))


def header_lines(lines: DataFrame) -> DataFrame:
    """(__file, header): the first line with any text of each file."""
    first = lines.where((F.col("__start") == 0) & (F.trim("value") != ""))
    return first.groupBy("__file").agg(F.min_by("value", "__n").alias("header"))


def _cells(line: Column, width: int) -> Column:
    """The cells of a CSV line as text: no byte-order mark or outer blanks; empty: null."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    row = F.from_csv(F.regexp_replace(line, f"^{_BOM}", ""), schema, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "escape": '"'})
    return F.array(*[F.nullif(F.trim(row[f"c{i}"]), F.lit("")) for i in range(width)])


def _shape(headers: DataFrame) -> tuple[int, int]:
    """Files with a header, and the most cells that one may have."""
    found = headers.agg(F.count(F.lit(1)), F.max(F.length("header") - F.length(F.replace("header", F.lit(","), F.lit(""))) + 1)).first()
    return found[0], found[1] or 1


def bind_by_header(
    lines: DataFrame, headers: DataFrame, names: Mapping[str, Sequence[str]], on_error: str = "raise", shape: tuple[int, int] | None = None
) -> DataFrame:
    """The columns ``names`` of CSV lines, found through each file's own header.

    ``lines`` has value and __file, ``headers`` __file and header; ``names``
    maps output column -> header spellings.  Columns may come in any order
    and among others, which are ignored.  A file that lacks one fails the job
    (``raise``) or reads it as null (``null``; ``lacking_columns`` lists such
    files).  Lines equal to the header are not data.  ``shape`` is that of the
    headers where it is known; else a job finds it.
    """
    n_files, width = shape or _shape(headers)
    heads = headers.select(F.col("__file").alias("__hfile"), _cells(F.col("header"), width).alias("__header"))
    heads = heads.select("*", *[_position(F.col("__header"), s).alias(f"__p{j}") for j, s in enumerate(names.values())])
    if n_files <= HEADER_BROADCAST_FILES:
        heads = F.broadcast(heads)
    cells = lines.where(F.trim("value") != "").select("__file", _cells(F.col("value"), width).alias("__cells"))
    rows = cells.join(heads, cells["__file"] == F.col("__hfile")).where(F.col("__cells") != F.col("__header"))
    if on_error == "raise":
        lacking = reduce(lambda a, b: a | b, [F.col(f"__p{j}").isNull() for j in range(len(names))])
        message = F.concat(F.lit("no recognised CSV header in "), F.col("__file"))
        # a filter: no projection or count can prune it
        rows = rows.where(F.when(lacking, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    out = [F.get("__cells", F.col(f"__p{j}") - 1).alias(c) for j, c in enumerate(names)]
    return rows.select(*out, F.col("__file").alias("source_file"))


def _position(header: Column, spellings: Sequence[str]) -> Column:
    found = [F.array_position(header, s) for s in spellings]
    return F.nullif(found[0] if len(found) == 1 else F.greatest(*found), F.lit(0)).cast("int")


def lacking_columns(headers: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """(source_file, column) of the columns that no spelling of ``names`` finds in a file's header."""
    width = headers.agg(F.max(F.length("header"))).first()[0] or 1
    cells = headers.select("__file", F.split(F.regexp_replace("header", f'[{_BOM}"]', ""), r"\s*,\s*", min(width, 10_000)).alias("h"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _position(F.col("h"), s).isNull().alias("lacks")) for c, s in names.items()])
    return cells.select(F.col("__file").alias("source_file"), F.explode(pairs).alias("s")).where("s.lacks").select("source_file", "s.column")


def read_csv_by_name(spark: SparkSession, path: str, names: Mapping[str, Sequence[str]], glob: str | None = "*.csv", on_error: str = "raise") -> DataFrame:
    """Headered CSV files -> text columns named by ``names``.

    A doubled quote inside quotes is a quote, a line break inside quotes part
    of its cell.
    """
    lines = csv_lines(spark.read, path, glob)
    return bind_by_header(lines, header_lines(lines), names, on_error)


def _same_names(schema: T.StructType) -> dict[str, list[str]]:
    return {f.name: [f.name] for f in schema.fields}


def read_lookup(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Lookup CSV files, all text."""
    raw = read_csv_by_name(spark, path, _same_names(LOOKUP_SCHEMA), on_error=on_error)
    return conform(raw, LOOKUP_SCHEMA, on_error=on_error, keep=["source_file"])


def read_rent(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Rent CSV files; the price stays text."""
    raw = read_csv_by_name(spark, path, _same_names(RENT_SCHEMA), on_error=on_error)
    return conform(raw, RENT_SCHEMA, on_error=on_error, keep=["source_file"], ranges=RENT_RANGES)


def income_names() -> dict[str, list[str]]:
    names = _same_names(INCOME_SCHEMA)
    names["Index_RFD_Barcelona_100"] = ["Index_RFD_Barcelona_100", INCOME_RAW_INDEX_HEADER]
    return names


def read_income(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Income CSV files; the index column comes from its raw header, as text."""
    raw = read_csv_by_name(spark, path, income_names(), on_error=on_error)
    return conform(raw, INCOME_SCHEMA, on_error=on_error, keep=["source_file"], ranges=INCOME_RANGES)


INFERRED_TYPES = ("bigint", "double", "boolean", "date", "timestamp")


def infer_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns as the first type that takes every value of them, else text (one aggregate)."""
    if not columns:
        return df
    fits = [F.coalesce(F.min(F.col(f"`{c}`").try_cast(t).isNotNull() | F.col(f"`{c}`").isNull()), F.lit(False)) for c in columns for t in INFERRED_TYPES]
    some = [F.count(F.col(f"`{c}`")) > 0 for c in columns]
    found = df.agg(*[e.alias(f"f{i}") for i, e in enumerate(fits + some)]).first()
    out = []
    for i, c in enumerate(columns):
        own = found[i * len(INFERRED_TYPES) : (i + 1) * len(INFERRED_TYPES)]
        dtype = next((t for t, ok in zip(INFERRED_TYPES, own, strict=True) if ok), "string") if found[len(fits) + i] else "string"
        out.append(F.col(f"`{c}`").cast(dtype).alias(c))
    return df.select(*out, *[F.col(f"`{c}`") for c in df.columns if c not in set(columns)])


def read_csv_inferred(spark: SparkSession, path: str, glob: str | None = "*.csv") -> DataFrame:
    """Any other headered CSV files, united by header name, types inferred.

    A column that only some files have is null for the others.  The driver
    holds the distinct column names.
    """
    lines = csv_lines(spark.read, path, glob)
    headers = header_lines(lines)
    shape = _shape(headers)
    if not shape[0]:
        return spark.createDataFrame([], "source_file string")
    cells = headers.select(F.posexplode(_cells(F.col("header"), shape[1]))).where("col IS NOT NULL")
    columns = [r["col"] for r in cells.groupBy("col").agg(F.min("pos").alias("pos")).orderBy("pos", "col").collect()]
    rows = bind_by_header(lines, headers, {c: [c] for c in columns}, on_error="null", shape=shape)
    return infer_types(rows.withColumn("source_file", F.substring_index("source_file", "/", -1)), columns)


def read_kpi_csv(spark: SparkSession, path: str, schema: T.StructType = AVG_PRICE_SCHEMA) -> DataFrame:
    """A published KPI CSV with its typed columns, as the dashboard reads it."""
    return spark.read.schema(schema).option("header", True).csv(path)
