"""S8 ``conform``: bind raw (text) columns to a fixed schema by name.

Raw JSON/CSV is read with every scalar as text so that nothing is silently
nulled by the reader (a typed JSON read turns ``149000.0`` or ``"921"`` into
null for an int column).  ``conform`` then casts on the executors:

* integral targets must have no fraction and fit the type (``149000.0`` and
  ``1.49E5`` -> 149000, ``1.5`` -> error); they never pass through a double, so
  whole numbers beyond 2**53 stay exact;
* ``ranges`` adds bounds to columns, such as those of unsigned types;
* other scalars use ``try_cast``; text that does not parse is an error;
* structs are cast field by field (nested fields are addressed by name, X12);
* columns of the schema absent from the frame are an error unless listed as
  optional (then null).

``on_error="raise"`` fails the job on the first bad value (``raise_error``),
``on_error="null"`` keeps the row with a null in that column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _fail_or_null(given: Column, value: Column, message: str, on_error: str) -> Column:
    """``value``; where it is null and ``given`` is not, an error or null.

    ``value`` stands once in the expression, so it is computed once.
    """
    if on_error == "raise":
        return F.coalesce(value, F.when(given.isNotNull(), F.raise_error(F.lit(message))))
    if on_error == "null":
        return value
    raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")


def _whole(text: Column) -> Column:
    """The digits of a whole number written with a decimal point or an exponent, else null.

    The fraction is tested on the text: its digits past the exponent must be
    zeros, however many there are.
    """
    parts = [F.regexp_extract(text, r"^([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,3}))?$", i) for i in (1, 2, 3, 4)]
    shift = F.coalesce(F.nullif(parts[3], F.lit("")).cast("int"), F.lit(0))
    digits = F.concat(parts[1], F.rpad(parts[2], F.greatest(F.length(parts[2]), shift), "0"))
    point = F.length(parts[1]) + shift  # digits before the decimal point
    whole, rest = F.substr(digits, F.lit(1), F.greatest(point, F.lit(0))), F.substr(digits, F.greatest(point, F.lit(0)) + 1, F.length(digits))
    some = F.length(parts[1]) + F.length(parts[2]) > 0
    return F.when(some & ~rest.rlike("[1-9]"), F.concat(parts[0], F.when(whole == "", "0").otherwise(whole)))


def cast_checked(
    col: Column, source: T.DataType, target: T.DataType, name: str, on_error: str = "raise"
) -> Column:
    """Cast ``col`` (of type ``source``) to ``target`` with the rules above."""
    if source == target:
        return col
    if isinstance(target, T.StructType):
        if not isinstance(source, T.StructType):
            raise TypeError(f"column {name}: cannot conform {source.simpleString()} to a struct")
        present = {f.name: f.dataType for f in source.fields}
        fields = []
        for f in target.fields:
            if f.name in present:
                fields.append(
                    cast_checked(col[f.name], present[f.name], f.dataType, f"{name}.{f.name}", on_error).alias(
                        f.name
                    )
                )
            else:
                fields.append(F.lit(None).cast(f.dataType).alias(f.name))
        return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*fields))
    if isinstance(target, T.StringType):
        # Forced text keeps null as null.
        return col.cast("string")
    if isinstance(source, T.StringType):
        text = F.trim(col)
        if isinstance(target, _INTEGRAL):
            plain = F.when(text.contains("."), F.regexp_replace(text, r"(?<=\d)\.0*$", "")).otherwise(text)
            # in a lambda, which is evaluated for the rare text alone and adds no code to the stage
            rest = F.get(F.transform(F.array(text), _whole), F.lit(0)).try_cast(target)
            value = F.coalesce(plain.try_cast(target), F.when(text.rlike("[.eE]"), rest))
            return _fail_or_null(col, value, f"column {name}: value is not a whole {target.simpleString()}", on_error)
        return _fail_or_null(col, text.try_cast(target), f"column {name}: value is not a {target.simpleString()}", on_error)
    # numeric/boolean/date source: widen or narrow with an overflow check
    value = col.try_cast(target)
    if isinstance(target, _INTEGRAL) and isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
        value = F.when(col == F.floor(col), value)
    return _fail_or_null(col, value, f"column {name}: cannot cast to {target.simpleString()}", on_error)


def conform(
    df: DataFrame,
    schema: T.StructType,
    optional: Iterable[str] = (),
    on_error: str = "raise",
    keep: Iterable[str] = (),
    ranges: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Select ``schema``'s columns from ``df`` by name, cast and check them.

    ``keep`` lists extra columns (e.g. ``source_file``) passed through as-is,
    ``ranges`` the least and greatest value that a column may have.
    """
    ranges = ranges or {}
    optional = set(optional)
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in present and f.name not in optional]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    out = []
    for f in schema.fields:
        if f.name in present:
            value = cast_checked(F.col(f"`{f.name}`"), present[f.name], f.dataType, f.name, on_error)
            if f.name in ranges:
                low, high = ranges[f.name]
                value = _fail_or_null(value, F.when(value.between(low, high), value), f"column {f.name}: value is not in {low}..{high}", on_error)
            out.append(value.alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    out.extend(F.col(f"`{c}`") for c in keep)
    return df.select(*out)
