"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from propmart.schemas import SNAPSHOT_DATE_FORMAT, SNAPSHOT_NAME_CHARS
from propmart.functions.text import name_prefix


def snapshot_date(file_name: Column, strict: bool = True) -> Column:
    """X4+X5: date encoded in the first 10 characters of a snapshot file name.

    ``strict`` fails the job on a name that is not ``yyyy_MM_dd...``;
    otherwise such rows get a null date (to be quarantined by the caller).
    """
    prefix = name_prefix(file_name, SNAPSHOT_NAME_CHARS)
    parsed = F.try_to_date(prefix, SNAPSHOT_DATE_FORMAT)
    if not strict:
        return parsed
    return F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("bad snapshot file name: "), file_name))).otherwise(
        parsed
    )


def year_of(date: Column) -> Column:
    """Calendar year as bigint (the zone's integer type)."""
    return F.year(date).cast("bigint")
