"""Reading configuration text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\f\v"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(_BLANKS))


def present(value: Column) -> Column:
    """Null for empty text."""
    return F.nullif(value, F.lit(""))


def is_true(value: Column) -> Column:
    """Only the word `true` counts, in any case and with blanks around it."""
    return F.coalesce(F.lower(strip(value)) == "true", F.lit(False))


def append(value: Column, item: Column) -> Column:
    """Add an item to a comma list that may be absent or empty."""
    return F.concat_ws(",", present(value), item)


def items(value: Column) -> Column:
    """Entries of a comma list, without the blanks around them."""
    return F.transform(F.split(value, ","), strip)


def pairs(value: Column) -> Column:
    """The key=value entries of a comma list, split at their first `=`."""
    entries = F.filter(items(value), lambda item: item.contains("="))
    return F.transform(
        entries,
        lambda item: F.struct(
            F.substring_index(item, "=", 1).alias("key"),
            F.regexp_extract(item, "(?s)^[^=]*=(.*)$", 1).alias("value"),
        ),
    )


def as_int(value: Column, default: int) -> Column:
    """A whole number; the default when absent or not a number."""
    return F.coalesce(value.try_cast("bigint"), F.lit(default).cast("bigint"))


def as_float(value: Column, default: float) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def is_bad(value: Column, kind: str) -> Column:
    """Present, but not readable as the type, so the default was taken."""
    return value.isNotNull() & value.try_cast(kind).isNull()


def is_listed(name: Column, names: Column) -> Column:
    """Whether a comma list holds a name or the wildcard `*`."""
    listed = items(names)
    return F.coalesce(
        F.array_contains(listed, F.lit("*")) | F.array_contains(listed, name), F.lit(False)
    )
