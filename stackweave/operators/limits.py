"""Limits on span links and attribute values. An empty limit means no limit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits in force when nothing is configured.
LINK_LIMIT = "1000"
VALUE_LENGTH_LIMIT = "12000"


def _number(limit: str | int | None) -> int | None:
    text = "" if limit is None else str(limit).strip()
    return int(text) if text else None


def limit_links(links: Column, limit: str | int | None = LINK_LIMIT) -> Column:
    """The first links of a span, up to the limit."""
    count = _number(limit)
    return links if count is None else F.slice(links, F.lit(1), F.lit(count))


def limit_values(attributes: Column, limit: str | int | None = VALUE_LENGTH_LIMIT) -> Column:
    """Attribute values cut to the limit, in characters."""
    length = _number(limit)
    if length is None:
        return attributes
    return F.transform_values(attributes, lambda _, value: F.substring(value, 1, length))
