"""Resource attributes: encoding mixed types and telling identifying ones apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The attributes that identify a process.
IDENTIFYING = ("service.name", "service.namespace", "service.instance.id")

SCALARS = ("string", "bool", "int", "float", "bytes")


def _list_json() -> Column:
    """A list as compact JSON: text quoted, numbers and booleans bare, missing items null."""
    text = F.to_json("items", {"writeNonAsciiCharacterAsCodePoint": "true"})
    bare = F.concat(F.lit("["), F.array_join("items", ",", "null"), F.lit("]"))
    return F.when(F.col("item_type") == "string", text).otherwise(bare)


def encode(attributes: DataFrame) -> DataFrame:
    """Scalars stay, lists become text, and everything else is dropped.

    Rows are (..., key, type, value, item_type, items).
    """
    is_list = F.col("type") == "list"
    return (
        attributes.filter(F.col("type").isin(*SCALARS) | (is_list & F.col("items").isNotNull()))
        .withColumn("value", F.when(is_list, _list_json()).otherwise(F.col("value")))
        .withColumn("type", F.when(is_list, F.lit("string")).otherwise(F.col("type")))
        .drop("item_type", "items")
    )


# Variant types, by how their names start, and what they are called here.
VARIANT_KINDS = (
    ("ARRAY", "list"), ("OBJECT", "map"), ("STRING", "string"), ("BOOLEAN", "bool"), ("BIGINT", "int"), ("DECIMAL", "float"),
    ("DOUBLE", "float"), ("FLOAT", "float"), ("BINARY", "bytes"),
)


def _kind(value: Column) -> Column:
    """What a variant holds, by its own schema; null for what none of the names covers."""
    schema, chosen = F.schema_of_variant(value), F.lit(None).cast("string")
    for start, kind in reversed(VARIANT_KINDS):
        chosen = F.when(schema.startswith(start), F.lit(kind)).otherwise(chosen)
    return chosen


def _ascii(json: Column) -> Column:
    """JSON with every other character escaped, as pairs of code units where one does not do."""
    def escaped(char: Column) -> Column:
        units = F.hex(F.encode(char, "UTF-16BE"))
        both = F.concat(F.lit("\\u"), F.substring(units, 1, 4), F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.substring(units, 5, 4))).otherwise(""))
        return F.when(F.octet_length(char) > 1, F.lower(both)).otherwise(char)

    letters = F.array_join(F.transform(F.split(json, ""), escaped), "")
    return F.when(F.octet_length(json) == F.length(json), json).otherwise(letters)


def encode_variants(attributes: DataFrame) -> DataFrame:
    """Rows (..., key, value VARIANT) to (..., key, type, value): scalars as text of their own type, lists
    as compact JSON in which every item keeps its type, nested lists and mappings included.

    A mapping by itself is dropped, and so is a list that holds bytes, as JSON has none.
    """
    kind = _kind(F.col("value"))
    binary = F.schema_of_variant("value").contains("BINARY")
    kept = attributes.withColumn("type", kind).filter(kind.isin(*SCALARS) | ((kind == "list") & ~binary))
    text = F.when(F.col("type") == "list", _ascii(F.to_json("value"))).when(
        F.col("type") == "bytes", F.base64(F.try_variant_get("value", "$", "binary"))
    ).otherwise(F.try_variant_get("value", "$", "string"))
    return kept.withColumns({"value": text, "type": F.when(F.col("type") == "list", "string").otherwise(F.col("type"))})


def unsupported_variants(attributes: DataFrame) -> DataFrame:
    """What `encode_variants` leaves out, with the warning it deserves."""
    kind = F.coalesce(_kind(F.col("value")), F.lit("none"))
    binary = F.coalesce(F.schema_of_variant("value").contains("BINARY"), F.lit(False))
    left = attributes.withColumn("type", kind).filter(~kind.isin(*SCALARS) & ((kind != "list") | binary))
    return left.withColumn("warning", F.format_string("attribute %s has unsupported type %s", "key", "type"))


def unsupported(attributes: DataFrame) -> DataFrame:
    """What `encode` leaves out, with the warning it deserves; a list without items is one."""
    known = F.col("type").isin(*SCALARS) | ((F.col("type") == "list") & F.col("items").isNotNull())
    return attributes.filter(~F.coalesce(known, F.lit(False))).withColumn(
        "warning", F.format_string("attribute %s has unsupported type %s", "key", "type")
    )


def identifying(attributes: Column) -> Column:
    return F.map_filter(attributes, lambda key, _: key.isin(*IDENTIFYING))


def describing(attributes: Column) -> Column:
    return F.map_filter(attributes, lambda key, _: ~key.isin(*IDENTIFYING))
