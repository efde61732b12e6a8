"""Small tables with the awkward rows that every corpus operator must take."""

from __future__ import annotations

LONG = " ".join(f"word{k % 977} other{k % 31}" for k in range(60_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "fr", "b"),
    (5, "Le renard brun saute par-dessus le chien paresseux pres de la riviere.", "fr", "b"),
    (6, LONG, "en", "a"),
    (None, "A text without an id that still has enough words to be seen here.", None, "c"),
    (7, "1234 5678 !!! ###", "en", None),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *names):
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)
