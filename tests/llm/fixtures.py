"""Small document tables with every awkward case, and whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, h1 string, band string, size long, row string, kept string, a string"
)
#: Extra columns share names with ones the operators use inside.
EXTRA = (1, "x", "y", 7, "z", "w", "v")


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text, lang, source) as documents with clashing extra columns."""
    whole = [(i, t, g, s, None if t is None else len(t), *EXTRA) for i, t, g, s in rows]
    return spark.createDataFrame(whole, SCHEMA)


LONG = " ".join(f"word{i % 977} stuff{i % 31}" for i in range(60_000))
AWKWARD = [
    (0, None, "en", "s"),
    (1, "", "en", "s"),
    (2, " \t\n ", None, None),
    (3, "One two three.", "en", None),
    (3, "One two three.", "en", None),
    (4, "One two three.", "fr", "t"),
    (5, "Ünïcödé\r\nline İstanbul ΣΑΣ 中文   12½\x1c!\x0b\x0c x  y\n\n\n z", "de", "t"),
    (6, LONG, "en", "u"),
    (None, "no id here, but some words", "en", "u"),
    (None, None, None, None),
    (7, "<|endoftext|>mid<|endoftext|> <|startoftext|>", "es", "S"),
    (8, "é café \U0001f600\U0001f468‍\U0001f469 it's WE'LL 1234567", "fr", "s"),
    (9, "a" * 5000 + " " + "b" * 3, "fr", "s"),
]
