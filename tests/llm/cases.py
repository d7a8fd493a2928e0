"""Rows that every operator has to bear: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997} runs on" for i in range(40_000))
ROWS = [
    (1, "The first text of all.\nIt has two lines, both long enough.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b ", "en", "b"),
    (5, "Eine kurze Zeile.", "de", "b"),
    (6, LONG, "en", "b"),
    (7, "The first text of all.\nIt has two lines, both long enough.", "en", "c"),
    (7, "The first text of all.\nIt has two lines, both long enough.", "en", "c"),
    (None, "A text without an id, but with words in it.", "en", None),
    (8, "12 34 !? \U0001f600", None, "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ["_id", "_row", "row", "fp", "fingerprint", "component_id", "size", "copies", "bucket", "n_tokens", "spans", "owner", "h1", "line", "score", "a", "b"]


def edge_rows(spark):
    """The rows above, with columns whose names operators use themselves."""
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
