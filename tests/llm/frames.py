"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, size int, `batch` string, score double"
PROSE = (
    "It was a quiet morning in the harbour and the boats lay still while the keeper of the light walked slowly down "
    "to the water with a basket of bread for the gulls that waited on the wall as they did on every day of the year"
)


def documents(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """rows: (doc_id, text, lang, source); the other columns clash with names used inside."""
    rows = EDGES if rows is None else rows
    full = [(i, t, lang, s, len(t) if t is not None else None, 7, 7, "x", 7.0) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


EDGES = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, "en", None), (4, "", None, "b"),
    (5, " \t\n ", "fr", "b"), (6, "!!! 12 ...", "de", None), (None, PROSE + " indeed", "en", "c"), (None, None, None, None),
    (7, "word " * 30_000, "en", "a"), (8, "x" * 100_000, "en", "d"), (9, "naïve \U0001f600 café " + PROSE, "fr", "a"),
]
