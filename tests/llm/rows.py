"""Small tables with the awkward cases every operator must take."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} runs{i % 13}." for i in range(30000))

AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "one two three four five six seven"),
    (6, "one two three four five six seven"), (7, "One  two three\nfour five six seven"),
    (8, LONG), (9, LONG + " end"), (10, "été à la mer \U0001f600 12345 　"), (None, "no id here"),
    (5, "one two three four five six seven"), (11, "x" * 5000), (12, "\x00 odd \x1f bytes"),
]


def documents(spark: SparkSession, rows) -> DataFrame:
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    return documents(spark, AWKWARD)


def clashing(spark: SparkSession) -> DataFrame:
    """The awkward rows with further columns named like those that operators make."""
    extra = ["fingerprint", "bits", "score", "kept", "keep_id", "size", "bucket", "hash",
             "chunk", "node", "component", "label", "count", "dropped_id", "payload", "rows"]
    return awkward(spark).selectExpr("*", *[f"'mine' AS `{name}`" for name in extra])


def collected(rows: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in rows.collect()), key=repr)
