"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    base = [
        (1, "Alpha beta gamma delta epsilon zeta.\nShared line here\nEnd one", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, "   \n\t \n", "en", "b", 7),
        (None, "Text without an id\nShared line here", "en", "a", 5),
        (5, LONG, "en", "a", len(LONG)),
        (6, "Alpha beta gamma delta epsilon zeta.\nShared line here\nEnd one", "en", "c", 10),
        (6, "Alpha beta gamma delta epsilon zeta.\nShared line here\nEnd one", "en", "c", 10),
        (7, "Ünïcödé 😀 text\r\nwith odd\x1cspace <|endoftext|> and 12", "de", "c", 3),
        (9, "x", "en", None, 1),
        (10, "\n\n\n", "en", "c", 3),
    ]
    return base


def edge_docs(spark, clash=()):
    """The rows, with extra columns of the given names."""
    df = spark.createDataFrame(rows(), SCHEMA)
    for c in clash:
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
