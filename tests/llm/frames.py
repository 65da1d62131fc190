"""Small tables for the operator tests: the corners every operator has a result for."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = ("amber basin cedar delta ember fjord grove haven islet jetty knoll ledge marsh north orbit plain quarry ridge "
         "shore tide umber vale weir xylem yield zephyr").split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 2654435761 % (1 << 32)
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % (1 << 32)
        out.append(WORDS[(x >> 16) % len(WORDS)] + WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def corner_rows() -> list[tuple]:
    long = prose(99, 30_000)
    return [
        (1, prose(1, 60), "en", "a", 1), (2, prose(2, 80), "en", "a", 1), (3, prose(1, 60), "en", "b", 1),
        (4, None, "en", "b", None), (5, "", None, None, 0), (6, " \n\t ", "en", None, 3),
        (7, "one", "en", "é", 3), (8, long, "en", "a", len(long)), (8, long, "en", "a", len(long)),
        (9, "Two words", "en", "Z", 9), (None, "no id here at all", "en", "a", 1), (None, None, None, None, None),
        (2, "another text with the id two", "de", "b", 1),
    ]


def corners(spark):
    """The rows, and columns whose names operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(corner_rows(), DOCS)
    return df.withColumns({c: F.lit("clash") for c in (
        "_row", "_part", "_tie", "h", "f", "t", "r", "size", "rank", "score", "words", "host", "n_words", "ids", "label", "item")})


def empty(spark, schema: str = DOCS):
    return spark.createDataFrame([], schema)
