"""Small tables with the rows that operators must take: nulls, empty and long texts,
repeated rows, and extra columns whose names clash with results."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, n_words int, length int"


def docs_of(spark, rows):
    """``rows``: (doc_id, text) pairs; the extra columns get values of their own."""
    return spark.createDataFrame([(i, t, "en", "s", 7, 0.5, "k", 3, 9) for i, t in rows], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
EDGE = [(None, "a row without an id but with some words in it"), (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "same text in two rows here"), (5, "same text in two rows here"), (6, "!!! ???")]
