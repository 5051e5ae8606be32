"""Rows every operator must cope with."""

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, block int, `a.b` int"


def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = "word " * 40_000 + "end"
    body = "one two three four five six seven eight nine ten " * 6
    rows = [
        (1, body, "en", "a", 1, 0.5, "x", 3),
        (1, body, "en", "a", 1, 0.5, "x", 3),
        (2, body.upper(), "en", "a", 1, None, None, None),
        (3, None, "en", "b", 0, 0.1, "y", 1),
        (4, "", None, "b", 0, 0.1, "y", 1),
        (5, " \t\n\x0b\x0c\r ", "de", None, 7, 0.1, "y", 1),
        (6, long, "de", "b", None, 0.1, "y", 1),
        (7, "é中\U0001F600 'tis 12,5 # $ ~", "fr", "c", 20, 0.1, "y", 1),
        (None, "no id here", "fr", "c", 10, 0.1, "y", 1),
        (None, "no id here", "fr", "c", 10, 0.1, "y", 1),
        (8, "two words", "en", "a", 9, 0.1, "y", 1),
        (9, "line\nline\n\nline two\nline", "en", "a", 9, 0.1, "y", 1),
    ]
    return [(*row, i % 3) for i, row in enumerate(rows)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
