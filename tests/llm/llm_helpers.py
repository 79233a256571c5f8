"""Rows and frames that the operator tests share."""

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


def edge_rows():
    """Nulls in every column, empty, long, repeated and tied rows."""
    words = " ".join(f"word{i}" for i in range(30_000))
    return [
        (1, "Alpha beta gamma. Delta epsilon zeta", "en", "a", 36),
        (2, "Alpha beta gamma. Delta epsilon zeta", "en", "a", 36),
        (2, "Alpha beta gamma. Delta epsilon zeta", "en", "a", 36),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, words, "en", "b", len(words)),
        (None, "no id here", "de", None, 10),
        (6, " \t\n ", "de", "c", 4),
        (7, "x", None, "c", 1),
    ]
