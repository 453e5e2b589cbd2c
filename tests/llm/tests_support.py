"""Rows with NULLs, empty and long texts, repeated ids and rows, and clashing column names."""

EDGE_TEXTS = [None, "", " ", "\n\n", "one", "a b c d e f g h i j", "x " * 5000, "a b c\x85d", "é ü\tñ\x0bß", "same line here now\nsame line here now\nother"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, target double, kept string, _id string, _row int"


def edge_docs(spark, texts=EDGE_TEXTS, repeat=True):
    rows = [(i, t, None, None, None, 1, 2.0, "x", "y", 3) for i, t in enumerate(texts)]
    rows += [(None, "a row without an id and ten words to have it", "en", "s", 1, None, None, None, None, None)]
    if repeat:
        rows += [rows[5], rows[5], (5, "another text with the same id", "en", "s", 3, 1, 1.0, "", "", 1)]
    return spark.createDataFrame(rows, SCHEMA)
