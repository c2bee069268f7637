"""Small tables that hold every awkward case, shared by the tests."""

import duckdb

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, copies long, row string, payload string, "
          "fingerprint long, component_id long, score double, rank int, cell int, keep_id long, tie long, id long, body string, part int")
EXTRA = (None,) * 14


def odd_rows():
    long_text = "Der lange Satz steht hier und endet nie. " * 20000
    rows = [
        (1, "One two three four five six seven eight nine ten", "en", "b"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n\x0b\f\r ", "de", "a"),
        (5, long_text, "de", "a"),
        (6, "One two three four five six seven eight nine ten", None, "b"),
        (6, "One two three four five six seven eight nine ten", None, "b"),
        (7, "12345 !!! 678", "en", None),
        (8, "Ünïcode  ñandú été <|endoftext|> 😀 \n x", "es", "c"),
        (None, "no id at all", "en", "b"),
        (9, "one", "en", "d"),
        (10, "a\x00b\x00c", None, "d"),
    ]
    return [(*r, len(r[1]) if r[1] is not None else None, *EXTRA) for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM read_parquet('{sf}/documents.parquet') ORDER BY doc_id").fetchall()
