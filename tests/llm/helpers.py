"""Small fixtures that every operator must take without crashing."""

import random

from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    """Rows (doc_id, text, lang, source); n_chars follows."""
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCS)


def odd_docs(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows."""
    r = random.Random(5)
    words = ["alpha", "beta", "gamma", "Delta", "été", "naïve", "straße", "x.", "y,", "z\n"]
    long = " ".join(r.choice(words) for _ in range(30_000))
    rows = [(1, None, None, None), (None, "some text here", "en", "a"), (2, "", "en", None), (3, " \t\n", None, "b"),
            (4, "one", "en", "a"), (5, "One  two", "en", "a"), (6, long, "fr", "b"), (7, long, "fr", "b"),
            (8, "漢字 かな <|endoftext|> it's ''s", "xx", "c"), (9, "12345 !!! ???", "en", "c"),
            (10, "the same words again and again", "en", "a"), (10, "the same words again and again", "en", "a"),
            (11, "the same words again and again", "en", "a"), (None, None, None, None)]
    return docs_frame(spark, rows)


def with_clashes(df):
    """Extra columns whose names an operator may use inside."""
    from pyspark.sql import functions as F

    for name in ("fp", "key", "probe", "tokens", "n", "part", "length", "start", "rank", "task", "ord", "root", "node"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


__all__ = ["DOCS", "Row", "docs_frame", "odd_docs", "rows_of", "with_clashes"]
