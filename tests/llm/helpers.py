"""Small tables for the operators' tests."""


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BENCHMARK = "item_id bigint, text string"
# Clashing names of every kind that the operators use inside.
EXTRA = ["_lines", "_n", "fingerprint", "items", "_found", "_of_row", "start", "queue", "kept"]


def documents(spark, texts, lang="en", source="s"):
    rows = [(k, t, lang, source, len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def awkward(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, "  \n \t", None, None, 5),
        (4, long, "en", None, len(long)),
        (5, "tie tie tie", None, "b", 11),
        (5, "tie tie tie", None, "b", 11),
        (None, "no id here\nno id here", "de", "b", 21),
        (6, "été 日本 ünïcode\nline", "fr", "b", 21),
    ]
    return with_extra(spark.createDataFrame(rows, DOCUMENTS))


def with_extra(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(name) for name in EXTRA})


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def bag(df, *columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))
