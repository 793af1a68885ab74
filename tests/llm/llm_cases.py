"""Rows that every operator has to handle, and helpers."""

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, uid bigint, gid bigint, score double, "
          "n_tokens string, component_id string, n_lines string, n_removed string, kept string, bucket string, node string, fp string")
LONG = " ".join(f"word{i % 997} and{i}" for i in range(30000))
TEXTS = [None, "", " ", "\n\n \t", "one", "two words", "Ünïcödé ß 字 <|endoftext|> x  y   z\r\n", "12 34", "a\x00b", LONG,
         "the same line\nanother line\nthe same line\nanother line\n", "same text of several words here", "same text of several words here"]


def edge(spark, more=()):
    """Null in every column, empty and long texts, ties and repeated rows, clashing column names."""
    rows = [(i, t, ["en", None][i % 2], None, None, *[None] * 11) for i, t in enumerate(TEXTS)]
    rows += [(None, "null id text with words", None, None, None, *[None] * 11), (None, None, None, None, None, *[None] * 11)]
    rows += [rows[5], rows[5], *more]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}
