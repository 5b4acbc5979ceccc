"""Small documents tables with the cases every operator must bear."""

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, token string, nid long"


def documents(spark, rows):
    """rows: (doc_id, text); further columns are null or clash with names used inside the operators."""
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), 0.5, None, "x", 1) for i, t in rows], DOC)


def odd_rows(extra=()):
    long_text = " ".join(f"word{k % 997} and{k}" for k in range(30_000))
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (5, long_text), (None, "no id here at all"), (6, "é ü ß 日本 👍"), *extra]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
