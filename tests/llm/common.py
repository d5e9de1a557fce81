"""Small tables for the tests: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """(doc_id, text[, lang]) rows as documents, with columns that clash with the operators' own names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    return df.selectExpr("*", "1 AS rid", "2 AS tag", "'x' AS kept", "3 AS component_id", "4 AS length", "5 AS n_words", "6 AS data", "7 AS chunk", "8 AS held_out", "9 AS sequence_id")


def empty(spark):
    return documents(spark, [(1, "x")]).where("doc_id < 0")


def prose(n, seed=0, words=("alpha", "beta", "gamma", "delta", "of", "the", "and", "Epsilon", "zeta,", "eta.", "theta")):
    r = random.Random(seed)
    return " ".join(r.choice(words) + (str(r.randrange(50)) if r.random() < 0.3 else "") for _ in range(n))


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "two words"), (6, "A b C"), (7, "a B c"),
    (8, prose(400, 1)), (9, prose(400, 1)), (10, prose(60000, 2)), (11, prose(60000, 2)), (12, prose(400, 1) + "."),
    (13, "same row"), (13, "same row"), (14, "one id"), (14, "two texts"), (None, "no id"), (None, "no id"), (None, None),
    (15, "é ß 日本語 𝔘 \x00   x"), (16, "x" * 70000), (17, "no id"), (18, "end <|endoftext|>of text"),
]
