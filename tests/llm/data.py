"""Rows that are awkward: nulls, nothing, very long texts, repeats, and columns named like the operators' own."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key long, score double, kept boolean, row string, "
    "mentions string, n long, words string, pack int, cell int, text_hash long"
)


def docs(spark, texts, lang="en"):
    rows = [(i, t, lang, "s", len(t or ""), 1, 0.5, True, "r", "m", 1, "w", 1, 1, 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed=1, words=80):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["the", "of", "river", "stone", "walks", "green", "slowly", "and", "house", "seven"]) for _ in range(words))


def awkward():
    """(doc_id, text)."""
    long = " ".join(prose(s, 500) + "." for s in range(120))
    return [
        (1, None), (2, ""), (3, " \n\t\x0b "), (4, "one"), (5, "one"), (5, "one"), (None, "one two"), (7, prose(7)), (8, prose(7)),
        (9, long), (10, "x" * 50_000), (11, "ß É  語   😀\n\n 12"), (12, "  spaces   and\n \nlines  "), (13, "\x1c \x85a"),
        (-4, "negative id " * 30),
    ]
