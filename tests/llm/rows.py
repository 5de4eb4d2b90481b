"""Rows that the tests of several operators share."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)], DOCUMENT)


def odd_documents(spark):
    """Null ids, texts and languages, empty and blank texts, repeated rows, and names that operators use inside."""
    rows = [
        (None, None, None, None, None), (None, "", "en", "s", 0), (1, " \t\n", "en", "s", 3), (2, None, "de", "s", None),
        (3, "one two three four five six seven eight nine ten " * 6, "xx", "s", 1), (3, "one two", "en", "s", 1),
        (4, "same words in here again and again", "en", "s", 1), (4, "same words in here again and again", "en", "s", 1),
        (None, "same words in here again and again", "en", "s", 1), (5, "naïve ☃ 𝔘nicode text é", None, "s", 1),
        (6, "x" * 3000 + " " + "word " * 3000, "en", "s", 1),
    ]
    extra = "language string, node bigint, chunk string, word string, text_key bigint, verdict string, k int, body string"
    return spark.createDataFrame(
        [(*r, "a", 1, "b", "c", 2, "d", 3, "e") for r in rows], f"{DOCUMENT}, {extra}")
