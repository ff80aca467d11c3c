"""Small tables with the awkward cases: nulls, empty texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row int, size int, digest string, spans int"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows() -> list[tuple[int | None, str | None, str | None, str | None]]:
    base = words(1, 120)
    edited = base.split()
    edited[60] = "changed"
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(edited), "en", "b"),
        (4, words(2, 90), "de", None),
        (5, None, None, "b"),
        (6, "", "en", "b"),
        (7, "   \n\t ", "en", "c"),
        (None, words(3, 30), "de", "c"),
        (8, "12 34 !? 56", "en", "c"),
        (9, words(4, 6000), "de", "d"),
        (10, "one two", None, "d"),
        (11, "é😀 " * 150, "fr", "é"),
    ]


def documents(spark, some=None):
    some = rows() if some is None else some
    full = [(i, t, lang, s, len(t or ""), "k", 7, 7, "d", 7) for i, t, lang, s in some]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return documents(spark, [])
