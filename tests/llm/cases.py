"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: columns whose names an operator might use itself
CLASHING = ", key string, part int, bucket int, score string, node string, label string, ids string, bytes int, pos string, row int"


def words(seed: int, n: int, letters: str = "abcdefghijklmnopqrstuvwxyz") -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    return " ".join(words(seed, n))


def rows() -> list[tuple]:
    """Nulls in any column, empty, blank and long texts, copies, ties and repeated rows."""
    shared = prose(1, 40)
    near = prose(2, 120).split()
    other = [*near[:60], "changed", *near[61:]]
    out = [
        (1, shared, "en", "a"), (2, shared, "en", "a"), (3, None, None, None), (4, "", "en", "a"), (5, "   \n ", None, "b"),
        (6, "one", "de", "b"), (7, " ".join(near), "en", None), (8, " ".join(other), "en", "c"), (9, prose(3, 30) + " " + shared + " " + prose(4, 30), None, "c"),
        (10, "äöü " * 30 + "ß", "de", "c"), (10, "äöü " * 30 + "ß", "de", "c"), (11, "123 !!! 　", "fr", "a"), (12, prose(5, 30_000), "en", "a"),
        (-7, "minus " + shared, "en", "a"), (None, prose(6, 50), "en", "a"), (None, None, None, None), (13, "\U0001f600 ok \U0001f601 <|endoftext|> x", "en", "a"),
        (14, "x" * 3000, None, "z"), (15, "aé" * 400, "fr", "z"),
    ]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in out]


def documents(spark, clash: bool = False):
    if clash:
        return spark.createDataFrame([(*r, "k", 1, 2, "s", "n", "l", "i", 3, "p", 4) for r in rows()], SHAPE + CLASHING)
    return spark.createDataFrame(rows(), SHAPE)


def nothing(spark):
    return spark.createDataFrame([], SHAPE)
