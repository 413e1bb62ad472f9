"""Rows that every operator must stand."""

from __future__ import annotations

import random

WORDS = ("stone river lamp green seven cloud paper ring fast lower begin often island cover table "
         "music north winter yellow garden silver people travel simple number letter").split()
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(50)) for _ in range(n))


def hard_documents() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies."""
    base = [prose(i, 60) for i in range(12)]
    texts = [*base, base[0], base[0], " ".join(["changed", *base[1].split()[1:]]), None, "", "  \n\t ",
             "one two", "ONE TWO", "é😀 " + prose(50, 80), prose(51, 20000), "x" * 3000,
             "\n".join([base[2], base[3], base[2]]), "a▁b  c \u0000d"]
    rows = [(i, t, "en", f"src{i % 3}" if i % 4 else None, None if t is None else len(t))
            for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (500, None, None, None, None)]


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(parts)


def clashing(docs):
    """The same rows with further columns that carry the operators' own names."""
    from pyspark.sql import functions as F

    names = ("n_words kept score sig node tokens component_id size target taken key bucket part spans base "
             "starts ends places id hash vector rank variant y kept0").split()
    return docs.withColumns({n: F.lit("clash") for n in names})


def nothing(docs):
    return docs.where("false")
