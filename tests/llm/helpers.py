"""Rows with the awkward cases that every operator has to survive, and small comparisons."""

from __future__ import annotations

import random

WORDS = "river stone garden letter window market summer bridge candle forest silver mountain harbour village morning".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "ed"]) for _ in range(n))


def awkward_documents(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, and columns with clashing names."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 80), "en"), (2, prose(2, 80), "en"), (3, None, "en"), (4, "", None), (5, long, "en"),
        (6, "x", "fr"), (7, prose(3, 80) + " " + prose(2, 80), None), (7, prose(3, 80) + " " + prose(2, 80), None),
        (None, prose(2, 80), "fr"), (8, "12 34 !!", "fr"), (9, "été à la plage " * 12, "fr"), (10, "a" * 5000, "en"),
        (11, prose(4, 60), "en"), (12, prose(5, 60), "en"), (13, prose(6, 60), "fr"),
    ]
    schema = ("doc_id long, text string, lang string, key string, part string, n long, score double, length int, "
              "rep string, c0 string, bucket string, block string")
    return spark.createDataFrame([(*r, "k", None, 1, 0.5, 3, "r", "c", "b", "l") for r in rows], schema)


def empty_documents(spark):
    return awkward_documents(spark).limit(0)
