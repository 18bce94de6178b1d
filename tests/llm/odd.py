"""Small tables with everything that is odd: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, k long, n long, uid long, "
    "range int, key long, copies long, bits binary, h long, places string, target double, tokens string, `_id` long"
)
CLASH = (7, 7, 7, 7, 7, 7, 7, b"x", 7, "x", 7.0, "x", 7)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(2, 40)
    rows: list[tuple[int | None, str | None]] = [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, None),
        (7, " \n\t "),
        (8, "One two three"),
        (9, "ONE  two\nthree"),
        (10, prose(3, 30) + " " + passage + " " + prose(4, 30)),
        (11, prose(5, 30) + " " + passage + " " + prose(6, 30)),
        (12, passage + " " + passage),
        (13, prose(7, 6000)),
        (14, "é" * 500 + " ñ 漢字 \x00 \x1c end. Next\n\nSection. Two\nthree"),
        (15, "x" * 350),
        (16, "x" * 99),
        (17, base),
        (17, base),
        (17, passage),
        (None, passage + " " + prose(8, 10)),
        (None, "short"),
        (-5, base.upper()),
        (1 << 40, prose(9, 5)),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    sources = ["a", None, "b", "a", "Z"]
    full = [(d, t, "en", sources[i % 5], len(t or ""), *CLASH) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def fixture_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
