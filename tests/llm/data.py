"""Small tables with the cases every operator has to stand."""

from __future__ import annotations

import random

EXTRA = "bucket string, label int, term string, words string, kept string, n string, fp string, _row int, covers int"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
WORDS = "the of and river stone under light house seven walking paper window garden silver morning bread".split()


def sentence(pick: random.Random, n: int) -> str:
    return " ".join(pick.choice(WORDS) + pick.choice("abcdefgh") for _ in range(n))


def edge_rows() -> list[tuple]:
    pick = random.Random(7)
    long = "\n".join(sentence(pick, 12) for _ in range(400))
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, long), (6, long), (7, "Ünïcode ÀÉ ▁ é x \x00 \U0001f600"),
        (8, sentence(pick, 60)), (8, None), (9, sentence(pick, 60)), (9, None), (None, sentence(pick, 70)), (None, None),
        (10, "x" * 5000), (11, "a b " * 2000),
    ]
    texts.append(texts[7])
    return texts


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *["x", 1, None, "x", "x", "x", "x", 1, 1]) for i, t in rows], SCHEMA)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")
