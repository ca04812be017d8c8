"""Small tables for the text operators."""

import random

#: A null and an empty text, no words, one word, white space of all kinds, odd letters, a null id, a repeated row.
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (5, "two words"), (6, "Ünïcode ÉÀ x é 漢字 😀"), (None, "no id at all"), (7, "again again"), (7, "again again"), (8, "x" * 5000)]
SCHEMA = "doc_id bigint, text string"


def odd(spark, extra=False):
    """The odd rows, with columns whose names the operators use inside if ``extra``."""
    if not extra:
        return spark.createDataFrame(ODD, SCHEMA)
    names = "text_hash string, words int, row string, score string, component_id int, n_words string, blocks int, y int, fp int, spans int, hits int, n_chars bigint, lang string, source string"
    fill = ["a", 1, "b", "c", 2, "d", 3, 4, 5, 6, 7, 8, "e", "f"]
    return spark.createDataFrame([(*row, *fill) for row in ODD], f"{SCHEMA}, {names}")


def prose(dice: random.Random, n: int, words=None) -> str:
    words = words or ["alpha", "beta", "gamma", "delta", "rho", "tau", "pi", "omega", "und", "der", "el", "la"]
    return " ".join(dice.choice(words) for _ in range(n))
