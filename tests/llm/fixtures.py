"""Small tables of odd rows that every operator must take."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))


LONG = prose(99, 30_000)

# doc_id, text, and columns whose names clash with those operators use inside or give out.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, score string, hashes string, id long, comp long"
ODD = [
    (1, None, None, None),
    (2, "", "en", ""),
    (3, "   \n\n\t ", "en", "h1"),
    (4, "one", "en", "h1"),
    (5, prose(1, 80), "en", "h1"),
    (6, prose(1, 80), None, "h2"),
    (7, LONG, "en", "h2"),
    (8, "x" * 20_000, "de", "h2"),
    (8, "x" * 20_000, "de", "h2"),
    (None, prose(2, 60), "en", "h1"),
    (9, "\U0001f600 é ß 漢字 " + prose(3, 40), "en", None),
]


def documents(spark, rows=ODD):
    full = [(i, t, lang, host, len(t or ""), 7, "s", "h", 1, 2) for i, t, lang, host in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
