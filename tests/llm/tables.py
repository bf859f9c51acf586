"""Small tables with everything that should not break an operator."""

import random

SCHEMA = "doc_id long, text string, lang string, class string, digest string, row string, `a.b` string"
WORDS = "the of and to in a that is was for on with by be this from or had not are but an they".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = WORDS + ["".join(rng.choices("abcdefghij", k=5)) for _ in range(200)]
    return " ".join(rng.choices(made, k=words))


def rows() -> list[tuple]:
    """`(doc_id, text)`: copies, near copies, repeats, nulls, blanks, a long text."""
    base, other = prose(1, 120), prose(2, 150)
    long = prose(3, 9000)
    texts = [
        (1, base),
        (2, base.upper()),
        (3, base),
        (4, base.replace(" the ", " one ", 1)),
        (5, other),
        (6, other + " end"),
        (7, None),
        (8, ""),
        (9, "   \t\n "),
        (10, "one"),
        (11, "ONE"),
        (12, "two words"),
        (13, long),
        (14, prose(4, 60) + " " + long[500:1200] + " " + prose(5, 60)),
        (15, "Öl für Ñandú ́ ſ ﬁ 日本語 🎉 <|endoftext|> it's 12½"),
        (16, "Du " * 400),
        (17, base),
        (17, base),  # the row again
        (18, prose(6, 80)),
        (18, prose(7, 80)),  # the id again, with another text
        (None, prose(8, 80)),
        (None, None),
        (None, base),
        (19, "x" * 5000),
    ]
    return texts


def table(spark, texts=None):
    texts = rows() if texts is None else texts
    full = [(i, t, "en", "c", None, "r", "ab") for i, t in texts]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
