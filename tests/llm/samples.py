"""Small document tables for the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta river stone house green light paper cloud table north south bread".split()
#: Names that operators use inside.
CLASH = "row size _id _at _src h n c w l lost stays x token text_hash score held_out kept target weight level".split()


def table(spark, rows, extra=()):
    """(doc_id, text[, lang, source]) rows as documents; ``extra`` adds columns of these names."""
    full = [(r[0], r[1], *(list(r[2:]) + ["en", "src0"][len(r) - 2:]), len(r[1] or "")) for r in rows]
    schema = SCHEMA + "".join(f", `{x}` string" for x in extra)
    return spark.createDataFrame([r + ("other",) * len(extra) for r in full], schema)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def edge_rows():
    """Nulls, empty and very long texts, repeated rows."""
    rng = random.Random(7)
    long = "\n".join(prose(rng, 40) for _ in range(1500))
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, long), (6, "a b c d"), (6, "a b c d"), (7, long),
        (None, "a text without an id of its own but with more than five words"), (None, None), (8, "é漢字 🙂 ﬀ \x1c x"),
        (9, prose(rng, 30), None, None), (9, prose(rng, 30), "fr", "src1"), (10, "\n\n\n"),
    ]
