import random

import pytest

from opinara.operators.scoring import ship_package

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, score string, "
    "kept string, t string, row string, component string, spans string, removed string, size string"
)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def prose(seed, n, words=400):
    """n made-up words, the same for the same seed."""
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}x{r.randrange(words)}" for _ in range(n))


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text[, lang, source]) rows, with further columns of clashing names."""

    def build(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", 0, *["x"] * 9)
            for r in rows
        ]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return build


ODD_ROWS = [
    (None, None, None, None),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "| 12 $$ --"),
    (6, "été \U0001f600 ЖЖ"),
    (7, prose(7, 60), None, "a"),
    (7, prose(7, 60), None, "a"),
    (None, prose(8, 60), "fr", None),
    (9, prose(9, 30_000), "de", ""),
    (10, "Same line here.\n" * 50),
]
