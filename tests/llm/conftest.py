import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("ta", "lo", "min", "ser", "vo", "ka", "pre", "dul") for b in ("ra", "nit", "sem", "o", "gel")]


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) or (doc_id, text, source) as a documents table, over several partitions."""
    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return build


@pytest.fixture
def prose():
    """Deterministic invented text."""
    def write(seed, words, line=9):
        draw = random.Random(seed)
        out = [draw.choice(WORDS) + draw.choice(WORDS) for _ in range(words)]
        return "\n".join(" ".join(out[i:i + line]) for i in range(0, words, line))

    return write


#: Rows every operator has to take: nothing, blanks, no key, repeated rows, odd characters, one long word.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "no key at all"), (5, "same row"), (5, "same row"),
       (6, "é ß 漢字 \U0001f600 \x00 \x85"), (7, "x" * 5000), (8, "a\n\n\n\nb\n\n\n\nc"), (9, None)]


@pytest.fixture
def odd():
    return list(ODD)
