import random

import pytest

from tillroll.llm.common import read_table

SF = "/root/testdata/sf0.001"
CLASHING = "n node prefix sid kept score text_hash words bin piece part label row_id slot y html".split()


@pytest.fixture(scope="session")
def documents(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="session")
def labels(spark):
    return read_table(spark, SF, "labels")


def with_clashes(frame):
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHING if name not in frame.columns})


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Null, empty, blank, one-word, very long and repeated texts, a null identifier, clashing columns."""
    rng = random.Random(7)
    long_text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(60_000))
    plain = "the quick brown fox jumps over the lazy dog and runs away from all of it " * 6
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, "word"),
        (5, plain),
        (5, plain),
        (6, plain.upper()),
        (7, long_text),
        (8, long_text + " tail"),
        (None, plain),
        (None, None),
        (9, "one two three four"),
        (10, "ONE two\tthree\nfour"),
    ]
    table = spark.createDataFrame(
        [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return with_clashes(table)


@pytest.fixture(scope="session")
def no_documents(edge_documents):
    return edge_documents.limit(0)
