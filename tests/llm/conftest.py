import random

import pytest

from tidemark.llm.common import prepare

# Names that the operators use inside; the input's own columns of these names must not disturb them.
CLASHING = ("rid", "ord", "gid", "hash", "key", "label", "group", "rest", "unit", "blob", "spans", "score", "bands", "place", "n")


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def make(llm):
    """A documents table in several partitions, with clashing extra columns of null."""
    def build(rows, parts=3):
        from pyspark.sql import functions as F
        df = llm.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string")
        return df.withColumns({c: F.lit(None).cast("string") for c in CLASHING}).repartition(parts)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, equal ids with other texts, a long text, rare characters."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 7)))
    long = " ".join(word() for _ in range(9000))
    return [(None, None), (None, "solo text"), (1, None), (2, ""), (3, " "), (4, "Same Text"), (4, "Same Text"), (4, "other"),
            (5, "same text"), (6, "SAME TEXT"), (7, long), (8, long), (9, "tabs\tand\r\nbreaks  two\n\nlines \n x"),
            (10, "▁ odd \x00 ﷽ 😀 é"), (11, "x" * 70000), (-3, "negative id"), (12, "\n"), (13, "İSTANBUL ſK")]
