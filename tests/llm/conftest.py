from __future__ import annotations

import random

import pytest

#: Columns of ``documents`` and some that clash with names the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, chunk long, words string, kept boolean, fp long, key string, line string, `odd name` string")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = "an ble ca do er fi go ha in ka lo mi no or pa re sa ti un ve".split()
    out = []
    for i in range(n):
        out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))))
        if rng.random() < 0.1:
            out[-1] += ".\n" if rng.random() < 0.5 else ","
    return " ".join(out)


def edge_rows() -> list[tuple]:
    """Null and empty texts, null ids, repeated rows, ties, one very long text, odd white space."""
    base = prose(1, 200)
    texts = [
        (1, base), (1, base),                       # equal rows
        (2, base), (3, prose(2, 300)), (3, prose(3, 120)),   # a copy; one id twice
        (4, None), (5, ""), (6, " \n\t "), (None, prose(4, 80)), (None, None),
        (7, "one"), (8, "a b c d"), (9, "same same same same same same same same same same same same"),
        (10, prose(5, 60_000)),                     # very long
        (11, "tab\tand nbsp  two   three\n\n  é ü 漢字 \x1c \x0b \r\n end "),
        (12, "no trailing newline\nno trailing newline\n\n"),
        (13, prose(6, 400) + "\n" + prose(2, 300)),
    ]
    return [(i, t, "en", f"src{n % 5}" if n % 4 else None, None if t is None else len(t),
             "r", 5, "w", None, 7, "k", None, "o") for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample_docs(spark):
    """The first documents of the smallest test table, as rows."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
