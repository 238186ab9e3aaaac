"""Small frames with every awkward row: nulls, empty and long texts, copies,
ties, repeated rows and extra columns with clashing names."""

import pytest

WORDS = "the cat and a dog of one house by some river in old town with many trees for each rainy day".split()


def sentence(seed: int, n: int) -> str:
    state, out = seed * 2654435761 % 2 ** 32 + 1, []
    for _ in range(n):
        state = (1103515245 * state + 12345) % 2 ** 31
        out.append(WORDS[state >> 16 & 15] + ("" if state % 3 else str(state % 97)))
    return " ".join(out)


ROWS = [
    (1, sentence(1, 60)), (2, sentence(1, 60)),  # equal texts
    (3, sentence(1, 60) + " tail"), (4, sentence(4, 30)), (5, None), (6, ""), (7, "   "), (8, "one"),
    (9, "Released under the MIT License.\nCC BY and the Apache License"), (10, sentence(10, 20000)),  # long
    (11, "Ünïcödé – 漢字 \U0001f642 <|endoftext|> don't"), (None, sentence(12, 40)), (None, None),
    (13, sentence(13, 50)), (13, sentence(13, 50)),  # a repeated row
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, None if k % 5 == 0 else "en", [None, "a", "b"][k % 3], k, k, "x", k)
            for k, (i, t) in enumerate(ROWS)]
    # rank, component and the like are names that the operators use inside
    schema = "doc_id long, text string, lang string, source string, n_chars long, rank int, node string, component int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def table(spark):
    """Rows of a table of the smallest test data as a frame."""
    def read(name, sf="0.001"):
        return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
    return read
