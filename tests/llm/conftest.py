import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def prose(seed: int, size: int, words: str = "abcdefghij") -> str:
    chance = random.Random(seed)
    return " ".join("".join(chance.choice(words) for _ in range(chance.randint(1, 6))) for _ in range(size))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    long = prose(1, 30_000)
    return [
        (1, prose(2, 60), "en", "src1", 5),
        (2, prose(3, 60, "klmnopqrst"), "de", "src2", 5),
        (3, None, "en", "src1", None),
        (4, "", "en", None, 0),
        (5, " \n\t\r\x0b\f ", None, "src1", 7),
        (6, long, "en", "src1", len(long)),
        (7, prose(2, 60), "en", "src1", 5),
        (7, prose(2, 60), "en", "src1", 5),
        (None, prose(4, 30), "en", "src2", 5),
        (9, None, None, None, None),
        (10, "Ünïcode ÄÖ 日本語 tekst é x 😀 A", "de", "src2", 1),
        (11, "a b", "en", "src1", 3),
        (12, "!!! ??? 123 456", "en", "src1", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
