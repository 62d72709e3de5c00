import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

#: Nulls, empty and very long texts, ties, repeated rows, and columns whose names results use too.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept boolean, node long, spans int"


@pytest.fixture(scope="session")
def odd(spark):
    long_text = " ".join(f"w{i % 997}" for i in range(30_000))
    texts = [
        None, "", " \t\n", "one", "One two", "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p q",
        "a b c d e f g h i j k l m n o p", "x " * 200, long_text, long_text + " tail", "ünï cødé 你好 <|endoftext|> 's",
    ]
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None, 7, 1, False, 3, 5) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "a b c d e f g h i j k l m n o p", None, None, None, 1, 1, True, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
