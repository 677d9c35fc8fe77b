import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, ties, repeated rows and a column that clashes with inner names."""
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "same text here for all of us", "y"), (4, "Same Text here for all of us", None),
        (4, "Same Text here for all of us", None), (None, "same text here for all of us", "z"), (7, "é É ÉCOLE", "z"),
        (8, "É É école", "z"), (9, "w" * 50_000 + " tail " * 3000, "z"), (10, "w" * 50_000 + " tail " * 3000, "y"),
        (11, "w" * 50_000 + " tail " * 2999 + "end", "y"), (12, "   \n\t ", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, text_sha256 string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, kept int")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")

