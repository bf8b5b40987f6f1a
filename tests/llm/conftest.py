import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


ODD = ["", None, "a", " \t\n ", "word " * 3000, "ünï çödé 日本語 😀 <|endoftext|> x\x0by\x1cz", "same text here", "same text here", "x" * 5000, "it's 1234 TIMES, don't!\n\nit's"]


@pytest.fixture
def odd(spark):
    """Null and repeated ids, null, empty, repeated and long texts, and columns with names that operators use."""
    rows = [(i if i != 3 else None, t, "en", i, "z") for i, t in enumerate(ODD)] + [(6, "same text here", "en", 1, "y"), (6, "another text", "en", 1, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, rid int, length string")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, rid int")
