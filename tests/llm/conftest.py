import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, size long, __tg_x string"


@pytest.fixture(scope="session")
def odd_docs(spark, tmp_path_factory):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names operators use themselves."""
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here " * 12
    texts = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\r\x0b\x0c ", "en", "a"), (4, prose, "en", "a"), (5, prose.upper(), "en", "b"), (6, prose + "end", "en", "b"),
        (7, "one", None, "ä"), (8, "one two", "en", "𝒳"), (8, "one two", "en", "𝒳"), (None, "no id", "en", "a"), (None, "no id", "en", None),
        (9, "wörter " * 30000, "de", "b"), (10, "x" * 200000, "en", "b"), (11, "a b c � 中文 😀 İ ς Σ", "zz", "b"), (12, "▁▁ a  b ▁", "en", "c"),
        (13, "<|endoftext|> <s> </s> <|startoftext|>", "en", "c"), (-5, "negative id", "en", "c"), (2**62, "far id", "en", "c"),
    ]
    rows = [(i, t, l, s, len(t) if t else None, 7, 7, "x") for i, t, l, s in texts]
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def some_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
