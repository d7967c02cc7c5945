from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHING = ("_id", "_text", "runs", "rank", "task", "ids", "bucket", "place", "class", "a", "b", "n", "score")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, blank lines, and extra columns."""
    passage = " ".join(f"wort{i}" for i in range(60))
    secret = "password=0123456789abcdef0123456789abcdef01"
    texts = [
        (1, f"one two three four five six seven eight nine ten eleven\n{passage}\nlast line"),
        (2, f"{passage}\nanother end with other words"),
        (2, f"{passage}\nanother end with other words"),
        (3, None),
        (4, ""),
        (5, "\n\n\n"),
        (6, "x"),
        (7, f"{secret}\n{passage}\n\n{passage}"),
        (8, "long " * 60_000 + "\n" + passage),
        (9, "ÀÉ ß 漢字   <|endoftext|> \x00 end"),
        (9, "another text of the same id, which is odd"),
        (None, f"{passage}\nno id"),
        (None, None),
        (10, passage + " more"),
        (11, passage + " other"),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "src", None) for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(sf_dir, spark):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """{id: text} of the small table."""
    return {row["doc_id"]: row["text"] for row in documents.select("doc_id", "text").collect()}
