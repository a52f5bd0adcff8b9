from __future__ import annotations

import pytest

# Empty texts, null keys and texts, repeated rows, a long one, and columns whose names clash
# with those the operators use inside.
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from the old mill"),
    (1, "The quick brown fox jumps over the lazy dog and runs far away from the old mill"),
    (2, ""),
    (3, None),
    (None, "a null id"),
    (None, None),
    (4, "  \t\n "),
    (5, "word " * 30_000),
    (6, "x" * 100_000),
    (7, "mail me at someone@example.com or +1 (389) 555-5010\x01 😀 é ▁ <s>"),
]
CLASHES = ["size", "class", "text_key", "digest", "kind", "shard", "part", "rows"]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(key, text, *range(len(CLASHES))) for key, text in ODD_TEXTS]
    schema = "doc_id long, text string, " + ", ".join(f"`{name}` int" for name in CLASHES)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
