import pytest
from kenning.llm.common import ready


@pytest.fixture(scope="session")
def lspark(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def docs(lspark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing column names."""
    base = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, base, "a"), (2, base.replace(" ", "\n"), "a"), (3, base + " ", None), (4, base, "x"), (4, base, "x"),
        (5, None, None), (6, "", "e"), (7, " \t\r\n", "e"), (None, "no id here", "n"), (None, None, None), (None, base, "n"),
        (8, "one", "s"), (9, "one two", "s"), (10, "One TWO three É", "s"), (10, "another text of the same id", "s"),
        (11, "x " * 30000 + base + " tail", "long"), (12, "pre " + base + " post", "p"),
        (13, "w0 " + " ".join(f"w{i}" for i in range(40, 119)) + " z", "p"), (14, "  nbsp word <|endoftext|> Σας İ", "u"),
    ]
    df = lspark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for c in ("id", "kept", "fp", "r", "th", "ranges", "score", "shard_id", "bm_bucket", "key"):
        df = df.selectExpr("*", f"'clash' as {c}")
    return df


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
