import random

import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
_BASE = ("the quick brown fox jumps over the lazy dog and runs into the deep green forest where "
         "old trees keep the wind away from small houses built of stone and clay")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeats, clashing column names."""
    rnd = random.Random(3)
    vocab = [f"word{i}" for i in range(200)]

    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    rows = [(1, _BASE), (2, _BASE), (3, _BASE + " today"), (4, ""), (5, None), (6, " \n\t "),
            (7, LONG), (8, prose(300)), (8, None), (9, "one"), (10, "ÄÖ Straße İstanbul ΑΣ é"),
            (11, "日本語 テキスト <|endoftext|> it's 123"), (12, prose(80)), (12, prose(80)),
            (None, "nameless " + prose(30)), (None, _BASE), (-3, "a!b?c.d\n\ne"),
            (13, "x" * 5000), (14, LONG[:4000] + " " + LONG[:4000])]
    rows += [(20 + i, prose(40) + " " + _BASE) for i in range(20)]
    return spark.createDataFrame(
        [(k, t, None if i % 3 else "src", 1, "z", float(i), [i]) for i, (k, t) in enumerate(rows)],
        "doc_id bigint, text string, source string, fp int, _chunk string, score double, "
        "ids array<int>")


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)
