import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names an operator might use itself.
CLASH = ("fp", "node", "a", "b", "key", "chunk_id", "name", "score", "_t", "n", "h", "at", "rid", "_encode", "_score_text", "_text", "_rid", "_b", "c0", "_old", "_new", "_mark", "_w", "_h", "_s", "_p")


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def corpus(seed=5, n=60):
    """Texts with exact and near copies, shared passages, repeated lines, blanks, nulls and one long text."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    rows = []
    for i in range(n):
        w = words(rng, rng.randrange(30, 160))
        text = "\n".join(" ".join(w[k : k + 25]) for k in range(0, len(w), 25))
        if i % 7 == 3:
            text += "\n" + passage
        if i % 11 == 5:
            text = rows[-1][1]
        if i % 13 == 6 and rows[-2][1]:
            text = rows[-2][1].replace(" ", " x ", 1)
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "one"), (None, rows[0][1]), (4, rows[4][1])]
    rows.append((n + 4, " ".join(words(rng, 9000, 5000))))
    rows.append((n + 5, "Écôle 日本 ÉTÉ naïve 😀 " * 30))
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(1) for c in CLASH})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
