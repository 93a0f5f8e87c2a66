import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, _text string, node long, block string"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with nulls in any column, empty, tiny and very long texts, repeated rows, near copies, a hot passage and
    columns whose names operators use themselves."""
    r = random.Random(7)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ré", "zu", "ta") for b in ("n", "s", "tion", "ß", "r", "x")]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    hot = say(90)
    texts = [None, "", " \n\t", "a", "ab cd", "é", "!!!", "aaaa " * 400, "x" * 30_000, say(8000)]
    texts += [f"{say(r.randrange(40))} {hot} {say(r.randrange(40))}" for _ in range(40)]
    base = [say(r.choice([3, 4, 12, 40, 120])) for _ in range(12)]
    for b in base:
        texts.append(b)
        for _ in range(4):
            w = b.split(" ")
            for _ in range(r.choice([0, 0, 1, 2])):
                w[r.randrange(len(w))] = r.choice(words)
            texts.append(" ".join(w))
    texts += [say(r.randrange(1, 60)) for _ in range(60)]
    rows = [(i, t, r.choice([None, "en"]), r.choice([None, "s"]), None, r.random(), "s", "t", 1, None) for i, t in enumerate(texts)]
    rows += rows[50:53] + rows[50:51]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def plain(docs):
    """The same rows as (doc_id, text) in Python."""
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def nulls(spark):
    """Rows of nulls alone."""
    return spark.createDataFrame([(None,) * 10] * 3, SCHEMA)
