import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, _bucket string, shard string, wrapper string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts by doc_id: copies, near copies, empty, null, white space, other alphabets, control strings, one very long."""
    rng = random.Random(3)
    base = words(rng, 300)
    near = base.split()
    near[150] = "changed"
    far = words(rng, 300)
    out = [base, base, " ".join(near), far, "", None, " \t\n ", "one", "one two three", "ab\n\nab\nab", "日本語 テキスト 🙂 ▁ end", "<|im_start|>user <\\|x|> \\", words(rng, 40_000, 5000), "A B C " * 40, base.upper(), base + " tail"]
    out += [words(rng, rng.randrange(1, 120)) for _ in range(40)]
    return dict(enumerate(out, 10))


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with other columns, whose names clash with those that operators use, and with nulls in any column."""
    rows = [(i, t, [None, "en", "xx"][i % 3], [None, "a", "b", "c"][i % 4], None if t is None else len(t), "x", None, "s", "{}") for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def odd_docs(spark, docs):
    """Repeated rows and a null key."""
    return docs.unionByName(docs.filter("doc_id in (10, 14)")).unionByName(spark.createDataFrame([(None, "null key words", "en", "a", 1, "", "", "", "")], DOCS))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
