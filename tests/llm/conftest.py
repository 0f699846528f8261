import random

import pytest
from pyspark import cloudpickle

from postsieve import llm

cloudpickle.register_pickle_by_value(llm)

#: columns whose names the operators use inside or in their results
CLASHING = ("size", "shard", "slot", "score", "fp", "root", "pack", "notes", "hash", "taken", "ids", "key", "x")


def make_rows():
    """Documents with nulls, repeats, near copies, shared passages and a very long text."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgé漢") for _ in range(rnd.randint(1, 8))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, other = text(90), text(140)
    base = text(120)
    rows = [
        (1, base, "a"), (2, base, "a"), (2, base, "a"), (3, base + " end", "b"), (4, None, "b"), (5, "", None),
        (6, "  \t\n", "c"), (7, "one", "c"), (7, "two words", None), (None, text(30), "a"), (None, None, None),
        (None, base, "d"), (8, text(20) + " " + shared + " " + text(15), "a"), (9, shared + "\n" + text(40), "b"),
        (10, text(10) + " " + shared, "b"), (11, text(25) + " " + other + " " + text(5) + " " + other, "a"),
        (12, other[30:700] + " " + text(9), "e"), (13, "ab " * 900, "a"), (14, "-" * 1500, "a"),
        (15, text(25_000), "a"), (16, "line\x00with\x1fodd\x85space\xa0<|endoftext|> 😀", "f"), (-3, base, "a"),
    ]
    for i in range(20, 60):
        rows.append((i, text(rnd.randint(1, 60)), rnd.choice("abc")))
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]


@pytest.fixture(scope="session")
def docs(spark):
    """The rows above with extra columns of clashing names."""
    df = spark.createDataFrame(make_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
