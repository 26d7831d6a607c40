import random

import pytest


@pytest.fixture
def rng():
    return random.Random(20)


def texts(rng):
    """Texts that share passages: copies, cut copies, runs of one word, odd separators, empty and null ones."""
    words = "the cat é sat on ß mat 1 2 three".split()
    base = [[rng.choice(words) + rng.choice(["", "", ",", "a"]) for _ in range(300)] for _ in range(4)]
    out = []
    for _ in range(60):
        s, a = rng.choice(base), rng.randrange(250)
        t = s[a : a + rng.randrange(10, 120)] + [rng.choice("xyz") for _ in range(rng.randrange(40))] + rng.choice(base)[: rng.randrange(80)]
        out.append(rng.choice([" ", "\n", "  ", "\t"]).join(t))
    return [*out, None, "", " \n", "a" * 300, "a " * 300, " ".join(base[0]), " ".join(base[0]), " ".join(base[0][:35])]


def frame(spark, rows):
    """Rows with columns whose names clash with those that operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"batch": F.lit(1), "n": F.lit("x"), "row": F.lit(2.0), "kept": F.lit(True), "_stats": F.lit("s"), "a.b": F.lit(3), "doc_id.text": F.lit("y"), "q`": F.lit(4)})


@pytest.fixture
def rows(rng):
    t = texts(rng)
    out = [(i * 7919 % 1009, x) for i, x in enumerate(t)]
    return [*out, (None, t[0]), (None, None), out[3], (out[4][0], t[9])]


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)
