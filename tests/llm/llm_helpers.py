"""Small tables for the tests of this folder."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, fp string, root int, score double, _row int"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, l, s, None if t is None else len(t), 7, "x", 1, 0.5, 3) for i, t, l, s in rows], DOCS)


def words(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))
