import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rounds(spark):
    """A fresh set of round tables for a job."""
    from reliefgrid.rounds import Rounds

    return lambda job="test": Rounds(spark, job)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return lambda n, kinds=400: " ".join(f"w{int(kinds * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark, rounds, words):
    """Texts with copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    passage = words(40)
    base = [words(n) for n in (3, 12, 13, 14, 60, 120, 200, 400, 3000)]
    texts = [*base, *base[4:7], base[6].replace("w1 ", "x1 ", 1), None, "", "  \n\t ", "one", "a " * 300]
    texts += [f"{words(30)} {passage} {words(25)}" for _ in range(6)]
    texts += ["Größe naïve 東京  wide space 's it's 12 345\r\n\r\n  tail  ", "x" * 3000 + " " + "ab" * 500]
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], (rows[6][0], words(50), "en", "s0", 1), (None, base[6], "en", "s0", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
