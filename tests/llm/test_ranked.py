"""Ranked search against a loop over all documents, and its bounds against theirs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from reliefgrid.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    found = [(i, Counter(words(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in found if c), sum(c.total() for _, c in found)
    out = []
    for item, text in set(items):
        scores = []
        asked = dict.fromkeys(words(text))
        df = {t: sum(t in c for _, c in found) for t in asked}
        for doc, c in found:
            m = 50 + 50 * c.total() * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [1 << 8, 1 << 20])
@pytest.mark.parametrize("chunk", [30, 1 << 20])
def test_rank(spark, rounds, documents, words, blocks, chunk, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_BYTES", blocks)
    monkeypatch.setattr(ranked, "CHUNK_TERMS", chunk)
    own = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(i, words(30)) for i in range(8)] + [(8, None), (9, ""), (10, "... --"), (11, "nowhere seen"), (12, "GRÖßE naïve 東京"), (3, "w1 W1 w2"), (3, "w1 W1 w2"), (None, "w3 w300 x1"), (13, "a " * 3000)]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as key", "2 as score", "3 as rank", "4 as terms")
    clashing = documents.selectExpr("*", "1 as key", "2 as score", "3 as docs", "4 as n", "5 as terms", "6 as df")
    for k in (5, 50):
        made = ranked.rank(clashing.repartition(3), asked, rounds(), k)
        assert made.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, made.collect()), key=str) == brute(own, items, k)


def test_empty(spark, rounds, documents, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert not ranked.rank(empty, some, rounds()).collect()
    assert not ranked.rank(documents, none, rounds()).collect()
    assert not ranked.rank(documents.where("text is null"), some, rounds()).collect()


def test_pairs_tighten_the_bounds():
    rng = np.random.default_rng(2)
    searched = [0, 0]
    for _ in range(200):
        n = int(rng.integers(1, 9))
        lists = []
        for _ in range(n):
            docs = np.sort(rng.choice(300, int(rng.integers(1, 60)), replace=False))
            lists.append((docs, rng.integers(1, 100, len(docs))))
        dense = np.zeros((n, 300), np.int64)
        for i, (docs, score) in enumerate(lists):
            dense[i, docs] = score
        top = dense.max(axis=1).tolist()
        joint = [int(np.where((a > 0) & (b > 0), a + b, 0).max()) for a, b in zip(dense, dense[1:])]
        bound = ranked.bounds(top, joint)
        for i in range(n):
            assert dense[i:].sum(axis=0).max() <= bound[i] <= sum(top[i:])
        want = np.sort(dense.sum(axis=0))[::-1]
        floor = max(1, int(want[9]))
        at, got, _ = ranked.best(lists, bound, 300, 10, floor)
        single = [sum(top[i:]) for i in range(n + 1)]
        searched = [n + sum(b >= floor for b in x[:-1]) for n, x in zip(searched, (bound, single))]
        assert sorted(got)[::-1][:10] == want[want >= floor][:10].tolist() and (dense.sum(axis=0)[at] == got).all()
    assert searched[0] < searched[1]  # lists that are read for documents


def test_skipping(words):
    random.seed(4)
    rare = [(np.array([i]), np.array([1000])) for i in range(12)]
    common = [(np.arange(2000), np.full(2000, 3)), (np.arange(0, 2000, 2), np.full(1000, 4))]
    lists = rare + common
    bound = ranked.bounds([1000] * 12 + [3, 4], [0] * 11 + [1003, 7])
    assert ranked.best(lists, bound, 2000, 5, 900)[2] < 100


def test_blocks_are_read_one_at_a_time(spark, rounds, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(ranked, "BLOCK_BYTES", 1 << 18)
    rng = random.Random(6)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(110_000)) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    asked = spark.createDataFrame([(i, t[:100]) for i, t in enumerate(texts)], "item_id long, text string")
    own = rounds()
    assert ranked.rank(docs, asked, own, 1).count() == len(texts)
    found = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in own.again("index").inputFiles()]
    assert sum(m.num_rows for m in found) == len(texts) and all(m.num_rows == m.num_row_groups for m in found)
