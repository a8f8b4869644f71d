"""Text operators against plain Python on small tables that hold the odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def of(text):
    return SPACE.findall(text or "")


# ---- 1: substring dedup


def brute_repeats(rows, width):
    first = {}
    for i, t in rows:
        w = of(t)
        if i is not None:
            for p in range(len(w) - width + 1):
                k = tuple(w[p : p + width])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = of(t)
        gone = set()
        if i is not None:
            for p in range(len(w) - width + 1):
                if first[tuple(w[p : p + width])] < i:
                    gone.update(range(p, p + width))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [2, 13])
def test_repeats(documents, rounds, width):
    from reliefgrid.llm.recompression import remove_repeats

    docs = documents.withColumns({"bucket": F.lit(1), "rows": F.lit("x")})
    got = remove_repeats(docs, width).select("doc_id", "n_words", "n_removed", "kept", "bucket", "rows").collect()
    assert {(r["bucket"], r["rows"]) for r in got} == {(1, "x")}
    assert sorted((tuple(r)[:4] for r in got), key=str) == brute_repeats([(r["doc_id"], r["text"]) for r in documents.collect()], width)


def test_repeats_of_nothing(empty, documents):
    from reliefgrid.llm.recompression import remove_repeats

    assert remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(documents.withColumn("Kept", F.lit(1)))


def test_equal_windows_choose_equal_symbols():
    from reliefgrid.llm import recompression as R

    rng = random.Random(1)
    with np.errstate(over="ignore"):
        for kinds in (1, 2, 3, 30):
            texts = [" ".join(f"v{rng.randrange(kinds)}" for _ in range(rng.randrange(5, 90))).encode() for _ in range(60)]
            texts += [t[len(t) // 3 :] + b" " + rng.choice(texts) for t in texts]
            offsets = np.cumsum([0, *map(len, texts)])
            words, length, begin = R.word_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets)
            assert [len(t.split()) for t in texts] == np.diff(begin).tolist()
            name, p, n = R.chosen(words, length, begin, 13)
            seen, covered = {}, 0
            for a, b, k in zip(name.tolist(), p.tolist(), n.tolist()):
                for q in range(b, b + k):
                    covered += 1
                    assert seen.setdefault(words[q : q + 13].tobytes(), a) == a
            assert covered == np.maximum(np.diff(begin) - 12, 0).sum()


# ---- 5: SimHash


def brute_fingerprint(text):
    w = SPACE.findall((text or "").encode().lower().decode())
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def least_reachable(nodes, linked):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in linked:
        top[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_simhash(documents, rounds):
    from reliefgrid.llm import simhash

    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in documents.collect()]
    fps = sorted({f for _, f in rows})
    root = least_reachable(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in rows), key=str)
    docs = documents.withColumnsRenamed({"lang": "fp", "source": "cell"})
    got = simhash.near_duplicates(docs, rounds()).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_simhash_links_are_all_within_two_bits(spark, rounds):
    from reliefgrid.llm import simhash

    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        fps |= {f, *(f ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 1, 2, 2, 2, 3, 4))}
    fps |= {0, 1, 3, 7, 2**64 - 1, 2**63, 2**63 + 1, 2**64 - 4}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    got = sorted(map(tuple, simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).collect()))
    want = sorted(tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2)
    assert sorted(set(got)) == want


def test_simhash_copies_at_cells_are_never_broadcast(spark):
    from reliefgrid.llm import simhash

    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "10m")
        plan = simhash.links(spark.range(9).withColumnRenamed("id", "fp"))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_of_nothing(empty, rounds):
    from reliefgrid.llm import simhash

    assert simhash.near_duplicates(empty, rounds()).count() == 0


def test_components_of_chains_stars_and_loops(spark, rounds):
    from reliefgrid.llm.graph import components

    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(200, 200), (200, 201), (201, 200), (201, 200), (None, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), rounds()).collect()}
    groups = [range(61), range(100, 150), (200, 201)]
    assert set(got) == {n for g in groups for n in g}
    assert [len({got[n] for n in g}) for g in groups] == [1, 1, 1] and len({got[0], got[100], got[200]}) == 3


# ---- 6: outliers


def brute_counts(text):
    w = of(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if of(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_outliers(spark, rounds, words):
    from reliefgrid.llm import outliers

    rng = random.Random(2)
    rows = []
    for i in range(400):
        text = " ".join("abcdefgh"[: rng.randrange(3, 8)] + str(rng.randrange(900)) for _ in range(rng.randrange(60, 150)))
        if i % 9 == 0:
            text = text.replace(" ", " ### ")
        rows.append((i, text, "en" if i % 2 else None, "s0" if i % 4 else "s1"))
    odd = [None, "", "one", "a b c " * 40, "Ünï |" * 60 + "\n\n x\n x\n", "same line\n" * 70]
    rows += [(1000 + i, t, None, "rare") for i, t in enumerate(odd)] + [rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("pool", F.lit(1))
    job = rounds()
    got = outliers.judged(job.put(outliers.statistics(docs), "statistics"), job).collect()
    assert len(got) == len(rows)
    told = {r["doc_id"]: r for r in got}
    for i, t, _, _ in rows:
        r, n = told[i], brute_counts(t)
        assert tuple(r[c] for c in outliers.COUNTS) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r["base_failed"] and r["kept"])
    assert all(told[i]["kept"] == (i % 9 != 0) for i in range(400))


def test_outliers_of_equal_rows_and_nothing(spark, empty, rounds):
    from reliefgrid.llm import outliers

    job = rounds()
    assert outliers.judged(job.put(outliers.statistics(empty), "statistics"), job).count() == 0
    text = " ".join(f"word{i}" for i in range(80))
    same = spark.createDataFrame([(i, text, "en", "s") for i in range(5)], "doc_id long, text string, lang string, source string")
    job = rounds()
    assert [r["kept"] for r in outliers.judged(job.put(outliers.statistics(same), "statistics"), job).collect()] == [True] * 5


# ---- 7 and 3: learned operators


def labelled(spark, words, good, bad, n=600):
    rng = random.Random(4)
    docs = [(i, good(rng) if rng.random() < 0.7 else bad(rng)) for i in range(n)]
    return docs, rng


def test_pu_quality(spark, empty, words):
    from reliefgrid.llm import pulearn

    rng = random.Random(4)
    truth = {i: rng.random() < 0.7 for i in range(900)}
    texts = {i: words(80) if q else words(40).replace(" ", " | ") for i, q in truth.items()}
    docs = spark.createDataFrame([*texts.items(), (5000, None), (5001, ""), (None, "x")], "doc_id long, text string").withColumn("score", F.lit("kept"))
    labels = spark.createDataFrame([(i, int(truth[i])) for i in range(500)] + [(5000, None), (None, 1)], "doc_id long, quality int")
    model = pulearn.fit(docs, labels)
    got = pulearn.score(docs, model, name="p").collect()
    assert len(got) == 903 and all(0 <= r["p"] <= 1 and r["score"] == "kept" for r in got)
    right = [(r["p"] >= pulearn.SCORE_FROM) == truth[r["doc_id"]] for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(right) / len(right) > 0.95
    flipped = labels.withColumn("quality", F.when(pulearn.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(pulearn.fit(docs, flipped).weights, model.weights)  # held-out labels teach nothing
    none = pulearn.fit(empty, labels.limit(0))
    assert {r["p"] for r in pulearn.score(docs, none, name="p").collect()} == {0.5}
    assert pulearn.score(empty, model).count() == 0


def test_ordinal_toxicity(spark, empty, words):
    from reliefgrid.llm import ordinal

    rng = random.Random(6)
    grade = {i: rng.choice([0, 0, 0, 1, 4]) for i in range(900)}
    texts = {}
    for i, g in grade.items():
        w = words(60).split()
        for _ in range(g):
            w.insert(rng.randrange(len(w)), rng.choice(["Vile,", "vilest", "vilely", "rotten."]))
        texts[i] = " ".join(w)
    docs = spark.createDataFrame([*texts.items(), (5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(grade[i] > 0)) for i in range(600)] + [(5000, None), (None, 1)], "doc_id long, toxic int")
    model = ordinal.fit(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in ordinal.severity(docs, model).collect()}
    assert len(got) == 902
    later = [i for i in range(600, 900)]
    right = [(got[i]["score"] >= ordinal.TOXIC_FROM) == (grade[i] > 0) for i in later]
    assert sum(right) / len(right) > 0.95
    mean = lambda g: np.mean([got[i]["severity"] for i in later if grade[i] == g])
    assert mean(0) < mean(1) < mean(4)
    assert ordinal.severity(empty, model).count() == 0
    assert {r["grade"] for r in ordinal.severity(docs, ordinal.fit(empty, labels.limit(0))).collect()} == {0}


# ---- 8: sharding


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(n):
    from reliefgrid.llm import sharding

    image = sharding.permute(np.arange(n), n, seed=9)
    assert sorted(image.tolist()) == list(range(n))
    assert np.array_equal(sharding.permute(image, n, seed=9, back=True), np.arange(n))
    assert sharding.number_at(*sharding.locate(n - 1, n, 4, 9), n, 4, 9) == n - 1


def test_shards(documents, empty, rounds):
    from reliefgrid.llm import sharding

    for docs in (documents, empty):
        rows, n = sharding.numbered(docs.select("doc_id", "text"), ["doc_id", "text"], rounds())
        got = sharding.shard(rows, n, 4, seed=1).collect()
        assert len(got) == n == docs.count()
        assert sorted(r["row_number"] for r in got) == list(range(n))
        assert all(sharding.locate(r["row_number"], n, 4, 1) == (r["shard"], r["slot"]) for r in got)
        sizes = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(4)]
        assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
        order = [(r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "") for r in sorted(got, key=lambda r: r["row_number"])]
        assert [o[:2] for o in order] == sorted(o[:2] for o in order)


def test_shards_keep_other_columns(documents, rounds):
    from reliefgrid.llm import sharding

    docs = documents.selectExpr("doc_id", "text", *(f"doc_id * {i} as {c}" for i, c in enumerate(("_at", "_range", "_in", "_n", "_before", "_image"))))
    rows, n = sharding.numbered(docs, ["doc_id"], rounds())
    got = sharding.shard(rows, n, 4)
    assert got.columns == [*docs.columns, "row_number", "shard", "slot"]
    assert all(r["_image"] == (None if r["doc_id"] is None else 5 * r["doc_id"]) for r in got.collect())
    with pytest.raises(ValueError):
        sharding.numbered(docs.withColumn("ROW_number", docs["doc_id"]), ["doc_id"], rounds())
    with pytest.raises(ValueError):
        sharding.shard(rows.withColumn("slot", rows["doc_id"]), n, 4)


def test_samples_take_one_row_of_a_repeated_id(spark, documents):
    from reliefgrid.llm import ordinal, pulearn

    some = documents.where("doc_id is not null")
    more = some
    for k in range(3):
        more = more.unionByName(some.withColumn("text", some["text"]))
    labels = some.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality", "cast(doc_id % 2 as int) as toxic").distinct()
    one, many = (ordinal._samples(d, labels, "doc_id", "text")[0] for d in (some.dropDuplicates(["doc_id", "text"]), more))
    assert [tuple(r) for r in one] == [tuple(r) for r in many] and len({r["doc_id"] for r in many}) == len(many)
    a, b = pulearn.fit(some, labels), pulearn.fit(more, labels)
    assert (a.weights == b.weights).all() and a.bias == b.bias
    with pytest.raises(ValueError):
        pulearn.score(some.withColumn("Score", some["doc_id"]), a)


# ---- 9: BPE


def test_bpe(documents, empty):
    import public_tokenizers as P
    import tiktoken
    from reliefgrid.llm import bpe

    path = P.path("byte_bpe_50k.tiktoken")
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = []
    for r in documents.collect():
        ids = known.encode_ordinary(r["text"] or "")
        digest = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r["doc_id"], len(ids), digest(" ".join(map(str, ids)).encode()), digest((r["text"] or "").encode()), np.array(ids, "<i4").tobytes()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], bytes(r["ids"])) for r in bpe.encode(documents, path, P.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encode(empty, path, P.PATTERN).count() == 0


# ---- 10: packing


def test_packing(documents, empty, rounds):
    import public_tokenizers as P
    from reliefgrid.llm import packing
    from tokenizers import Tokenizer

    path, size = P.path("word_bpe_49k.json"), 64
    whole = Tokenizer.from_file(path)
    docs = documents.withColumns({"length": F.lit(1), "part": F.lit("x")})
    got = packing.pack(packing.pieces(docs, path, size), rounds(), size).collect()
    ids = [(r["doc_id"], whole.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in documents.collect()]
    want = sorted(((i, a, len(x[a : a + size]), zlib.crc32(np.array(x[a : a + size], "<u4").tobytes()), len(x)) for i, x in ids for a in range(0, len(x), size)), key=str)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    packs = {}
    for r in got:
        packs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in packs.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= size
    assert sum(r["length"] for r in got) > 0.9 * size * (len(packs) - 1)
    assert packing.pack(packing.pieces(empty, path), rounds()).count() == 0


def test_patterns_place_every_length():
    from reliefgrid.llm.packing import patterns, places

    rng = random.Random(8)
    for _ in range(20):
        counts = {rng.randrange(1, 101): rng.randrange(1, 50) for _ in range(40)}
        found = patterns(counts, 100)
        assert all(sum(p) <= 100 and n > 0 for p, n in found)
        placed = Counter()
        for p, n in found:
            for length in p:
                placed[length] += n
        assert placed == counts
        at = places(found)
        assert len(at["length"]) == sum(len(p) for p, _ in found)
