"""Vectors, archives and the pipeline."""

import hashlib
import random

import numpy as np
import zstandard
from pyspark.sql import functions as F


# ---- 4: embeddings


def test_vectors(spark, rounds):
    from reliefgrid.llm import multiindex

    rng = np.random.default_rng(2)
    rows = []
    for _ in range(60):
        centre = rng.normal(size=9)
        for _ in range(rng.integers(1, 6)):
            rows.append((len(rows), (centre + rng.normal(size=9) * 0.2).tolist(), int(rng.integers(0, 2))))
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(30)]
    n = len(rows)
    odd = [None, [], [0.0] * 9, [float("nan")] + [1.0] * 8, [float("inf")] + [1.0] * 8, [None] + [1.0] * 8, [1e-200] * 9, [1e200] * 9, [1.0] * 3]
    rows += [(n + k, v, 1) for k, v in enumerate(odd)] + [(n + 50, rows[0][1], None), (None, rows[0][1], rows[0][2])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit(7), "cell": F.lit(7)})
    got = {r["vec_id"]: r for r in multiindex.near_duplicates(vectors, rounds()).collect()}
    assert len(got) == len(rows)
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            usable[i] = (label, x / np.linalg.norm(x))
    near = {i: {j for j, (b, y) in usable.items() if j != i and a == b and len(x) == len(y) and x @ y >= 0.93} for i, (a, x) in usable.items()}
    for i, r in got.items():
        assert r["n_links"] == len(near.get(i, ()))
        reach, todo = {i}, [i]
        while todo:
            new = near.get(todo.pop(), set()) - reach
            reach |= new
            todo += new
        assert r["component_id"] == (i if i is None else min(reach))
        assert r["kept"] is (None if i is None else i == min(reach))


def test_vectors_of_nothing(spark, rounds):
    from reliefgrid.llm import multiindex

    assert multiindex.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), rounds()).count() == 0


def test_recall_against_brute_force():
    from reliefgrid.llm import multiindex

    rng = np.random.default_rng(4)
    unit = multiindex.unit_rows(rng.normal(size=(3000, 32)))
    index = multiindex.fit(unit[:1500], 12, 0.93)
    noise = rng.normal(size=(2000, 32))
    noise -= (noise * unit[:2000]).sum(axis=1, keepdims=True) * unit[:2000]
    partner = 0.94 * unit[:2000] + np.sqrt(1 - 0.94**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    visits = multiindex.traverse(unit[:2000], index, index.visited)
    recall = (visits == multiindex.traverse(partner, index, 1)).any(axis=1).mean()
    assert recall >= 0.99
    every = multiindex.traverse(unit[:50], index, 144)
    assert (np.sort(every, axis=1) == np.arange(144)).all()


# ---- 2: archives


def page_rows():
    rng = random.Random(7)
    body = lambda n: "<p>" + " ".join(rng.choice(["alpha", "beta", "größe", "東京"]) + str(rng.randrange(99)) for _ in range(n)) + "</p>"
    same = body(60)
    rows = [(i, f"http://h{i % 3}/{i}", body(rng.randrange(1, 200))) for i in range(80)]
    rows += [(200 + i, "http://copy/\r\nX-Evil: 1", same) for i in range(25)] + [(300, None, None), (301, "u", ""), (302, "u", "short"), (303, "u", "short")]
    return rows + [rows[4], (5, "again", rows[4][2]), (None, "n", same), (None, "n", same), (None, None, None)]


def test_archives(spark, rounds, tmp_path):
    from reliefgrid.llm import warc

    rows = page_rows()
    folder = f"file://{tmp_path}/out"
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)), folder)
    got = warc.read(spark, folder, payloads=True).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= warc.LEAST_REVISIT:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in rows:
        revisit = i is not None and first.get(h, i) < i
        payload = (h or "").encode()
        want.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None, None if revisit else h or ""))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(want, key=str)


def test_archive_layout(spark, rounds, tmp_path):
    from reliefgrid.llm import warc

    rng = random.Random(1)
    rows = [(i, "u", "<html>" + "".join(f"<li class='item'>{rng.randrange(10**9)}</li>" for _ in range(40))) for i in range(300)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/out")
    files = sorted((tmp_path / "out").glob("*.warc.zst"))
    assert files and not (tmp_path / "out" / "parts").exists()
    data = files[0].read_bytes()
    assert data[:4] == warc.DICTIONARY_MAGIC
    size = int.from_bytes(data[4:8], "little")
    words = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    second = data[8 + size :]
    while second[1:4] == b"*M\x18":
        second = second[8 + int.from_bytes(second[4:8], "little") :]
    record = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)).decompressobj().decompress(second)
    assert record.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert len(list(warc.frames_of(data))) == 301


def test_no_pages(spark, rounds, tmp_path):
    from reliefgrid.llm import warc

    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/out")
    assert warc.read(spark, f"file://{tmp_path}/out").count() == 0


# ---- pipeline


def test_stages(spark, rounds, words, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(9)
    passage = words(70)
    texts = [words(150) for _ in range(120)]
    texts += texts[:10] + [f"{words(80)} {passage} {words(80)}" for _ in range(5)] + [words(60).replace(" ", " | ") for _ in range(30)]
    texts += [None, "", "tiny"]
    rows = [(i, t, "en", "s0", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [rows[7]], "doc_id long, text string, lang string, source string, n_chars long").withColumns({"row_key": F.lit(1), "score": F.lit(2)})
    labels = spark.createDataFrame([(i, int(i < 135)) for i in range(165) if rng.random() < 0.8], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [*range(120), *range(130, 135)]  # junk, copies and repeated rows are gone, clean documents stay
    found = {r["doc_id"]: r for r in kept.collect()}
    assert passage in found[130]["text"] and all(passage not in found[i]["text"] for i in range(131, 135))
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    packed = P.STAGES[-1][1](spark, kept, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(ids)


def test_substring_stage_keeps_columns_with_the_names_of_its_own(spark, words, tmp_path):
    import corpus_pipeline as P

    passage = words(30)
    docs = spark.createDataFrame([(i, f"{words(20)} {passage} {words(20)}", None) for i in (1, 2)] + [(None, "a b", None)], "doc_id long, text string, n_chars long")
    want = {r["doc_id"]: r["text"] for r in P.substring_dedup(spark, docs, str(tmp_path)).collect()}
    named = docs.withColumns({"n_words": F.lit("a"), "N_Removed": F.lit(7), "kept": F.lit(None).cast("int")})
    got = P.substring_dedup(spark, named, str(tmp_path))
    assert got.columns == named.columns
    rows = got.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == want and passage not in want[2]
    assert all((r["n_words"], r["N_Removed"], r["kept"]) == ("a", 7, None) for r in rows)
