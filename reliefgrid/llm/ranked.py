"""Ranked lexical search with MaxScore whose skipping is tightened by bounds of term pairs.

1. ``index``: blocks of documents, each one row that holds the postings of its terms.
2. ``impacts``: for the terms of a chunk of queries, each block's postings with their
   scores, the greatest score of each term, and for pairs of terms the greatest joint
   score over the intersection of their lists.
3. ``search``: each block is searched for each query. A query's terms come in the order
   of their weights. What the terms from a place on can add is bounded by the cheapest
   combination of single maxima and joint maxima of neighbours; a pair without common
   documents adds the larger of both, not their sum. Terms whose bound stays below the
   threshold aren't searched for documents, only looked up for those found already, and
   documents that can't reach the threshold any more are dropped on the way.

A query's threshold starts with its k-th best score in about the square root of all
blocks, which no k-th best score of all blocks is below. Documents with a score equal to
the threshold stay, so the result is whole. Nothing is shuffled but counts and each
task's k best; the driver holds the terms of one chunk of queries.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import steps, texts
from reliefgrid.rounds import Rounds

#: Text bytes of a block.
BLOCK_BYTES = 8 << 20
#: A block is a row of megabytes. Parquet would look at a row group's size after 100 rows and read a group's rows at once; so each block is a group.
ALONE = {"parquet.block.size": str(1 << 20), "parquet.page.size.row.check.min": "1"}
#: Terms of the queries that are searched for at a time.
CHUNK_TERMS = 200_000
#: A-Z become lower case; digits, letters and all beyond ASCII make terms; the rest separates.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text, with repeats."""
    return (text or b"").translate(TABLE).split()


class _Block:
    """The postings of a block's documents."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.doc_ids: list[pa.Array] = []
        self.n: list[int] = []
        self.postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.doc_ids.append(batch.column("doc_id"))
        for text in texts(batch, "text"):
            found = terms(text)
            own, tf = np.unique(np.fromiter(map(self.number.__getitem__, found), np.int32, len(found)), return_counts=True)
            self.postings.append((own, np.full(len(own), len(self.n), np.int32), tf.astype(np.int32)))
            self.n.append(len(found))
            self.size += len(text or b"")

    def row(self) -> pa.RecordBatch:
        own, docs, tf = (np.concatenate(x) for x in zip(*self.postings))
        order = np.argsort(own, kind="stable")
        df = np.bincount(own, minlength=len(self.number)).astype(np.int32)
        ids = pa.concat_arrays(self.doc_ids)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        blobs = [np.array(self.n, np.int32).tobytes(), docs[order].tobytes(), tf[order].tobytes()]
        names = pa.array([t.decode() for t in self.number], pa.string())
        return pa.RecordBatch.from_arrays([one(ids), one(names), one(pa.array(df)), *(pa.array([b], pa.binary()) for b in blobs)], ["doc_ids", "terms", "df", "n", "docs", "tf"])


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_ids, terms, df, n, docs, tf): a block's documents, terms, lists' lengths, documents' terms, and lists one after the other.

    n, docs (places in doc_ids) and tf are 32-bit integers as bytes. Null and empty texts
    are documents without terms; a text larger than a block is a block with what came
    before it; repeated rows are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in steps(batches, "text"):
            block.add(batch)
            if block.size >= BLOCK_BYTES:
                yield block.row()
                block = _Block()
        if block.n:
            yield block.row()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_ids array<long>, terms array<string>, df array<int>, n binary, docs binary, tf binary")


def queries(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(key, item_id, terms): the distinct terms of each distinct (item_id, text); items without terms are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            found = pa.array([[w.decode() for w in dict.fromkeys(terms(t))] for t in texts(batch, "text")], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("item_id"), found], ["key", "item_id", "terms"])

    own = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    return own.withColumn("key", F.xxhash64("item_id", "text")).mapInArrow(run, "key long, item_id long, terms array<string>").where(F.size("terms") > 0)


class Model:
    """A chunk of queries: the numbers of its terms, their weights, each query's terms by falling weight, and the corpus's sums."""

    def __init__(self, chunk: list, df: dict[str, int], documents: int, length: int):
        self.documents, self.length = documents, length
        self.names = list(df)
        number = {t: i for i, t in enumerate(df)}
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.values()]
        self.weight = np.array(weight, np.int64)
        # terms that no document holds have no number
        self.queries = [(r["key"], sorted((number[t] for t in r["terms"] if t in number), key=lambda i: (-weight[i], i))) for r in chunk]

    def scores(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What one of a document's terms scores by each unit of its weight."""
        m = 100 - 50 + 50 * n * self.documents // self.length
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _bytes(batch: pa.RecordBatch, name: str, k: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(name)[k].as_buffer(), kind)


def impacts(blocks: DataFrame, model: Model) -> DataFrame:
    """(doc_ids, ids, ends, docs, score, top, pairs, joint) of each block, for the terms of the model.

    ``top`` has the greatest score of each term. ``pairs`` are the terms that follow each
    other in some query, as far as the block holds them; ``joint`` has the greatest sum of
    both scores over the documents with both, 0 without any.
    """

    def lists(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
        place = pc.index_in(batch.column("terms")[k].values, value_set=pa.array(model.names, pa.string()))
        known = np.flatnonzero(~place.is_null().to_numpy(zero_copy_only=False))
        ids = place.take(pa.array(known)).to_numpy().astype(np.int64)
        df = batch.column("df")[k].values.to_numpy()
        ends = np.cumsum(df, dtype=np.int64)
        lengths = df[known].astype(np.int64)
        stops = np.cumsum(lengths)
        at = np.repeat(ends[known] - stops, lengths) + np.arange(lengths.sum())
        docs, tf = _bytes(batch, "docs", k, np.int32)[at], _bytes(batch, "tf", k, np.int32)[at].astype(np.int64)
        n = _bytes(batch, "n", k, np.int32).astype(np.int64)
        score = np.repeat(model.weight[ids], lengths) * model.scores(tf, n[docs])
        begins = stops - lengths
        top = np.maximum.reduceat(score, begins) if len(ids) else np.zeros(0, np.int64)

        row = np.full(len(model.names), -1)
        row[ids] = np.arange(len(ids))
        after: dict[int, set[int]] = {}
        for _, query in model.queries:
            own = row[query]
            own = own[own >= 0].tolist()
            for a, b in zip(own, own[1:]):
                after.setdefault(a, set()).add(b)
        pairs, joint = [], []
        of = np.full(len(n), -1, np.int64)
        for a, others in after.items():
            of[docs[begins[a] : stops[a]]] = score[begins[a] : stops[a]]
            for b in others:
                both = of[docs[begins[b] : stops[b]]]
                together = both >= 0
                pairs.append((a, b))
                joint.append(int((both + score[begins[b] : stops[b]])[together].max(initial=0)))
            of[docs[begins[a] : stops[a]]] = -1
        return [ids, stops, docs, score, top, np.array(pairs, np.int64).ravel(), np.array(joint, np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_ids", "ids", "ends", "docs", "score", "top", "pairs", "joint"]
        for batch in batches:
            for k in range(batch.num_rows):
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in lists(batch, k)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids").slice(k, 1), *blobs], names)

    return blocks.mapInArrow(run, "doc_ids array<long>, ids binary, ends binary, docs binary, score binary, top binary, pairs binary, joint binary")


def bounds(top: list[int], joint: list[int]) -> list[int]:
    """The least bound of what the terms from each place on can add, from single and joint maxima; the last is 0.

    ``joint[i]`` bounds what terms i and i + 1 add to a document that has both.
    """
    least = [0] * (len(top) + 1)
    for i in range(len(top) - 1, -1, -1):
        least[i] = top[i] + least[i + 1]
        if i + 1 < len(top):
            least[i] = min(least[i], max(joint[i], top[i], top[i + 1]) + least[i + 2])
    return least


def best(lists: list[tuple[np.ndarray, np.ndarray]], bound: list[int], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, postings read) of a block's documents that may be among the best ``k`` and score at least ``floor``."""
    essential = next((i for i, b in enumerate(bound) if b < floor), len(lists))
    read = 0
    if not essential:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), read
    total = np.zeros(n_docs, np.int64)
    for docs, score in lists[:essential]:
        total[docs] += score
        read += len(docs)
    at = np.flatnonzero(total)
    got = total[at]
    for i in range(essential, len(lists) + 1):
        if len(got) > k:
            floor = max(floor, int(np.partition(got, len(got) - k)[len(got) - k]))
        stay = got + bound[i] >= floor
        at, got = at[stay], got[stay]
        if i < len(lists) and len(at):
            docs, score = lists[i]
            place = np.minimum(np.searchsorted(docs, at), len(docs) - 1)
            got = got + np.where(docs[place] == at, score[place], 0)
            read += len(at)
    return at, got, read


def search(blocks: DataFrame, model: Model, k: int, floors: dict[int, int]) -> DataFrame:
    """(key, doc_id, score): the best ``k`` documents of each block for each query, as far as they reach the query's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, ends, score, top, joint = (_bytes(batch, c, r, np.int64) for c in ("ids", "ends", "score", "top", "joint"))
                docs, doc_ids = _bytes(batch, "docs", r, np.int32), batch.column("doc_ids")[r].values
                # nulls come after all ids of equal score
                order_ids = doc_ids.fill_null(np.iinfo(np.int64).max).to_numpy()
                begins = [0, *ends.tolist()]
                together = dict(zip(map(tuple, _bytes(batch, "pairs", r, np.int64).reshape(-1, 2).tolist()), joint.tolist()))
                tops = top.tolist()
                row = np.full(len(model.names), -1)
                row[ids] = np.arange(len(ids))
                keys, places, found = [], [], []
                for key, query in model.queries:
                    own = row[query]
                    own = own[own >= 0].tolist()
                    if not own:
                        continue
                    bound = bounds([tops[t] for t in own], [together[p] for p in zip(own, own[1:])])
                    lists = [(docs[begins[t] : begins[t + 1]], score[begins[t] : begins[t + 1]]) for t in own]
                    at, got, _ = best(lists, bound, len(doc_ids), k, max(1, floors.get(key, 1)))
                    first = np.lexsort((order_ids[at], -got))[:k]
                    keys.append(np.full(len(first), key))
                    places.append(at[first])
                    found.append(got[first])
                if keys:
                    columns = [pa.array(np.concatenate(keys)), doc_ids.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(found))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "score"])

    return blocks.mapInArrow(run, "key long, doc_id long, score long")


def ranking(hits: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` best hits with their rank, of equals the smaller doc_id first; null ids come last."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, rounds: Rounds, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score for each item, scores above 0 only.

    Null and empty texts match nothing, on either side. Items equal in id and text are
    one item; those of one id and other texts are ranked each on its own. Repeated rows
    of documents are ranked each. Empty tables give no rows. Other columns aren't read.
    """
    blocks = rounds.put(index(docs), "index", ALONE)
    asked = rounds.put(queries(items), "queries")
    sums = rounds.put(_sums(blocks), "sums").agg(F.sum("documents"), F.sum("length"), F.count("*")).first()
    documents, length, n_blocks = (int(v or 0) for v in sums)
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    chunks = max(1, -(-n_terms // CHUNK_TERMS))
    schema = "key long, doc_id long, score long, rank int"
    if not documents:
        return asked.select("key", "item_id").join(asked.sparkSession.createDataFrame([], schema), "key").select("item_id", "rank", "doc_id", "score")
    lists = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select("t.terms", "t.df")
    wanted = asked.select(F.explode("terms").alias("terms")).distinct()
    df = rounds.put(lists.join(wanted, "terms", "left_semi").groupBy("terms").agg(F.sum("df").alias("df")), "df")
    made = []
    for chunk in range(chunks):
        own = asked.where(F.pmod("key", F.lit(chunks)) == chunk)
        told = df.join(own.select(F.explode("terms").alias("terms")).distinct(), "terms", "left_semi").orderBy("terms").collect()
        model = Model(own.orderBy("key").collect(), {r["terms"]: r["df"] for r in told}, documents, length)
        ready = rounds.put(impacts(blocks, model), "impacts", ALONE)
        some = ready.where(F.pmod(F.xxhash64("doc_ids"), F.lit(max(1, math.isqrt(n_blocks)))) == 0)
        floors = ranking(search(some, model, k, {}), k).groupBy("key").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
        known = {r["key"]: r["least"] for r in floors.collect()}
        made.append(rounds.put(ranking(search(ready, model, k, known), k), f"ranked-{chunk}"))
    found = made[0]
    for more in made[1:]:
        found = found.unionByName(more)
    return asked.select("key", "item_id").join(found, "key").select("item_id", "rank", "doc_id", "score")


def _sums(blocks: DataFrame) -> DataFrame:
    """(documents, length) of each block: documents with terms, and all terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [_bytes(batch, "n", k, np.int32) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in n]), pa.array([int(x.sum(dtype=np.int64)) for x in n])], ["documents", "length"])

    return blocks.select("n").mapInArrow(run, "documents long, length long")
