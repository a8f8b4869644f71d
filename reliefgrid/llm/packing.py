"""Shortest-pack-first packing of tokenised documents over their length histogram.

Lengths are placed longest first, whole counts at a time: the open packs with
the most room take the next length; without room a new pack opens. What goes
through the driver is the histogram (at most ``size`` counts) and the packing
patterns made from it; pieces find their place by their rank within their length.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import release, steps, texts
from reliefgrid.rounds import Rounds

#: Words whose ids a task remembers; beyond that it starts anew.
REMEMBERED = 500_000
#: Parts that a length's pieces are ranked in, so that one very frequent length isn't one task.
RANK_PARTS = 256
#: Words that are tokenised together.
TOGETHER = 256


#: A full stop or comma after a letter is a token of its own; set apart, it leaves one word fewer to remember.
POINT = re.compile(rb"(?<=[a-z])(?=[.,])")


class WordIds:
    """The ids of a text as those of its words, in little-endian 32-bit form.

    Right for tokenizers that lower-case and never join over white space, as the
    word vocabularies with word ends do: a word's ids don't depend on its neighbours.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Letters-only words by the hundred: the ids of the k-th are those of the k-th pre-token."""
        plain, other = [], []
        for w in words:
            s = w.decode("utf-8", "replace")
            (plain if s.isalpha() else other).append((w, s))
        for i in range(0, len(plain), TOGETHER):
            some = plain[i : i + TOGETHER]
            found = self.tokenizer.encode(" ".join(s for _, s in some), add_special_tokens=False)
            at = found.word_ids
            if at and at[-1] == len(some) - 1 and len(set(at)) == len(some):
                cuts = np.searchsorted(np.asarray(at), np.arange(len(some) + 1)).tolist()
                packed = array("I", found.ids).tobytes()
                self.known.update((w, packed[4 * a : 4 * b]) for (w, _), a, b in zip(some, cuts, cuts[1:]))
            else:
                other += some
        for i in range(0, len(other), TOGETHER):
            some = other[i : i + TOGETHER]
            for (w, _), found in zip(some, self.tokenizer.encode_batch([s for _, s in some], add_special_tokens=False)):
                self.known[w] = array("I", found.ids).tobytes()

    def __call__(self, text: list[bytes | None]) -> Iterator[bytes]:
        """The packed ids of each text."""
        words = [POINT.sub(b" ", (t or b"").lower()).split() for t in text]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if new := {w for ws in words for w in ws} - self.known.keys():
            self._learn(list(new))
        for ws in words:
            yield b"".join(map(self.known.__getitem__, ws))


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer for each Python worker and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document's ids and the end id, cut every ``size`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stop = word_ids(tokenizer), array("I", [end]).tobytes()
        for batch in steps(batches, "text"):
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for row, ids in enumerate(encode(texts(batch, "text"))):
                ids += stop
                for a in range(0, len(ids), 4 * size):
                    piece = ids[a : a + 4 * size]
                    rows.append(row)
                    starts.append(a // 4)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    totals.append(len(ids) // 4)
            own = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        release()

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def patterns(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, packs of that kind) from a histogram of lengths."""
    room: dict[int, dict[tuple[int, ...], int]] = {}
    heap: list[int] = []

    def put(pack: tuple[int, ...], left: int, n: int) -> None:
        if left not in room:
            room[left] = {}
            heapq.heappush(heap, -left)
        room[left][pack] = room[left].get(pack, 0) + n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            left = -heap[0] if heap else -1
            if left < length:
                put((length,), size - length, n)
                break
            pack, have = room[left].popitem()
            if not room[left]:
                del room[left]
                heapq.heappop(heap)
            take = min(n, have)
            if have > take:
                put(pack, left, have - take)
            put((*pack, length), left - length, take)
            n -= take
    return [(pack, n) for left in sorted(room) for pack, n in room[left].items()]


def places(found: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """One row for each position of each pattern: its length, first rank there, first sequence and offset.

    Rows are ordered by (length, rank), for a search by both.
    """
    rows, base = [], 0
    for pack, n in found:
        offset = 0
        for length in pack:
            rows.append((length, n, base, offset))
            offset += length
        base += n
    rows.sort(key=lambda r: r[0])
    table = np.array(rows, np.int64).reshape(-1, 4)
    before = np.cumsum(table[:, 1]) - table[:, 1]
    first = np.searchsorted(table[:, 0], table[:, 0])
    return {"length": table[:, 0], "before": before, "rank": before - before[first] if len(rows) else before, "sequence": table[:, 2], "offset": table[:, 3]}


def ranked(cut: DataFrame) -> DataFrame:
    """The pieces with their rank within their length, from 0, without a task that holds a whole length."""
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_PARTS)).cast("int")
    dealt = cut.withColumn("part", part)
    order = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    inside = dealt.withColumn("inside", F.row_number().over(order) - 1)
    sums = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = sums.select("length", "part", before.alias("ahead"))
    return inside.join(offsets, ["length", "part"]).withColumn("rank", F.col("ahead") + F.col("inside")).drop("part", "inside", "ahead")


def pack(cut: DataFrame, rounds: Rounds, size: int = 4096) -> DataFrame:
    """Pieces (with a ``length`` of at most ``size``) with their sequence_id and offset there.

    Every piece keeps its row; pieces of a sequence follow each other without gaps
    from offset 0. No pieces: no rows.
    """
    cut = rounds.put(cut, "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    at = places(patterns(counts, size))
    begin = {length: int(at["before"][i]) for i, length in reversed(list(enumerate(at["length"].tolist())))}
    return ranked(cut).mapInArrow(_placer(at, begin), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _placer(at: dict[str, np.ndarray], begin: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            overall = np.array([begin[x] for x in length.tolist()], np.int64) + rank
            i = np.searchsorted(at["before"], overall, side="right") - 1
            sequence = at["sequence"][i] + rank - at["rank"][i]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(at["offset"][i])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run
