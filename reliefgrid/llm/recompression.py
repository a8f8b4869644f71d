"""Substring dedup by recompression: repeats shown by shared symbols.

Words are the first symbols. A round names maximal runs of a symbol, then deals the
symbols into left and right ones and names each pair of a left and a right
neighbour. Names are hashes of what they stand for, so they are the same in every
document and no table of names is kept. Where a boundary lies depends on the near
neighbours only; each symbol carries the span of words that settled it, and inside
two equal passages the symbols settled by words of the passage are equal.

Every window of ``width`` words chooses, of the symbols settled inside it, the one
that covers most letters (of several the smallest name). Equal windows choose equal symbols, so a window
repeats only if its symbol occurs in another document. The job, over buckets of
documents and buckets of names:

1. each document's chosen symbols go to their names' buckets; symbols of two
   documents are shared, and their documents hear of it;
2. the windows that chose shared symbols go to their hashes' buckets; the smallest
   document of each equal window keeps it, and the others hear of it;
3. the words that those windows cover are removed.

Hot symbols and windows: a bucket of documents settles what it sees itself. Of a
symbol in several of its documents two witnesses go on, of a window only the
smallest document's; what is settled already is dealt by document. So what a very
frequent passage sends to one name's bucket grows with the number of buckets, not
of documents. Within a bucket 64 bits tell names apart; the bucket comes from a
second hash, so that names have as many more bits as there are buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliefgrid.llm.arrow import fresh, lean

ROUNDS = 2
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_RANDOM = np.random.default_rng(11)
_BYTES = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 2**64)
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
#: Words beyond this length are hashed one by one.
LONG_WORD = 64


def bucket_bytes(total: int) -> int:
    """Text bytes for each bucket: 2 MB for a GB, growing with the root of the input up to 64 MB.

    Frequent names cost as many witnesses as there are buckets of documents, and
    a bucket must fit in a task many times over.
    """
    return int(min(64 << 20, max(2 << 20, math.sqrt(5000 * total))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _salt(kind: int) -> np.uint64:
    return np.uint64(int(_M1) * kind % 2**64)


def _name(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    return _mix(_mix(a + _salt(kind)) + b * _M1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes and lengths of the words of texts that lie end to end, and where each text's words begin.

    A word's hash comes from differences of one running sum over all bytes.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (edge[1:] | np.r_[~inside[1:], True])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_BASE, n), out=sums[1:])
    length = ends - starts
    hashes = _mix((sums[ends] - sums[starts]) * _powers(_BACK, n)[starts] + _M1 * length.astype(np.uint64))
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 1)
    return hashes, length, np.searchsorted(starts, offsets)


def symbols(words: np.ndarray, length: np.ndarray, begin: np.ndarray, rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, ...]]:
    """For each level: names, letters covered, and first and end of the words that settle each symbol.

    A symbol beside the edge of its text was settled by the edge, not by words; its
    span reaches beyond every word.
    """
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    name, cs, ce = words, np.arange(len(words)), np.arange(1, len(words) + 1)
    beyond = np.int64(1) << 40
    yield name, length, cs, ce
    for r in range(1, rounds + 1):
        if not len(name):
            return
        for kind in (2 * r, 2 * r + 1):
            joined = text[1:] == text[:-1]
            left = np.r_[-beyond, np.where(joined, cs[:-1], -beyond)]
            right = np.r_[np.where(joined, ce[1:], beyond), beyond]
            if kind % 2 == 0:  # runs: both neighbours must be seen to differ
                one = joined & (name[1:] == name[:-1])
                first = np.flatnonzero(np.r_[True, ~one])
                last = np.r_[first[1:], len(name)] - 1
                count = last - first + 1
                new = np.where(count > 1, _name(name[first], count.astype(np.uint64), kind), name[first])
                ncs, nce = left[first], right[last]
            else:  # pairs: a left symbol must be seen beside what follows, a right one beside what precedes
                is_left = (_mix(name + _salt(kind)) >> np.uint64(63)) == 0
                pair = joined & is_left[:-1] & ~is_left[1:]
                first = np.flatnonzero(~np.r_[False, pair])
                paired = np.r_[pair, False][first]
                last = first + paired
                new = np.where(paired, _name(name[first], name[last], kind), name[first])
                ncs = np.where(paired | is_left[first], cs[first], left[first])
                nce = np.where(paired | ~is_left[first], ce[last], right[last])
            length = np.add.reduceat(length, first)
            name, text = new, text[first]
            cs, ce = np.minimum(ncs, cs[first]), np.maximum(nce, ce[last])
        yield name, length, cs, ce


def chosen(words: np.ndarray, length: np.ndarray, begin: np.ndarray, width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols that windows choose: (name, first window, windows) of each run of windows of a text with one name."""
    n = len(words)
    window = np.zeros(n + 1, np.int64)
    whole = np.flatnonzero(np.diff(begin) >= width)
    np.add.at(window, begin[whole], 1)
    np.add.at(window, begin[whole + 1] - width + 1, -1)
    p = np.flatnonzero(np.cumsum(window)[:-1])
    name = np.full(len(p), np.iinfo(np.uint64).max)
    for sym, covered, cs, ce in symbols(words, length, begin, rounds):
        settled = (cs >= 0) & (ce <= n)  # by words, not by the edge of a text; the others' spans advance with them
        sym, covered, cs, ce = sym[settled], covered[settled], cs[settled], ce[settled]
        # Most letters first: such symbols are rare, and few windows then share theirs by chance.
        sym = ((np.uint64(63) - np.minimum(covered, 63).astype(np.uint64)) << np.uint64(58)) | (sym >> np.uint64(6))
        # A window's symbols are neighbours: the least name by overlapping powers of two.
        a, b = np.searchsorted(cs, p), np.searchsorted(ce, p + width, side="right")
        some = np.flatnonzero(b > a)
        a, b = a[some], b[some]
        least, size, best = sym, 1, np.zeros(len(some), np.uint64)
        while len(a) and size <= width:
            here = ((b - a) >= size) & ((b - a) < 2 * size)
            best[here] = np.minimum(least[a[here]], least[b[here] - size])
            least = np.minimum(least, np.r_[least[size:], np.full(min(size, len(least)), np.iinfo(np.uint64).max, np.uint64)])
            size *= 2
        name[some] = np.minimum(name[some], best)
    text = np.searchsorted(begin, p, side="right")
    first = np.flatnonzero(np.r_[True, (np.diff(p) != 1) | (np.diff(text) != 0) | (name[1:] != name[:-1])][: len(p)])
    return name[first], p[first], np.diff(np.r_[first, len(p)])


def windows(words: np.ndarray, p: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the windows that begin at ``p``."""
    out = []
    for base in (_M2, _M3):
        h = np.zeros(len(p), np.uint64)
        for j in range(width):
            h = (h + words[p + j]) * base
            h ^= h >> np.uint64(29)
        out.append(_mix(h))
    return out[0], out[1]


# Rows travel as blobs: a bucket's columns, byte planes apart so that they shrink, documents as differences.
_COLUMNS = (("name", np.uint64), ("doc", np.int64), ("copy", np.int32), ("p", np.int32), ("n", np.int32))


def _blob(rows: dict[str, np.ndarray]) -> bytes:
    out = []
    for c, kind in _COLUMNS:
        values = rows[c].astype(kind)
        if c in ("doc", "p"):
            values = np.diff(values, prepend=values.dtype.type(0))
        out.append(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())
    return len(rows["doc"]).to_bytes(8, "little") + b"".join(out)


def _rows(blobs: list[bytes]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {c: [] for c, _ in _COLUMNS}
    for blob in blobs:
        n, at = int.from_bytes(blob[:8], "little"), 8
        for c, kind in _COLUMNS:
            size = np.dtype(kind).itemsize
            planes = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n)
            values = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
            parts[c].append(np.cumsum(values, dtype=kind) if c in ("doc", "p") else values)
            at += n * size
    return {c: np.concatenate(parts[c]) if parts[c] else np.zeros(0, kind) for c, kind in _COLUMNS}


def _take(rows: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {c: v[at] for c, v in rows.items()}


def _dealt(rows: dict[str, np.ndarray], bucket: np.ndarray) -> pa.Table:
    """One blob for each bucket, its rows by document and place."""
    order = np.lexsort((rows["p"], rows["copy"], rows["doc"], bucket))
    bucket = bucket[order]
    first = np.flatnonzero(np.r_[True, np.diff(bucket) != 0][: len(bucket)])
    blobs = [_blob(_take(rows, order[a:b])) for a, b in zip(first, np.r_[first[1:], len(bucket)])]
    return pa.table({"bucket": pa.array(bucket[first], pa.int64()), "rows": pa.array(blobs, pa.binary())})


def _of(doc: np.ndarray, buckets: int) -> np.ndarray:
    """A document's bucket; the same as in ``_bucketed``."""
    return (_mix(doc.view(np.uint64) + _M1) % np.uint64(buckets)).astype(np.int64)


class _Texts:
    """The documents of a bucket in the order of doc_id and text, with their words' hashes."""

    def __init__(self, table: pa.Table, doc_id: str, text: str):
        ids = table.column(doc_id).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = table.column(text).cast(pa.large_binary()).combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        self.bytes = texts.to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], self.bytes[i] or b""))
        self.ids, self.bytes = ids[order], [self.bytes[i] or b"" for i in order]
        self.order = order
        n = len(order)
        before = np.arange(n) - np.searchsorted(self.ids, self.ids)
        self.copy = before.astype(np.int32)

    def hashed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        offsets = np.cumsum([0, *map(len, self.bytes)])
        return word_hashes(np.frombuffer(b"".join(self.bytes), np.uint8), offsets)

    def place(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        """The document of each row."""
        return np.searchsorted(self.ids, rows["doc"]) + rows["copy"]


def _symbols_of(doc_id: str, text: str, width: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        held = _Texts(table, doc_id, text)
        words, length, begin = held.hashed()
        name, p, n = chosen(words, length, begin, width)
        row = np.searchsorted(begin, p, side="right") - 1
        rows = {"name": name, "doc": held.ids[row], "copy": held.copy[row], "p": (p - begin[row]).astype(np.int32), "n": n.astype(np.int32)}
        order = np.lexsort((rows["doc"], name))
        by, doc = name[order], rows["doc"][order]
        first = np.flatnonzero(np.r_[True, by[1:] != by[:-1]][: len(by)])
        last = np.r_[first[1:], len(by)] - 1
        known = np.repeat(doc[first] != doc[last], last - first + 1)
        # n = 0 marks a witness, n < 0 a run that is known to be shared.
        seen = _take(rows, order[known])
        ends = np.concatenate([first, last])[np.tile(doc[first] != doc[last], 2)]
        witness = _take(rows, order[ends])
        alone = _take(rows, order[~known])
        witness["n"] = np.zeros_like(witness["n"])
        seen["n"] = -seen["n"]
        parts = [alone, witness, seen]
        to = [(_mix(x["name"] + _M3) % np.uint64(buckets)).astype(np.int64) for x in (alone, witness)] + [_of(seen["doc"], buckets)]
        seen["name"] = np.zeros_like(seen["name"])
        return _dealt({c: np.concatenate([x[c] for x in parts]) for c, _ in _COLUMNS}, np.concatenate(to))

    return run


def _shared(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Runs whose symbol another document has too, dealt by document."""

    def run(table: pa.Table) -> pa.Table:
        rows = _rows(table.column("rows").to_pylist())
        order = np.lexsort((rows["doc"], rows["name"]))
        order = order[rows["n"][order] >= 0]
        by, doc = rows["name"][order], rows["doc"][order]
        first = np.flatnonzero(np.r_[True, by[1:] != by[:-1]][: len(by)])
        last = np.r_[first[1:], len(by)] - 1
        shared = order[np.repeat(doc[first] != doc[last], last - first + 1)]
        out = _take(rows, np.concatenate([shared[rows["n"][shared] > 0], np.flatnonzero(rows["n"] < 0)]))
        out["n"], out["name"] = np.abs(out["n"]), np.zeros_like(out["name"])
        return _dealt(out, _of(out["doc"], buckets))

    return run


def _windows_of(doc_id: str, text: str, width: int, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        runs = _rows(told.column("rows").to_pylist())
        held = _Texts(table, doc_id, text)
        if not len(runs["doc"]):
            return _dealt(runs, np.zeros(0, np.int64))
        words, _, begin = held.hashed()
        n = runs["n"]
        row = held.place(runs)
        at = np.unique(np.repeat(begin[row] + runs["p"], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        row = np.searchsorted(begin, at, side="right") - 1
        name, other = windows(words, at, width)
        rows = {"name": name, "doc": held.ids[row], "copy": held.copy[row], "p": (at - begin[row]).astype(np.int32), "n": np.ones(len(at), np.int32)}
        order = np.lexsort((rows["doc"], name, other))
        by, too, doc = name[order], other[order], rows["doc"][order]
        first = np.flatnonzero(np.r_[True, (by[1:] != by[:-1]) | (too[1:] != too[:-1])])
        least = np.repeat(doc[first], np.diff(np.r_[first, len(by)]))
        later = doc > least
        # n = -1 marks a window that is known to repeat a smaller document of this bucket.
        rows["n"][order[later]] = -1
        rows["name"][order[later]] = 0
        bucket = (other % np.uint64(buckets)).astype(np.int64)
        bucket[order[later]] = _of(rows["doc"][order[later]], buckets)
        return _dealt(rows, bucket)

    return run


def _later(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Windows that a smaller document has too, dealt by document."""

    def run(table: pa.Table) -> pa.Table:
        rows = _rows(table.column("rows").to_pylist())
        order = np.lexsort((rows["doc"], rows["name"]))
        order = order[rows["n"][order] > 0]
        by, doc = rows["name"][order], rows["doc"][order]
        first = np.flatnonzero(np.r_[True, by[1:] != by[:-1]][: len(by)])
        least = np.repeat(doc[first], np.diff(np.r_[first, len(by)]))
        out = _take(rows, np.concatenate([order[doc > least], np.flatnonzero(rows["n"] < 0)]))
        out["n"], out["name"] = np.ones_like(out["n"]), np.zeros_like(out["name"])
        return _dealt(out, _of(out["doc"], buckets))

    return run


def _kept_of(doc_id: str, text: str, width: int, names: list[str], new: tuple[str, str, str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        rows = _rows(told.column("rows").to_pylist())
        held = _Texts(table, doc_id, text)
        row = held.place(rows)
        order = np.argsort(row, kind="stable")
        row, p = row[order], rows["p"][order]
        cuts = np.searchsorted(row, np.arange(len(held.ids) + 1)).tolist()
        n_words, n_removed, kept = [], [], []
        for i, t in enumerate(held.bytes):
            words = t.split()
            gone = 0
            if cuts[i] < cuts[i + 1]:
                cover = np.zeros(len(words) + 1, np.int32)
                at = p[cuts[i] : cuts[i + 1]]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + width, -1)
                stay = np.cumsum(cover)[:-1] == 0
                gone = len(words) - int(stay.sum())
                n_words.append(len(words))
                words = list(compress(words, stay.tolist()))
            else:
                n_words.append(len(words))
            n_removed.append(gone)
            kept.append(b" ".join(words))
        own = table.take(pa.array(held.order, pa.int64())).select(names)
        made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.Table.from_arrays([*own.columns, *made], names=[*names, *new])

    return run


def remove_repeats(docs: DataFrame, width: int = 13, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, new: tuple[str, str, str] = ("n_words", "n_removed", "kept")) -> DataFrame:
    """The columns ``keep`` (all, unless named) of each row, with n_words, n_removed and kept, or as ``new`` names these.

    ``kept`` holds, joined by one space, the words outside every window of ``width``
    words that also begins in a document with a smaller doc_id; windows are judged on
    the whole input. Words are runs without ASCII white space. Null and empty texts
    have no words. Texts shorter than a window lose nothing. Rows that share a doc_id
    are no smaller documents of each other. Rows without a doc_id are neither judged nor
    count as smaller. An input column with the name of a new one raises an error.
    """
    keep = docs.columns if keep is None else keep
    if taken := {c.lower() for c in keep} & {c.lower() for c in new}:
        raise ValueError(f"the input already has {sorted(taken)}")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes(total)))
    bucket = fresh(docs.columns, "bucket")
    wanted = list(dict.fromkeys([*keep, doc_id, text]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(doc_id)
            known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            to = pa.array(_of(known, buckets), mask=~ids.is_valid().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, to], [*batch.schema.names, bucket])

    chosen_docs = docs.select(*wanted)
    dealt = chosen_docs.mapInArrow(place, T.StructType([*chosen_docs.schema.fields, T.StructField(bucket, T.LongType())]))
    judged = dealt.where(F.col(bucket).isNotNull())
    rows = "bucket long, rows binary"
    names = judged.groupBy(bucket).applyInArrow(lean(_symbols_of(doc_id, text, width, buckets)), rows)
    told = names.groupBy("bucket").applyInArrow(lean(_shared(buckets)), rows)
    seen = judged.groupBy(bucket).cogroup(told.groupBy("bucket")).applyInArrow(lean(_windows_of(doc_id, text, width, buckets)), rows)
    later = seen.groupBy("bucket").applyInArrow(lean(_later(buckets)), rows)
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(c, k) for c, k in zip(new, (T.LongType(), T.LongType(), T.StringType())))])
    out = judged.groupBy(bucket).cogroup(later.groupBy("bucket")).applyInArrow(lean(_kept_of(doc_id, text, width, keep, new)), schema)
    unnamed = docs.where(F.col(doc_id).isNull())
    words = F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    rest = unnamed.select(*keep, F.size(words).cast("long").alias(new[0]), F.lit(0).cast("long").alias(new[1]), F.array_join(words, " ").alias(new[2]))
    return out.unionByName(rest)
