"""Byte-level BPE: merges folded by higher-order functions over distinct words.

Documents are dealt into chunks. Each chunk sends its distinct words, split by the
tokenizer's pattern, to parts by their hash, and a part's higher-order functions
encode each distinct word once: a fold starts with the ids of its bytes and merges,
until nothing merges, the neighbours whose union has the lowest rank (the leftmost of
equals). The ranks are a literal of the plan: a table of all unions that the rank
file knows. The ids go back to the chunks that sent the word, and documents are put
together there. A word travels once per chunk, however often it occurs. Ids decode
by concatenating the vocabulary's byte strings.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import lean, steps


def chunk_bytes(total: int) -> int:
    """Text bytes of a chunk: 12 MB for a GB, growing with the root of the input up to 64 MB."""
    return int(min(64 << 20, max(2 << 20, math.sqrt(1.6e5 * total))))


#: The characters of Unicode's White_Space property.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: Bits of an id, a rank and a place: three fit in a long.
BITS = 21
#: The rank of no union.
TOP = (1 << BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """The byte strings of a rank file, each with its rank, which is its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def unions(ranks: dict[bytes, int]) -> dict[int, dict[int, int]]:
    """Left id to right id to the id of their union, for all unions that have one."""
    out: dict[int, dict[int, int]] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                out.setdefault(left, {})[right] = rank
    return out


def displaced(known: dict[int, dict[int, int]], ids: int) -> tuple[list[int], list[int]]:
    """The sparse table of unions in one array: offsets by left id, and entries (left << BITS | union).

    The entry of (left, right) is at offset[left] + right; rows are laid over each other
    where their entries leave room, the fullest first. An entry of another left id, or
    -1, says that there is no union.
    """
    window = np.arange(4096)
    size = 3 * sum(map(len, known.values())) + len(window)
    taken, table = np.zeros(size + ids + len(window), bool), np.full(size + ids + len(window), -1, np.int64)
    offsets, draw = [0] * ids, np.random.default_rng(3)
    for left, row in sorted(known.items(), key=lambda x: -len(x[1])):
        columns = np.array(sorted(row))
        room = np.zeros(0, np.int64)
        while not len(room):  # the first place that fits, from a random one on
            start = int(draw.integers(0, size)) - int(columns[0])
            tried = start + window[max(0, -start) :]
            clash = np.zeros(len(tried), bool)
            for c in columns.tolist():
                clash |= taken[tried + c]
            room = tried[~clash]
        offsets[left] = int(room[0])
        taken[room[0] + columns] = True
        table[room[0] + columns] = [left << BITS | row[c] for c in columns.tolist()]
    return offsets, table[: int(np.flatnonzero(taken).max(initial=0)) + 1].tolist()


def _let(value: F.Column, use: Callable[[F.Column], F.Column]) -> F.Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _long(n: int) -> F.Column:
    return F.lit(n).cast("long")


class Ranks:
    """The rank file as one literal, and expressions that use it.

    The literal is bound once around an array of words, so that a task receives one copy.
    """

    def __init__(self, ranks: dict[bytes, int]):
        array = lambda some, kind: F.from_json(F.lit(json.dumps(some)), f"array<{kind}>")
        offsets, table = displaced(unions(ranks), max(ranks.values()) + 1)
        single = [ranks[bytes([i])] for i in range(256)]
        bytes_ = [ranks.get(bytes([a, b])) for a in range(256) for b in range(256)]
        self.literal = F.struct(array(offsets, "int").alias("offsets"), array(table, "bigint").alias("table"), array(single, "bigint").alias("single"), array(bytes_, "int").alias("bytes"))

    def encode(self, words: F.Column) -> F.Column:
        """The ids of each word of an array."""
        return _let(self.literal, lambda lit: F.transform(words, lambda w: self._word(lit, w)))

    def _rank(self, lit: F.Column, left: F.Column, right: F.Column) -> F.Column:
        """The id of the union of two ids (longs), TOP where the file has none."""
        entry = F.get(lit["table"], (F.get(lit["offsets"], left.cast("int")) + right).cast("int"))
        return _let(entry, lambda e: F.when(F.shiftright(e, BITS) == left, e.bitwiseAND(_long(TOP))).otherwise(_long(TOP)))

    def _word(self, lit: F.Column, word: F.Column) -> F.Column:
        """The ids of one word, an array of signed bytes.

        Each symbol is one long: the rank of its union with the next one, its place, and
        its id. So the least symbol says what merges next, the leftmost of equal ranks.
        """
        ids = F.transform(word, lambda b: F.get(lit["single"], b.cast("int").bitwiseAND(F.lit(255))))
        made = lambda rank, place, own: F.shiftleft(rank, 2 * BITS).bitwiseOR(place).bitwiseOR(own)
        own = lambda e: e.bitwiseAND(_long(TOP))
        place = lambda e: e.bitwiseAND(_long(TOP << BITS))

        def first(e: F.Column, i: F.Column) -> F.Column:
            following = _let(F.get(word, i + 1).cast("int").bitwiseAND(F.lit(255)), lambda b: F.get(lit["bytes"], F.get(word, i).cast("int").bitwiseAND(F.lit(255)) * 256 + b))
            return made(F.coalesce(following.cast("long"), _long(TOP)), F.shiftleft(i.cast("long").bitwiseAND(_long(TOP)), BITS), e)

        def merged(s: F.Column, e: F.Column, at: F.Column) -> F.Column:
            """The symbol ``e`` at ``at`` becomes its union with the next; it and the one before get new ranks."""
            new = F.shiftright(e, 2 * BITS)
            after = F.get(s, at + 1)
            symbol = made(F.when(after.isNull(), _long(TOP)).otherwise(self._rank(lit, new, own(after))), place(e), new)
            around = F.when(at == 1, F.array(symbol)).otherwise(_let(F.get(s, at - 2), lambda p: F.array(made(self._rank(lit, own(p), new), place(p), own(p)), symbol)))
            return F.concat(F.slice(s, 1, F.greatest(at - 2, F.lit(0))), around, F.slice(s, at + 2, F.size(s)))

        def step(s: F.Column, _: F.Column) -> F.Column:
            go = lambda e: F.when(e >= _long(TOP << 2 * BITS), s).otherwise(_let(F.array_position(s, e).cast("int"), lambda at: merged(s, e, at)))
            return _let(F.array_min(s), go)

        start = F.transform(ids, first)
        folded = F.aggregate(F.sequence(F.lit(2), F.size(word)), start, step)
        return F.transform(F.when(F.size(word) > 1, folded).otherwise(start), lambda e: own(e).cast("int"))


#: Text bytes that a task deals into chunks at a time.
PACKED_BYTES = 12 << 20


def packed(docs: DataFrame, chunks: int) -> DataFrame:
    """(chunk, docs): rows of (key, doc_id, text) dealt by key into compressed Arrow batches, far fewer and smaller than the rows."""

    def dealt(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        to = rows.column("key").to_numpy() % chunks
        some = np.unique(to)
        blobs = []
        for c in some.tolist():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 4))) as out:
                out.write_table(rows.take(pa.array(np.flatnonzero(to == c))).combine_chunks())
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(blobs, pa.binary())], ["chunk", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in steps(batches, "text"):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= PACKED_BYTES:
                yield dealt(held)
                held, size = [], 0
        if held:
            yield dealt(held)

    return docs.mapInArrow(run, "chunk long, docs binary")


#: White space before a space: there text isn't cut at spaces.
UNSAFE = re.compile(f"[{SPACE}] ")
UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


class _Chunk:
    """A chunk's documents, and its distinct words by part, in the order of their numbers.

    Text is first cut into units before white space that follows other characters:
    matches of the pattern never reach over that, and most units have been seen before.
    Most cuts are at single spaces; such units are kept without theirs.
    """

    def __init__(self, table: pa.Table, pattern: str, parts: int):
        rows = pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in table.column("docs")])
        order = np.argsort(rows.column("key").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        self.ids = rows.column("doc_id").to_pylist()
        self.texts = [t or "" for t in rows.column("text").to_pylist()]
        del rows
        self.unsafe = [bool(UNSAFE.search(t)) for t in self.texts]
        plain = dict.fromkeys(chain.from_iterable(self.first()))
        spaced = dict.fromkeys(chain.from_iterable(self.after()))
        split = regex.compile(pattern).findall
        number: dict[str, int] = {}

        def numbers(words: Sequence[str]) -> tuple[int, ...]:
            return tuple([number.setdefault(w, len(number)) for w in words])

        self.plain = {u: numbers(split(u)) for u in plain}
        letters = [u for u in spaced if u.isalpha()]
        self.spaced: dict[str, tuple[int, ...]] = {u: (number.setdefault(f" {u}", len(number)),) for u in letters}
        for u in spaced:
            if u in self.spaced:
                continue
            if u[-1:] in (".", ",") and u[:-1].isalpha():
                self.spaced[u] = numbers((f" {u[:-1]}", u[-1]))
            else:
                self.spaced[u] = numbers(split(f" {u}"))
        self.words = [w.encode() for w in number]
        del number
        part = np.array([xxhash.xxh3_64_intdigest(w) % parts for w in self.words], np.int64)
        self.by_part = {int(p): np.flatnonzero(part == p) for p in np.unique(part)}

    def first(self) -> Iterator[Sequence[str]]:
        """Each text's units that stay as they are: the first one, or all of a text that isn't cut at spaces."""
        for text, unsafe in zip(self.texts, self.unsafe):
            yield UNITS.findall(text) if unsafe else (text.partition(" ")[0],)

    def after(self) -> Iterator[Sequence[str]]:
        """Each text's units that a space precedes."""
        for text, unsafe in zip(self.texts, self.unsafe):
            yield () if unsafe else text.split(" ")[1:]


def _words_of(pattern: str, parts: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        chunk = _Chunk(table, pattern, parts)
        blobs = []
        for at in chunk.by_part.values():
            some = [chunk.words[i] for i in at.tolist()]
            blobs.append(np.array([len(some), *map(len, some)], "<u4").tobytes() + b"".join(some))
        n = len(blobs)
        return pa.table({"part": pa.array(list(chunk.by_part), pa.int64()), "chunk": pa.array([key[0].as_py()] * n, pa.int64()), "words": pa.array(blobs, pa.binary())})

    return run


def _distinct(table: pa.Table) -> pa.Table:
    """A part's distinct words, and for each chunk the numbers of the words it sent."""
    number: dict[bytes, int] = {}
    sent = []
    for blob in table.column("words"):
        data = blob.as_buffer()
        n = int(np.frombuffer(data, "<u4", 1)[0])
        ends = (4 * (n + 1) + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)).tolist()
        raw = data.to_pybytes()
        begins = [4 * (n + 1), *ends]
        sent.append(np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(begins, ends)), np.int32, n).tobytes())
    letters = pa.ListArray.from_arrays(np.cumsum([0, *map(len, number)], dtype=np.int32), np.frombuffer(b"".join(number), np.int8))
    chunks = pa.array([table.column("chunk").to_pylist()], pa.list_(pa.int64()))
    return pa.table({"part": table.column("part")[:1], "chunks": chunks, "sent": pa.array([sent], pa.list_(pa.binary())), "words": pa.ListArray.from_arrays(np.array([0, len(number)], np.int32), letters)})


def _returned(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, part, ids): the ids of the words that a chunk sent, with their numbers before."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids = batch.column("ids")[k].values
            cuts = ids.offsets.to_numpy().astype(np.int64)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<i4")
            lengths = np.diff(cuts)
            blobs = []
            for row in batch.column("sent")[k].values:
                at = np.frombuffer(row.as_buffer(), np.int32)
                n = lengths[at]
                places = np.repeat(cuts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
                blobs.append(n.astype("<u4").tobytes() + flat[places].astype(kind).tobytes())
            chunks = batch.column("chunks")[k].values
            yield pa.RecordBatch.from_arrays([chunks, pa.array([batch.column("part")[k].as_py()] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())], ["chunk", "part", "ids"])


def _joined(path: str, pattern: str, parts: int, ids_too: bool, kind: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The documents of a chunk from their words' ids."""
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()} | ({"ids": pa.binary()} if ids_too else {})

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        chunk = _Chunk(table, pattern, parts)
        tokens = {r: t for t, r in read_ranks(path).items()}
        n = len(chunk.words)
        del chunk.words
        coded, decimal, decoded = [b""] * (n if ids_too else 0), [""] * n, [b""] * n
        for part, blob in zip(told.column("part").to_pylist(), told.column("ids").to_pylist()):
            at = chunk.by_part[part].tolist()
            lengths = np.frombuffer(blob, "<u4", len(at))
            flat = np.frombuffer(blob, kind, -1, 4 * len(at)).tolist()
            numbers, texts = list(map(str, flat)), list(map(tokens.__getitem__, flat))
            cuts = [0, *np.cumsum(lengths, dtype=np.int64).tolist()]
            for i, a, b in zip(at, cuts, cuts[1:]):
                decimal[i], decoded[i] = " ".join(numbers[a:b]), b"".join(texts[a:b])
                if ids_too:
                    coded[i] = np.array(flat[a:b], "<i4").tobytes()

        def joined(joint: str | bytes, some: list) -> Iterator[str | bytes]:
            """Each document's words' entries, joined; units that recur are joined once."""
            plain, spaced = ({u: some[k[0]] if len(k) == 1 else joint.join([some[i] for i in k]) for u, k in units.items()} for units in (chunk.plain, chunk.spaced))
            for first, after in zip(chunk.first(), chunk.after()):
                yield joint.join([*map(plain.__getitem__, filter(None, first)), *map(spaced.__getitem__, after)])

        digest = lambda b: hashlib.sha256(b).hexdigest()
        # one kind after the other, so that one kind's units are held at a time
        numbers, listed = [], []
        for text in joined(" ", decimal):
            numbers.append(text.count(" ") + 1 if text else 0)
            listed.append(digest(text.encode()))
        columns = [chunk.ids, numbers, listed, [digest(b) for b in joined(b"", decoded)]]
        if ids_too:
            columns.append(list(joined(b"", coded)))
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    return run


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row; ids are 32-bit little-endian, and can be left out.

    Null and empty texts have no ids. The digests are of the decimal ids joined by a
    space and of the bytes that the ids decode to. Special tokens are ordinary text.
    Repeated rows stay rows.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes(total)))
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    dealt = packed(named.select("key", "doc_id", "text"), chunks)
    sent = dealt.groupBy("chunk").applyInArrow(lean(_words_of(pattern, chunks)), "part long, chunk long, words binary")
    distinct = sent.groupBy("part").applyInArrow(lean(_distinct), "part long, chunks array<bigint>, sent array<binary>, words array<array<tinyint>>")
    known = read_ranks(path)
    kind = "<u2" if max(known.values()) < 1 << 16 else "<u4"
    ranks = Ranks(known)
    coded = distinct.select("part", "chunks", "sent", ranks.encode(F.col("words")).alias("ids"))
    told = coded.mapInArrow(partial(_returned, kind), "chunk long, part long, ids binary")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if ids else "")
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(lean(_joined(path, pattern, chunks, ids, kind)), schema)
