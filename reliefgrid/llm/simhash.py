"""SimHash near-duplicates through the popcounts of fingerprint segments.

A fingerprint of 64 bits is cut into 16 segments of 4 bits. Its cell is the
vector of the segments' popcounts, packed into one long, 4 bits each. The
Manhattan distance of two cells is a lower bound of the Hamming distance, so
fingerprints within 2 bits have cells within distance 2 - and then some cell lies
within distance 1 of both. Each distinct fingerprint therefore goes to its own
cell and to the at most 32 cells at distance 1; fingerprints that meet in a cell
are verified exactly by the popcount of their difference. Random fingerprints
fall on about 2^30 cells, so meetings stay few where a ball of distance 2 would
take 545 copies a row. Equal fingerprints are one node with any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import steps, texts
from reliefgrid.llm.graph import components
from reliefgrid.rounds import Rounds

SEED = 42
#: Shingles whose bits are counted in one step, so that a very long text needs bounded memory.
COUNTED = 1 << 16


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """The unsigned fingerprint of a text's word shingles; 0 without words.

    A-Z count as lower case; words are runs without ASCII white space; shingles
    count as often as they occur; a text of fewer words is one shingle.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    begins = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_digest
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(begins, begins[width:])]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNTED):
        some = np.frombuffer(b"".join(hashes[i : i + COUNTED]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            fps = np.array([fingerprint(t, width) for t in texts(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def cells(fps: DataFrame) -> DataFrame:
    """(fp, own, cell): each fingerprint at its own cell and at those at distance 1."""
    # The four bits of each segment, summed in place: at most 4, so no sum reaches the next segment or the sign.
    own = F.expr(" + ".join(f"(shiftrightunsigned(fp, {i}) & {int('1' * 16, 16)}L)" for i in range(4)))
    near = F.expr(
        "flatten(transform(sequence(0, 60, 4), i -> filter(array("
        "if((shiftrightunsigned(own, i) & 15) < 4, own + shiftleft(1L, i), null),"
        "if((shiftrightunsigned(own, i) & 15) > 0, own - shiftleft(1L, i), null)), x -> x is not null)))"
    )
    return fps.select("fp", own.alias("own")).select("fp", "own", F.explode(F.concat(F.array("own"), near)).alias("cell"))


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """(a, b), a < b: the distinct fingerprints that differ in at most ``bits`` (up to 2) bits."""
    if not 0 <= bits <= 2:
        raise ValueError("cells at distance 1 find differences of at most 2 bits")
    at = cells(fps)
    a = at.select("cell", F.col("fp").alias("a"), F.col("own").alias("own_a"))
    b = at.select("cell", F.col("fp").alias("b"), F.col("own").alias("own_b"))
    # A pair of one cell meets there alone; neighbours meet at the smaller of both; others at one or two cells between.
    once = F.when(F.col("own_a") == F.col("own_b"), F.col("cell") == F.col("own_a")).otherwise(
        ~((F.col("cell") == F.col("own_a")) & (F.col("own_b") < F.col("own_a")) | (F.col("cell") == F.col("own_b")) & (F.col("own_a") < F.col("own_b")))
    )
    # Spark sizes the copies like the fingerprints they come from, and would broadcast them; both sides are shuffled.
    met = a.hint("merge").join(b.hint("merge"), "cell").where((F.col("a") < F.col("b")) & once)
    return met.where(F.expr(f"bit_count(a ^ b) <= {bits}")).select("a", "b")


def near_duplicates(docs: DataFrame, rounds: Rounds, doc_id: str = "doc_id", text: str = "text", width: int = 3, bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Rows link where their fingerprints differ in at most ``bits`` bits, those
    without words (fingerprint zero, null texts too) like any other; component_id
    is the smallest doc_id that links reach. Repeated rows stay rows. A null doc_id
    stays a row and is never the smallest, unless its component has no other.
    """
    fps = rounds.put(fingerprints(docs, doc_id, text, width), "fingerprints")
    distinct = rounds.put(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(distinct.select("fp"), bits), rounds)
    roots = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = rounds.put(roots, "roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
