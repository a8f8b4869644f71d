"""WARC archives of single compressed records with an embedded dictionary.

Every archive is one file: a skippable frame that holds a Zstandard dictionary,
trained on the archive's own first records, then a warcinfo record and one frame per
record, so that each record can be read alone. Files are written by Spark's text
writer, which puts bytes as they are on any file system and survives lost executors;
its line separator is an empty skippable frame, which readers pass over.

A payload that an earlier-numbered page holds as well is not stored again: the
record is a revisit that names the response, and keeps the HTTP header.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import steps
from reliefgrid.rounds import delete

# Fixed values of the formats: the magic numbers of a skippable frame and of the one with the dictionary.
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this many bytes are never revisits.
LEAST_REVISIT = 100
#: Payload bytes of an archive; its records' bytes that the dictionary is trained on; and the dictionary's size.
ARCHIVE_BYTES, TRAINED_BYTES, DICTIONARY_BYTES = 16 << 20, 2 << 20, 64 << 10
LEVEL = 6
#: Compressed bytes that a reader takes at a time.
READ_BYTES = 64 << 10


def record_id(page_id: int | None, also: str = "") -> str:
    """A record's name, from its page_id; without one, from its url and digest."""
    name = f"page {page_id}" if page_id is not None else f"unnamed {also}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One response, or a revisit of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, f'{url} {digest}')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or 'about:blank').translate({13: '%0D', 10: '%0A'})}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Page-ID: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _trained(records: list[bytes]) -> bytes:
    """A dictionary from records; empty where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, d=8, k=1024, split_point=1.0).as_bytes()
    except zstandard.ZstdError:
        return b""


def _archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frames of one archive: the first records train the dictionary, and all are compressed by it."""
    waiting, size, compressor = [], 0, None

    def start() -> list[bytes]:
        nonlocal compressor
        words = _trained(waiting)
        known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_FULLDICT) if words else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        stored = zstandard.ZstdCompressor(level=LEVEL).compress(words)
        info = b"software: reliefgrid\r\nformat: WARC File Format 1.1\r\n"
        head = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: " + record_id(-1).encode() + b"\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: "
        first = [DICTIONARY_MAGIC + len(stored).to_bytes(4, "little") + stored] if words else []
        out = [*first, compressor.compress(head + str(len(info)).encode() + b"\r\n\r\n" + info + b"\r\n\r\n"), *map(compressor.compress, waiting)]
        waiting.clear()
        return out

    for batch in steps(batches, "payload"):
        frames = []
        for r in batch.to_pylist():
            made = record(r["page_id"], r["url"], (r["payload"] or "").encode(), r["refers_to"], r["digest"])
            if compressor is None:
                waiting.append(made)
                size += len(made)
                if size >= TRAINED_BYTES:
                    frames += start()
            else:
                frames.append(compressor.compress(made))
        if frames:
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(start(), pa.binary())], ["frame"])


def resolved(pages: DataFrame, archives: int, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to), dealt by page_id into ``archives`` partitions: who revisits whom.

    Of rows with equal payloads of at least LEAST_REVISIT bytes the one with the
    smallest page_id is the response; rows that share that page_id are responses, too.
    Rows without a page_id are responses that nothing refers to; their records have no
    page id. Null payloads are empty. Only digests are grouped; a payload moves once.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    seen = rows.where((F.octet_length("payload") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).select("page_id", F.sha2("payload", 256).alias("digest"))
    first = seen.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # rows of one page_id are few: their revisits are a short list beside it, so that the join needs no key but page_id
    later = seen.join(first, "digest").where(F.col("page_id") > F.col("first")).groupBy("page_id").agg(F.collect_set(F.struct("digest", "first")).alias("later"))
    unnamed = rows.where("page_id is null").repartition(archives).withColumn("digest", F.sha2("payload", 256))
    dealt = rows.where("page_id is not null").repartition(archives, "page_id").withColumn("digest", F.sha2("payload", 256))
    both = dealt.join(later.repartition(archives, "page_id"), "page_id", "left")
    mine = F.get(F.filter("later", lambda x: x["digest"] == F.col("digest")), F.lit(0))["first"]
    return both.select("page_id", "url", "payload", "digest", mine.alias("refers_to")).unionByName(unnamed.withColumn("refers_to", F.lit(None).cast("long")))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per row into archives ``pages-NNNNN.warc.zst`` of the folder, which must not exist."""
    spark = pages.sparkSession
    total = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    archives = max(1, -(-total // ARCHIVE_BYTES))
    frames = resolved(pages, archives, page_id, url, html).mapInArrow(_archive, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", EMPTY_FRAME).option("compression", "none").text(f"{folder}/parts")
    jvm = spark._jvm
    parts = jvm.org.apache.hadoop.fs.Path(f"{folder}/parts")
    files = parts.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in files.listStatus(parts) if s.getPath().getName().startswith("part-"))
    for i, name in enumerate(names):
        files.rename(jvm.org.apache.hadoop.fs.Path(f"{folder}/parts/{name}"), jvm.org.apache.hadoop.fs.Path(f"{folder}/pages-{i:05d}.warc.zst"))
    delete(spark, f"{folder}/parts")


def frames_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one for each frame."""
    view, at, known = memoryview(archive), 0, None
    while at < len(view):
        magic = bytes(view[at : at + 4])
        if magic[1:] == DICTIONARY_MAGIC[1:] and 0x50 <= magic[0] <= 0x5F:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if magic == DICTIONARY_MAGIC and at == 0:
                held = bytes(view[8 : 8 + size])
                known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(held) if held[:4] == b"\x28\xb5\x2f\xfd" else held)
            at += 8 + size
            continue
        reader, out = zstandard.ZstdDecompressor(dict_data=known).decompressobj(), []
        while not reader.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            out.append(reader.decompress(view[at : at + READ_BYTES]))
            at = min(len(view), at + READ_BYTES)
        at -= len(reader.unused_data)
        yield b"".join(out)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, in lower case, and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def read(spark, folder: str, payloads: bool = False) -> DataFrame:
    """A row for each response and revisit: page_id, payload_bytes, payload_digest, record_type, refers_to, url (and payload).

    A response's length and digest are those of the payload read, and a digest that
    differs from the header's raises an error. A revisit has its payload's from its
    headers, and null as payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[dict] = []
                for data in frames_of(content.as_buffer()):
                    fields, block = parsed(data)
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    http, _, body = block.partition(b"\r\n\r\n")
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    if response := fields["warc-type"] == "response":
                        if hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
                        size = len(body)
                    else:
                        size = int(http.split(b"Content-Length: ")[1])
                    page, refers = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
                    rows.append({"page_id": int(page) if page else None, "payload_bytes": size, "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": int(refers) if refers else None, "url": fields["warc-target-uri"], "payload": body.decode() if response and payloads else None})
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.string())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    out = files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string")
    return out if payloads else out.drop("payload")
