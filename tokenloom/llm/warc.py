"""WARC archives whose records are compressed one by one with a dictionary.

An archive begins with a skippable Zstandard frame that holds a dictionary built from its own
records; each record follows as a frame of its own.  Archives are bounded, so a task holds one
archive's records at a time.  They are written by name of partition and number, first under a
name of the attempt and then moved, so a task that runs again puts the same file in place.

Paths are opened with Arrow's file systems, on executors: the folder must be one that they share.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.storage import staged

# Fixed values of the WARC and Zstandard formats.
DICTIONARY_FRAME = 0x184D2A5D
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
DATE = "1970-01-01T00:00:00Z"
SALTS = 16
RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record around an HTTP response; a revisit keeps the HTTP head and drops the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return WARC_VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records spread over the archive; where they are too few or small, their raw content."""
    share = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    samples = [r[: 128 << 10] for r in records[::share]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw.rjust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def encode_archive(records: list[bytes]) -> Iterator[bytes]:
    """The leading dictionary frame, then one frame for each record."""
    dictionary = build_dictionary(records)
    raw = dictionary.as_bytes()
    yield struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw
    compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary)
    for record in records:
        yield compressor.compress(record)


def decode_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an open archive, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no leading dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(stream.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(stream, read_across_frames=True)
    held = b""

    def until(mark: bytes) -> bytes | None:
        nonlocal held
        while mark not in held:
            more = reader.read(1 << 16)
            if not more:
                return None
            held += more
        found, _, held = held.partition(mark)
        return found

    def take(n: int) -> bytes:
        nonlocal held
        parts, have = [held], len(held)
        while have < n:
            more = reader.read(max(1 << 16, n - have))
            if not more:
                raise ValueError("the archive ends inside a record")
            parts.append(more)
            have += len(more)
        whole = b"".join(parts)
        held = whole[n:]
        return whole[:n]

    while (head := until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = take(int(fields["Content-Length"]))
        take(4)
        yield fields, block


def decode_record(fields: dict[str, str], block: bytes) -> dict:
    """A row of a record; the digest of a response is that of the payload read, and must be the one named."""
    head, _, payload = block.partition(b"\r\n\r\n")
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    length = int(head.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    if not revisit and (base32_sha1(payload) != named or len(payload) != length):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload it names")
    uri = fields.get("WARC-Target-URI")

    def page(field: str) -> int | None:
        text = fields[field][len("<urn:x-page:") : -1]
        return None if text == "null" else int(text)

    return {
        "page_id": page("WARC-Record-ID"),
        "url": None if uri is None else urllib.parse.unquote(uri),
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To") if revisit else None,
        "payload_bytes": length,
        "payload_digest": named,
        "payload": None if revisit else payload,
    }


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to, revisit``: which rows repeat the payload of a smaller page.

    The smallest id of each payload comes from a partially aggregated count; it meets the rows
    salted, so a payload that many pages share is spread over ``SALTS`` tasks or more.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    firsts = rows.filter(F.length("payload") >= min_bytes).groupBy("digest")
    firsts = firsts.agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select("digest", "refers_to", F.explode(F.array(*[F.lit(s).cast("bigint") for s in range(SALTS)])).alias("salt"))
    both = rows.join(firsts, ["digest", "salt"], "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return both.select("page_id", "url", "payload", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) to ``folder``; returns ``archive, records, raw_bytes`` per file.

    Null html is an empty payload; a null url is left out.  Rows that repeat the smallest id of a
    payload are each a response; a null id revisits that smallest id, or is a response where no row
    of the payload has an id.  No rows write no archive.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt, count = context.partitionId(), context.taskAttemptId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, count
            name = f"{root}/part-{part:06d}-{count:04d}.warc.zst"
            with store.open_output_stream(f"{name}.{attempt}.tmp", compression=None) as out:
                for frame in encode_archive(held):
                    out.write(frame)
            store.move(f"{name}.{attempt}.tmp", name)
            row = [[name], [len(held)], [size]]
            held, size, count = [], 0, count + 1
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["archive", "records", "raw_bytes"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")]
            for i in range(len(batch)):
                record = encode_record(*[c[i].as_py() for c in columns])
                held.append(record)
                size += len(record)
                if size >= archive_bytes:
                    yield flush()
        if held:
            yield flush()

    marked = mark_revisits(pages, min_bytes).sortWithinPartitions("page_id", F.xxhash64("payload"))
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    return staged(marked.mapInArrow(work, "archive string, records bigint, raw_bytes bigint"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives named in ``manifest``; ``payload`` is null for revisits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows: list[dict] = []
                size = 0
                with store.open_input_stream(name, compression=None) as stream:
                    for fields, block in decode_archive(stream):
                        row = decode_record(fields, block)
                        row["payload"] = row["payload"] if with_payload else None
                        rows.append(row)
                        size += len(block)
                        if size >= 1 << 20 or len(rows) >= 1024:
                            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("archive").repartition(parts, "archive").mapInArrow(work, f"{RECORDS}, payload binary")
