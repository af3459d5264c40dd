r"""WARC archives with a Zstandard dictionary of their own.

A writer task collects records until their payloads reach ``archive_bytes``, builds a
dictionary from samples of these records, and writes one archive: a skippable frame that
holds the dictionary, then one frame per record. Each record can be read alone, given the
archive's first frame. A record larger than that is an archive with few neighbours; memory
holds one archive at a time.

Of records with equal payloads of at least ``min_payload`` bytes the one of the largest
page_id is a response, the others are revisits that refer to it and carry HTTP headers
only. Copies are found by SHA-1 and length of the payload; the page that stands for a
digest is found by an aggregate that combines within tasks, and joined back as a plain
join, which Spark can split where a digest is hot.

Files go to a folder that all executors reach, under a name made of the task's partition, its
attempt and a number; readers take only the names that finished tasks report, so a task that
ran twice leaves no second copy in the result.

Null html is an empty payload; null urls are empty. Two rows of equal page_id are two
records; of the rows with the digest's largest page_id all are responses. An empty table
gives no archives. Rows with a null page_id refer to their largest equal with an id and are
themselves responses if there is none.
"""

from __future__ import annotations

import hashlib
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.staging import staged
from tidewater.session import fresh_path

MIN_PAYLOAD = 1000
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # bytes of an archive's records that its dictionary is built from, at most
SAMPLE_OF_RECORD = 16 << 10
LEVEL = 6

SKIPPABLE = 0x184D2A5D  # magic number of the frame that holds an archive's dictionary
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, n_records long, payload_bytes long, archive_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def marked(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Rows of (page_id, url, payload, refers_to): refers_to is null for responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    copies = (
        rows.where(F.col("size") >= min_payload)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("stands"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("stands").isNotNull())
        .select(F.col("digest").alias("copy_digest"), F.col("size").alias("copy_size"), "stands")
    )
    copies = staged(copies, "warc-copies")  # a table of known size, so that Spark picks and splits the join by it
    same = (F.col("digest") == F.col("copy_digest")) & (F.col("size") == F.col("copy_size"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("stands")), F.col("stands"))
    return rows.join(copies, same, "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record. A revisit's block is the HTTP head alone, with the payload's length in it."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Target-URI": urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{hashlib.sha1(payload).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is None:
        block += payload
    else:
        head |= {"WARC-Profile": REVISIT, "WARC-Refers-To": _record_id(refers_to)}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in data.decode().split("\r\n")[1:] if ": " in line)


def parse(data: bytes) -> dict:
    """A record's fields and payload (None for a revisit).

    Length and digest of a response are those of the payload as read; a record whose headers
    say otherwise is refused. A revisit has them in its headers only.
    """
    head_end = data.index(b"\r\n\r\n") + 4
    head = _headers(data[:head_end])
    block = data[head_end : head_end + int(head["Content-Length"])]
    http_end = block.index(b"\r\n\r\n") + 4
    number = lambda urn: int(urn[len("<urn:page:") : -1] or -1) if urn and urn != _record_id(None) else None
    revisit = head["WARC-Type"] == "revisit"
    payload = None if revisit else block[http_end:]
    size, digest = int(_headers(block[:http_end])["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None:
        said, size, digest = (size, digest), len(payload), hashlib.sha1(payload).hexdigest()
        if said != (size, digest):
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is not the one its headers name")
    return {
        "page_id": number(head["WARC-Record-ID"]),
        "url": urllib.parse.unquote(head["WARC-Target-URI"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": number(head.get("WARC-Refers-To")),
        "payload": payload,
    }


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary built from evenly spread records; None where they are too few to build one."""
    step = max(1, sum(min(len(r), SAMPLE_OF_RECORD) for r in records) // SAMPLE_BYTES)
    samples = [r[:SAMPLE_OF_RECORD] for r in records[::step]]
    total = sum(map(len, samples))
    if len(samples) < 8 or total < 8 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(size, total // 8), samples, level=LEVEL)
    except zstandard.ZstdError:  # samples without anything in common
        return None


def archive(records: list[bytes]) -> bytes:
    """The dictionary in a skippable frame (empty where there is none), then a frame per record."""
    built = dictionary(records)
    data = built.as_bytes() if built else b""
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=built, write_content_size=True)
    return struct.pack("<II", SKIPPABLE, len(data)) + data + b"".join(map(compressor.compress, records))


def read_archive(stream) -> Iterator[bytes]:
    """Records of an archive, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the start of the archive")
    data = stream.read(size)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
    rest = b""
    while True:
        if not rest:
            rest = stream.read(1 << 20)
            if not rest:
                return
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            out.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else stream.read(1 << 20)
            if not frame.eof and not rest:
                raise ValueError("the archive ends within a record")
        yield b"".join(out)


def write(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of ``marked`` as archives below a folder; a row per archive (path and counts)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        label = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        files, base = fs.FileSystem.from_uri(folder)
        held, size, number = [], 0, 0

        def flush() -> pa.RecordBatch:
            data = archive(held)
            name = f"{label}-{number:05d}.warc.zst"
            with files.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(data)
            row = [[f"{folder}/{name}"], [len(held)], [size], [len(data)]]
            return pa.RecordBatch.from_arrays(list(map(pa.array, row)), [x.split()[0] for x in MANIFEST.split(", ")])

        for batch in batches:
            for r in batch.to_pylist():
                held.append(record(**r))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    _make_folder(rows.sparkSession, folder)
    return rows.select("page_id", "url", "payload", "refers_to").mapInArrow(task, MANIFEST)


def read(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the archives named in column ``path``, in columns RECORDS."""
    fields = [x.split() for x in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in fields if payload or n != "payload"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = fs.FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for data in read_archive(stream):
                        rows.append(parse(data))
                        size += len(data)
                        if size > 8 << 20 or len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    columns = RECORDS if payload else RECORDS.removesuffix(", payload binary")
    return archives.select("path").mapInArrow(task, columns)


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def archived(pages: DataFrame, min_payload: int = MIN_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as archives in the shared folder; the list of archives."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return staged(write(marked(pages, min_payload), folder, archive_bytes), "warc-manifest")
