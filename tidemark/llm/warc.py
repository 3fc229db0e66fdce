"""WARC archives of pages, compressed with Zstandard: one frame per record, the dictionary in front.

``write_archives`` writes a response record per page, or a revisit record where an equal payload is already a
response. Each task writes archives of its own below one shared folder, and names them in a manifest that Spark
commits: files of attempts that failed are named nowhere. An archive begins with a skippable frame that holds
the dictionary its records are compressed with; an archive of few records has none.

``read_archives`` reads archives back, as streams, one record at a time. It checks version, required
fields, lengths and digests, and fails with the archive and the place of the first record that is not sound.

Of rows with equal payloads of at least ``least`` bytes the one with the smallest page id is the response, one
of them if that id is repeated; a null id comes last. Null html is an empty payload. Equal rows are records of
their own, an empty table gives no archive and no rows. Columns other than ``page_id``, ``url`` and ``html`` are not
looked at. A url is written with its control characters and outer spaces percent-encoded, a null url not at all.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import scratch_folder, stored

VERSION = b"WARC/1.1"
SKIPPABLE, DICTIONARY = 0x184D2A5D, b"\x37\xa4\x30\xec"
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive ends at so many compressed bytes; one task reads it.
ARCHIVE_BYTES = 64 << 20
#: A dictionary is made of the first records of its archive: at most so many records and bytes, at least so many records.
SAMPLE_RECORDS, SAMPLE_BYTES, LEAST_SAMPLE = 400, 4 << 20, 40
DICTIONARY_BYTES, LEVEL = 64 << 10, 3
#: Archives are read in as many tasks as there are archives, and no more than this; a task reads one after another.
MOST_TASKS = 100_000
#: Bytes read from an archive at a time.
PIECE = 16 << 10
DATE = "2000-01-01T00:00:00Z"
RECORD = (
    "archive string, offset long, record_id string, record_type string, record_date string, url string, page_id long, "
    "refers_to long, payload_bytes long, payload_digest string, payload binary"
)
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Schemes that Spark's file systems and pyarrow's know by different names.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


class BrokenArchive(ValueError):
    """An archive that does not hold what it says."""


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    scheme = urlsplit(path).scheme
    if scheme in SCHEMES:
        path = SCHEMES[scheme] + path[len(scheme):]
    return fs.FileSystem.from_uri(path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encoded_url(url: str) -> str:
    """The url as a header value: what would end or blur the line is percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]|^ +| +$", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url)


def _fields(pairs: Iterable[tuple[str, object]]) -> bytes:
    return b"".join(f"{name}: {value}\r\n".encode() for name, value in pairs if value is not None)


def record_id(row: int, space: str) -> str:
    """The id of the record of a row in one set of archives."""
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(space), str(row))}>"


def page_record(
    space: str, row: int, page_id: int | None, url: str | None, payload: bytes,
    first: tuple[int, int | None, str | None] | None = None, date: str = DATE,
) -> bytes:
    """The record of a page; with ``first`` (row, page id and url of the response) it is a revisit."""
    digest = digest_of(payload)
    answer = b"HTTP/1.1 200 OK\r\n" + _fields(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    ) + b"\r\n"
    block = answer if first else answer + payload
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", record_id(row, space)), ("WARC-Date", date),
        ("WARC-Target-URI", encoded_url(url) if url else None), ("Page-ID", page_id),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("Content-Length", len(block)),
    ]
    if first:
        fields += [
            ("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(first[0], space)),
            ("WARC-Refers-To-Target-URI", encoded_url(first[2]) if first[2] else None), ("Refers-To-Page-ID", first[1]),
        ]
    return VERSION + b"\r\n" + _fields(fields) + b"\r\n" + block + b"\r\n\r\n"


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of sample records; none where there are too few, or too little that repeats."""
    if len(samples) < LEAST_SAMPLE:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def leading_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    """The skippable frame that carries a dictionary, itself compressed."""
    content = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
    return struct.pack("<II", SKIPPABLE, len(content)) + content


def archive_parts(records: Iterable[bytes], sample: int = SAMPLE_RECORDS) -> Iterator[tuple[bytes, int]]:
    """The parts of an archive in order, with the number of records in each: dictionary first, then a frame a record."""
    records, samples, size = iter(records), [], 0
    for record in records:
        samples.append(record)
        size += len(record)
        if len(samples) >= sample or size >= SAMPLE_BYTES:
            break
    dictionary = trained(samples)
    if dictionary is not None:
        yield leading_frame(dictionary), 0
    frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    while samples:
        yield frames.compress(samples.pop(0)), 1
    for record in records:
        yield frames.compress(record), 1


def write_archive(
    path: str, records: Iterator[bytes], most: int = ARCHIVE_BYTES, sample: int = SAMPLE_RECORDS
) -> tuple[int, int]:
    """Write records until the archive is full, after its sample, or none is left; returns how many, and the bytes."""
    system, name = file_system(path)
    count = size = 0
    with system.open_output_stream(name, compression=None) as out:
        for part, held in archive_parts(_until(records, lambda: size >= most), sample):
            out.write(part)
            size += len(part)
            count += held
    return count, size


def _until(records: Iterator[bytes], full) -> Iterator[bytes]:
    """Records until ``full``; none is taken that is not passed on."""
    while not full():
        record = next(records, None)
        if record is None:
            return
        yield record


def _rows(batches: Iterator[pa.RecordBatch], space: str) -> Iterator[bytes]:
    names = ("_row", "page_id", "url", "payload", "_first_row", "_first_id", "_first_url")
    for batch in batches:
        for row, page_id, url, payload, *first in zip(*(batch.column(n) for n in names)):
            first = tuple(x.as_py() for x in first)
            yield page_record(
                space, row.as_py(), page_id.as_py(), url.as_py(), payload.as_py(), None if first[0] is None else first
            )


def identified(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages as (_row, page_id, url, payload), and for a revisit the row, page id and url of its response."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = stored(
        pages.select(
            F.monotonically_increasing_id().alias("_row"), F.col("page_id").cast("long").alias("page_id"), "url",
            payload.alias("payload"), F.sha2(payload, 256).alias("_same"),
        ), "payloads",
    )
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "_row", "url")
    first = rows.filter(F.length("payload") >= least).groupBy("_same").agg(F.count("*").alias("_n"), F.min(order).alias("_f"))
    # Few rows, one per repeated payload. As files their size is known, and a payload of many pages is split.
    repeated = stored(
        first.filter("_n > 1").select(
            F.col("_same").alias("_of"), F.col("_f._row").alias("_first_row"), F.col("_f.page_id").alias("_first_id"),
            F.col("_f.url").alias("_first_url"),
        ), "repeated-payloads",
    )
    both = rows.join(repeated, F.col("_same") == F.col("_of"), "left")
    again = F.col("_first_row") != F.col("_row")
    return both.select(
        "_row", "page_id", "url", "payload", *[F.when(again, F.col(c)).alias(c) for c in ("_first_row", "_first_id", "_first_url")]
    )


def write_archives(
    pages: DataFrame, folder: str | None = None, least: int = 0, most: int = ARCHIVE_BYTES, sample: int = SAMPLE_RECORDS
) -> DataFrame:
    """Write the pages as archives below ``folder`` and return the manifest: archive, records, bytes."""
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "archives")
    space = str(uuid.uuid4())

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, system = _rows(batches, space), file_system(folder)
        system[0].create_dir(system[1], recursive=True)
        for record in records:
            path = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst"
            count, size = write_archive(path, chain([record], records), most, sample)
            yield pa.RecordBatch.from_pydict({"archive": [path], "records": [count], "bytes": [size]})

    return stored(identified(pages, least).mapInArrow(made, "archive string, records long, bytes long"), "manifest")


def dictionary_of(stream) -> tuple[zstandard.ZstdCompressionDict | None, bytes, int]:
    """The dictionary of an archive's leading frame, bytes read beyond it, and where those begin."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
        return None, head, 0
    size = struct.unpack("<I", head[4:])[0]
    content = stream.read(size)
    if len(content) != size:
        raise BrokenArchive("the dictionary is cut off")
    if content[:4] == FRAME:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    if content[:4] != DICTIONARY:
        raise BrokenArchive("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT), b"", 8 + size


def frames(stream) -> Iterator[tuple[int, bytes]]:
    """Place and content of each frame of an archive."""
    dictionary, rest, at = dictionary_of(stream)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while piece := rest or stream.read(PIECE):
        frame, parts, taken = decoder.decompressobj(), [], 0
        while True:
            try:
                parts.append(frame.decompress(piece))
            except zstandard.ZstdError as error:
                raise BrokenArchive(f"frame at {at}: {error}") from error
            taken += len(piece)
            if frame.eof:
                break
            piece = stream.read(PIECE)
            if not piece:
                raise BrokenArchive(f"frame at {at}: cut off")
        rest = frame.unused_data
        yield at, b"".join(parts)
        at += taken - len(rest)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Fields, by lower-case name, and block of a record. Version, required fields and length are checked."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or lines[0] not in (b"WARC/1.0", VERSION):
        raise BrokenArchive("no WARC record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip() or name != name.strip():
            raise BrokenArchive(f"field {line[:40]!r}")
        fields[name.lower()] = value.strip(" \t")
    for name in REQUIRED:
        if not fields.get(name):
            raise BrokenArchive(f"no {name}")
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BrokenArchive(f"block of {len(rest) - 4} bytes, content-length {length}")
    return fields, rest[:-4]


def _checked(what: str, digest: str | None, content: bytes) -> None:
    if digest is not None and digest.startswith("sha1:") and digest[5:] != digest_of(content):
        raise BrokenArchive(f"{what} has another digest")


def page_of(record: bytes) -> dict[str, object]:
    """What a record says about its page; the payload of a response is checked against length and digest."""
    fields, block = parsed(record)
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest")
    _checked("block", fields.get("warc-block-digest"), block)
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, blank, payload = block.partition(b"\r\n\r\n")
        if not blank or not head.startswith(b"HTTP/"):
            raise BrokenArchive("no HTTP message")
        said = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head)
        size = int(said[1]) if said else len(payload)
        if kind != "revisit" and size != len(payload):
            raise BrokenArchive(f"payload of {len(payload)} bytes, content-length {size}")
    if kind == "revisit":
        if fields.get("warc-profile") != REVISIT or digest is None:
            raise BrokenArchive("a revisit of another kind")
        payload = None
    else:
        _checked("payload", digest, payload)
        digest = digest or f"sha1:{digest_of(payload)}"
    number = {n: int(fields[n]) if n in fields else None for n in ("page-id", "refers-to-page-id")}
    return {
        "record_id": fields["warc-record-id"], "record_type": kind, "record_date": fields["warc-date"],
        "url": fields.get("warc-target-uri"), "page_id": number["page-id"], "refers_to": number["refers-to-page-id"],
        "payload_bytes": size, "payload_digest": digest.removeprefix("sha1:"), "payload": payload,
    }


def archive_records(path: str) -> Iterator[dict[str, object]]:
    """All records of one archive, in order."""
    system, name = file_system(path)
    with system.open_input_stream(name, compression=None) as stream:
        at = 0
        try:
            for at, record in frames(stream):
                yield {"archive": path, "offset": at, **page_of(record)}
        except (BrokenArchive, UnicodeDecodeError) as error:
            raise BrokenArchive(f"{path} at {at}: {error}") from error


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The archives below a folder, for ``read_archives``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", True)
    return found.load(folder).select(F.col("path").alias("archive"), F.col("length").alias("bytes"))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives that a table (archive) names; without ``payloads`` these are null."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    named = (field.split(" ") for field in RECORD.split(", "))
    schema = pa.schema([(name, kinds[kind]) for name, kind in named])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                rows, size = [], 0
                for record in archive_records(path):
                    if not payloads:
                        record["payload"] = None
                    rows.append(record)
                    size += len(record["payload"] or b"") + 200
                    if size > PIECE * 256:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # A given number of tasks: the rows that name archives are small, and would be read as one partition.
    names = archives.select("archive")
    return names.repartition(max(1, min(names.count(), MOST_TASKS)), "archive").mapInArrow(made, RECORD)


def page_digests(records: DataFrame) -> DataFrame:
    """What the pages' records say, without their payloads."""
    kind: Column = F.col("record_type")
    return records.filter(kind.isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
