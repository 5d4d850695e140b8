"""WARC archives as .warc.zst: a dictionary in a leading skippable frame, a frame per record.

A Zstandard dictionary is built from a bounded sample of the archived records. Every
file starts with a skippable frame that holds it, and each record is a frame of its own,
compressed with it, so that a reader needs nothing but the file and can start at any record.

Of records with equal payloads the one with the smallest key is a response, the others
revisit it. Tasks write their file under a name of their own attempt in the shared folder; a manifest,
written as a table, names the files that count, so that a repeated task leaves no double.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.llm.common import hash_sample, written
from clicklake.session import shared_folder

#: The dictionary is built from at most so many records, and of each at most so many bytes.
SAMPLE_RECORDS, SAMPLE_BYTES = 400, 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3
ROWS_PER_FILE = 20_000
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{page_id}:{digest}')}>"


def _header_text(value: str) -> str:
    """A header's value on one line: control characters and white space at the ends as %XX."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value.strip())


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit record without the payload if it refers to another."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header_text(url) if url else None),
        ("WARC-Page-ID", None if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", None if refers_to is None else REVISIT_PROFILE),
        ("WARC-Refers-To", None if refers_to is None else record_id(refers_to, digest)),
        ("WARC-Refers-To-Page-ID", None if refers_to is None else str(refers_to)),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of too few samples to train on, their own bytes; of none, nothing."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame that begins at `at` ends: its header, blocks and checksum."""
    end = at + zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)  # a block of one repeated byte holds it once
    return end + 4 * (data[at + 4] >> 2 & 1)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers (names in lower case) and block of each record of a .warc.zst file."""
    at, dictionary = 0, b""
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE_MAGIC:
        length = struct.unpack_from("<I", data, 4)[0]
        dictionary, at = data[8 : 8 + length], 8 + length
    context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        end = _frame_end(data, at)
        record, at = context.decompress(data[at:end]), end
        head, _, rest = record.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
        yield headers, rest[: int(headers["content-length"])]


def _decided(pages: DataFrame) -> DataFrame:
    """page_id, payload (bytes), url and refers_to of every page, in about equal parts."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    digests = written(rows.select("page_id", F.sha1("payload").alias("digest")))
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1")
    revisits = digests.join(firsts.select("digest", "first"), "digest").where("page_id > first").select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("of"), "first")
    same = (F.col("page_id") == F.col("revisit_id")) & (F.sha1("payload") == F.col("of"))
    return rows.join(revisits.distinct(), same, "left").select("page_id", "url", "payload", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, rows_per_file: int = ROWS_PER_FILE, date: str = DATE) -> DataFrame:
    """Archives of all pages in `folder`; the manifest: file, records, bytes.

    Pages are rows of page_id, url and html; a null html is an empty payload. A
    null page_id never revisits and is never revisited. Rows that repeat a page_id with the same
    html are records of the same kind each. The folder must be reachable from all executors.
    """
    sample = hash_sample(pages, "page_id", SAMPLE_RECORDS)
    start = F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_BYTES).alias("part")
    texts = sample.select("page_id", "url", start).limit(SAMPLE_RECORDS).collect()
    examples = []
    for page_id, url, part in texts:
        body = part.encode("utf-8", "surrogatepass")
        examples.append(_record(page_id, url, body, payload_digest(body), None, date))
    dictionary = build_dictionary(examples)
    head = struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary if dictionary else b""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        out = None
        for batch in batches:
            for page_id, url, payload, refers_to in batch.itertuples(index=False):
                if out is None or records >= rows_per_file:
                    if out is not None:
                        out.close()
                        yield pd.DataFrame([(name, records, size)], columns=["file", "records", "bytes"])
                    name, records, size = f"part-{uuid.uuid4().hex}.warc.zst", 0, len(head)
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(head)
                page_id = int(page_id) if page_id is not None else None
                refers_to = int(refers_to) if refers_to is not None else None
                payload = bytes(payload)
                frame = compressor.compress(_record(page_id, url, payload, payload_digest(payload), refers_to, date))
                out.write(frame)
                records, size = records + 1, size + len(frame)
        if out is not None:
            out.close()
            yield pd.DataFrame([(name, records, size)], columns=["file", "records", "bytes"])

    rows = _decided(pages).select(F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    return written(rows.mapInPandas(run, "file string, records long, bytes long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the manifest's files: page_id, url, record_type, payload_digest, payload, refers_to.

    The payload of a revisit is null. Checksums of frames and digests of blocks and payloads are verified.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        columns = ["page_id", "url", "record_type", "payload_digest", "payload", "refers_to"]
        for batch in batches:
            for name in batch["file"]:
                rows = []
                with system.open_input_file(f"{base}/{name}") as file:
                    data = file.read()
                for headers, block in parse_records(data):
                    if f"sha1:{payload_digest(block)}" != headers["warc-block-digest"]:
                        raise ValueError(f"a record of {name} is damaged")
                    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    if payload is not None and payload_digest(payload) != digest:
                        raise ValueError(f"a payload of {name} is damaged")
                    rows.append((headers.get("warc-page-id"), headers.get("warc-target-uri"), kind, digest, payload, headers.get("warc-refers-to-page-id")))
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                yield pd.DataFrame(rows, columns=columns)

    spread = manifest.select("file").repartition(max(1, manifest.count()), "file")
    read = spread.mapInPandas(run, "page_id string, url string, record_type string, payload_digest string, payload binary, refers_to string")
    return read.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def archived(pages: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to: pages written to archives and read back.

    The size of a revisit's payload is that of the response it refers to, looked up by digest.
    """
    spark: SparkSession = pages.sparkSession
    folder = shared_folder(spark)
    manifest = write_archives(pages, folder)
    sized = F.octet_length("payload").cast("long").alias("payload_bytes")
    read = written(read_archives(manifest, folder).select("page_id", "url", "record_type", "payload_digest", "refers_to", sized))
    whole = read.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("whole_bytes"))
    revisits = read.where("record_type = 'revisit'").drop("payload_bytes").join(whole.withColumnRenamed("whole_bytes", "payload_bytes"), "payload_digest")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.where("record_type = 'response'").select(*columns).union(revisits.select(*columns))
