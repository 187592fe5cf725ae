"""WARC archives with one Zstandard dictionary in front and each record compressed by itself."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import Columns, hashed_sample, map_batches, open_folder, read, scratch_path

# Fixed values of the format: the magic number of the skippable frame that holds the dictionary,
# the WARC version line, and the profile of a revisit of an identical payload.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

# Bounds of the dictionary: sampled payloads, bytes of each that are looked at, and its own size.
SAMPLE_PAGES = 400
SAMPLE_BYTES = 32_768
DICTIONARY_BYTES = 65_536
LEVEL = 6
MANIFEST = "page_id long, file string, at long, size int"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record: the HTTP head, and the payload unless the record is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    fields = [
        VERSION,
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        fields += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"WARC-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP head and payload of a record; checks lengths and the block digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    size = int(fields["Content-Length"])
    block = rest[:size]
    if version != VERSION or rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    if fields["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from SAMPLE_PAGES records, those with the smallest hash; empty without pages.

    Of a sampled payload its first SAMPLE_BYTES are looked at, as a dictionary is for the start of
    records. Too few or too uniform samples make a dictionary of their plain content.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    starts = pages.select("page_id", "url", F.substring(html, 1, SAMPLE_BYTES).alias("start"))
    rows = hashed_sample(starts, ["page_id", "url"], SAMPLE_PAGES)
    samples = [record(r["page_id"], r["url"], bytes(r["start"]), None, False) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def responses(pages: DataFrame, least: int = 0) -> DataFrame:
    """Each distinct payload of at least ``least`` bytes on several rows: digest and largest page_id."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    slim = pages.where(F.length(payload) >= least).select("page_id", F.sha1(payload).alias("digest"))
    return slim.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); returns the manifest.

    Of rows with one payload the largest page_id is the response; several rows with that page_id
    and payload are all responses. A null page_id counts as smallest, a null html as empty. An
    archive is one task's file; a repeated task writes under a new name, and the manifest names
    files of finished tasks only. Pages meet the answers by digest: only payloads on several
    rows are on the other side, and Spark splits frequent digests.
    """
    dictionary = train_dictionary(pages)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    marked = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    marked = marked.join(responses(pages, least), "digest", "left").drop("digest")

    def write(batches: Iterator[Columns]) -> Iterator[Columns]:
        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        stream, at = None, 0
        kind = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=kind).compress
        for batch in batches:
            if stream is None:
                files, path = open_folder(folder)
                files.create_dir(path, recursive=True)
                stream = files.open_output_stream(f"{path}/{name}", compression=None)
                frame = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
                info = f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                head = frame + compress(info.encode())
                stream.write(head)
                at = len(head)
            out: Columns = {"page_id": batch["page_id"], "file": [], "at": [], "size": []}
            for page_id, url, body, response_id in zip(*(batch[k] for k in ("page_id", "url", "payload", "response_id")), strict=True):
                is_revisit = response_id is not None and page_id != response_id
                raw = compress(record(page_id, url, body, response_id, is_revisit))
                stream.write(raw)
                out["file"].append(name)
                out["at"].append(at)
                out["size"].append(len(raw))
                at += len(raw)
            yield out
        if stream is not None:
            stream.close()

    return map_batches(marked, write, MANIFEST)


class Archive:
    """Random access to the records of an archive: dictionary first, then any record by place."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self._file = files.open_input_file(path)
        magic, size = struct.unpack("<II", self._file.read_at(8, 0))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} has no dictionary frame")
        kind = zstandard.ZstdCompressionDict(self._file.read_at(size, 8)) if size else None
        self._decompress = zstandard.ZstdDecompressor(dict_data=kind).decompress

    def record(self, at: int, size: int) -> tuple[dict[str, str], bytes, bytes]:
        return parse(self._decompress(self._file.read_at(size, at)))

    def close(self) -> None:
        self._file.close()


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """What the archives say of each manifest row (READ); the payload of a response is checked.

    The size of a revisit's payload is the Content-Length of its HTTP head.
    """

    def fetch(batches: Iterator[Columns]) -> Iterator[Columns]:
        files, path = open_folder(folder)
        archive, name = None, None
        for batch in batches:
            out: Columns = {k.split()[0]: [] for k in READ.split(", ")}
            out["page_id"] = batch["page_id"]
            for file, at, size in zip(batch["file"], batch["at"], batch["size"], strict=True):
                if file != name:
                    if archive is not None:
                        archive.close()
                    archive, name = Archive(files, f"{path}/{file}"), file
                fields, http, payload = archive.record(at, size)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and payload_digest(payload) != digest:
                    raise ValueError("payload digest differs")
                lines = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
                out["payload_bytes"].append(int(lines["Content-Length"]))
                out["payload_digest"].append(digest)
                out["record_type"].append(fields["WARC-Type"])
                target = fields.get("WARC-Refers-To-Page")
                out["refers_to"].append(None if target is None else int(target))
            yield out

    # As many tasks as archives: rows of the manifest are too small for Spark to tell.
    n_files = manifest.agg(F.count_distinct("file")).first()[0]
    by_file = manifest.repartitionByRange(max(1, n_files), "file", "at").sortWithinPartitions("file", "at")
    return map_batches(by_file, fetch, READ)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    write_archives(pages, f"{folder}/archives").write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return read_archives(manifest, f"{folder}/archives")


# Base 32 of a digest: five hexadecimal digits are four characters.
OP7_SQL = """
with payloads as (
    select page_id, coalesce(html, '') as payload from pages
), digests as (
    select page_id, cast(strlen(payload) as bigint) as payload_bytes, sha1(payload) as hex,
        max(page_id) over (partition by payload) as kept
    from payloads
), parts as (
    select *, [cast('0x' || substr(hex, 5 * k + 1, 5) as bigint) for k in range(8)] as fives from digests
)
select page_id, payload_bytes,
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((v >> 15) & 31) + 1 as int), 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((v >> 10) & 31) + 1 as int), 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((v >> 5) & 31) + 1 as int), 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v & 31) + 1 as int), 1)
        for v in fives
    ], '') as payload_digest,
    case when page_id = kept then 'response' else 'revisit' end as record_type,
    case when page_id <> kept then kept end as refers_to
from parts
"""
