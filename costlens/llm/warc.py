"""WARC archives compressed record by record with a dictionary of their own.

Every archive starts with a skippable Zstandard frame (magic 0x184D2A5D)
that holds a dictionary built from the archive's first records; each record
then is a frame of its own, so a reader can start at any frame once it has
the dictionary. Of records with equal payloads of at least ``MIN_REVISIT``
bytes the one with the largest page id is kept as a response, the others
become revisit records that refer to it.

Archives are written by the tasks into a shared folder through
``pyarrow.fs`` (file, HDFS, S3 and so on). File names carry the task attempt,
and only the files of attempts that ended well are in the manifest, so a
task that is run again leaves no double records.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import broadcast_small, shared_path, stash

MIN_REVISIT = 1000
DICT_MAGIC = 0x184D2A5D
# Bytes of records that a dictionary is built from, and the dictionary's size.
SAMPLE_BYTES = 4 << 20
DICT_BYTES = 64 << 10
# An archive is closed after so many compressed bytes and the next begins.
ROLL_BYTES = 256 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long")


def with_roles(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload, record_type, refers_to) of pages (page_id, url, html).

    Null html is an empty payload. Payloads are equal when their SHA-1 and
    length are. A row with a null page id is never what others refer to;
    repeated rows of the largest page id are all responses.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    ids = rows.where(F.length("payload") >= MIN_REVISIT).select(
        "page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("n"))
    keep = ids.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
    keep = keep.where("copies > 1 and refers_to is not null").drop("copies")
    # Only ids and digests meet here; a payload that a third of all pages share is a skewed join that AQE splits.
    again = ids.join(keep, ["digest", "n"]).where("page_id is null or page_id < refers_to")
    again = broadcast_small(stash(again.select("page_id", "refers_to", "digest").distinct(), "revisits"))
    # By page id and digest, as rows of one page id can have different payloads.
    long = F.length("payload") >= MIN_REVISIT
    out = rows.withColumn("digest", F.when(long, F.sha1("payload"))).alias("a").join(
        again.alias("b"), F.expr("a.page_id <=> b.page_id and a.digest = b.digest"), "left")
    return out.select("a.page_id", "a.url", "a.payload", "b.refers_to",
                      F.when(F.col("b.refers_to").isNull(), "response").otherwise("revisit").alias("record_type"))


def _record_id(page_id: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; line breaks and other controls in a URL are percent-encoded."""
    digest = hashlib.sha1(payload).digest()
    name = None if pd.isna(page_id) else int(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = not pd.isna(refers_to)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(name, digest.hex())}", f"WARC-Date: {date}"]
    if name is not None:
        head.append(f"X-Page-Id: {name}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: urllib.parse.quote(m[0]), url))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(int(refers_to), digest.hex())}",
                 f"X-Refers-To-Page: {int(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary of the samples; of too few to train on, their raw bytes."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def filesystem(folder: str):
    """File system and path of a folder URI."""
    from pyarrow import fs

    if re.match("file:/+", folder):
        folder = "/" + re.sub("^file:/+", "", folder)
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


class _Archive:
    """An open archive; the first SAMPLE_BYTES of records wait for the dictionary."""

    def __init__(self, system, path):
        self.path, self.out = path, system.open_output_stream(path)
        self.waiting, self.held, self.packer, self.records, self.bytes = [], 0, None, 0, 0

    def _write(self, data: bytes):
        self.out.write(data)
        self.bytes += len(data)

    def add(self, data: bytes):
        self.records += 1
        if self.packer:
            self._write(self.packer.compress(data))
            return
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES:
            self._start()

    def _start(self):
        data = build_dictionary(self.waiting)
        self._write(struct.pack("<II", DICT_MAGIC, len(data)) + data)
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(data))
        for x in self.waiting:
            self._write(self.packer.compress(x))
        self.waiting = []

    def close(self) -> dict:
        if not self.packer:
            self._start()
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.bytes}


def write_warc(rows: DataFrame, folder: str | None = None, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write rows (page_id, url, payload, refers_to) as archives; returns the manifest (path, records, bytes).

    ``folder`` must be one that all tasks reach; unset, it is a new folder
    under the shared checkpoint folder. An empty table gives no archive.
    """
    folder = folder or shared_path(rows.sparkSession, "warc")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = filesystem(folder)
        task, done, archive = TaskContext.get(), [], None
        for f in frames:
            for r in zip(f["page_id"], f["url"], f["payload"], f["refers_to"]):
                if archive is None:
                    system.create_dir(base, recursive=True)
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(done)}.warc.zst"
                    archive = _Archive(system, f"{base}/{name}")
                archive.add(record(r[0], None if pd.isna(r[1]) else r[1], bytes(r[2]), r[3], date))
                if archive.bytes >= ROLL_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pd.DataFrame(done).assign(folder=folder)

    cols = rows.select("page_id", "url", "payload", "refers_to")
    return stash(cols.mapInPandas(write, "path string, records long, bytes long, folder string"), "manifest")


def read_frames(stream) -> Iterator[bytes]:
    """Records of an archive: the dictionary of the leading skippable frame, then one frame after another."""
    head = stream.read(8)
    if len(head) < 8:
        return
    magic, n = struct.unpack("<II", head)
    if magic == DICT_MAGIC:
        unpack, data = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(n))), b""
    else:
        unpack, data = zstandard.ZstdDecompressor(), head
    while True:
        one, parts = unpack.decompressobj(), []
        while not one.eof:
            if not data and not (data := stream.read(1 << 15)):
                if parts:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(one.decompress(data))
            data = b""
        data = one.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """The fields of one record; digest and length of a response are taken from its payload."""
    head, _, block = data.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if h["WARC-Type"] == "revisit":
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        payload = None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if digest != said:
            raise ValueError(f"the payload of {h['WARC-Record-ID']} does not match its digest")
    url = h.get("WARC-Target-URI")
    number = lambda k: int(h[k]) if k in h else None
    return {"page_id": number("X-Page-Id"), "url": None if url is None else urllib.parse.unquote(url),
            "payload": payload, "payload_bytes": size, "payload_digest": said, "record_type": h["WARC-Type"],
            "refers_to": number("X-Refers-To-Page")}


def read_warc(manifest: DataFrame) -> DataFrame:
    """All records of the archives that a manifest (path, folder) lists, archive by archive in the tasks."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, folder in zip(f["path"], f["folder"]):
                system, _ = filesystem(folder)
                with io.BufferedReader(system.open_input_stream(path)) as stream:
                    held, size = [], 0
                    for data in read_frames(stream):
                        held.append(parse_record(data))
                        size += len(data)
                        if size > 8 << 20:
                            yield _frame(held)
                            held, size = [], 0
                    if held:
                        yield _frame(held)

    files = manifest.select("path", "folder")
    # A fixed number of partitions, as adaptive execution would put these few small rows into one task.
    return files.repartitionByRange(max(1, files.count()), "path").mapInPandas(read, RECORDS)


def _frame(held: list[dict]) -> pd.DataFrame:
    f = pd.DataFrame(held)
    return f.astype({"page_id": "Int64", "refers_to": "Int64"})
