"""WARC archives: writing pages as records, and reading them back one after the other.

Every record is a gzip member of its own. Of pages with equal payloads of at least ``SAME_BYTES`` bytes the one
with the largest id is a ``response`` record, the others are ``revisit`` records that name it and hold no payload.
A task writes its rows to new files below the shared folder and lists them; the list is stored as a table, so the
files of a lost or repeated task are never read. The reader takes a file in blocks, decompresses member by
member in bounded pieces, frames records by Content-Length as they come and checks the block and payload digests,
written in hexadecimal or base32 digits. A digest that is absent or of an unknown algorithm is not checked.

Edge cases: null html is an empty payload; a null url gives a record without target; line breaks in a url are
percent-encoded; rows without a page id are left out; rows that repeat are records each. A damaged archive
raises; a record whose digest does not match is returned with ``intact`` false, and ``verified`` raises on it.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import keyed
from clickloom.session import materialise, scratch_path

SAME_BYTES = 1000
BLOCK = 1 << 18
HEAD = 1 << 20  # bytes of a record's header lines
END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
LISTED = "path string, records bigint, bytes bigint"
RECORDS = (
    "record_id string, record_type string, uri string, date string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to_id string, intact boolean"
)


def _sha1(data: bytes) -> str:
    return hashlib.sha1(data, usedforsecurity=False).hexdigest()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes = b""

    def pack(self, level: int) -> bytes:
        """The record as one gzip member."""
        headers = self.headers | {"WARC-Block-Digest": f"sha1:{_sha1(self.block)}", "Content-Length": str(len(self.block))}
        lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        return packer.compress(VERSION + b"\r\n" + lines.encode() + b"\r\n" + self.block + b"\r\n\r\n") + packer.flush()

    def digest_of(self, name: str) -> Digest | None:
        return Digest.read(self.headers[name]) if name in self.headers else None


@dataclass(frozen=True)
class Digest:
    algorithm: str
    hexadecimal: str

    @classmethod
    def read(cls, text: str) -> Digest | None:
        """A labelled digest; null if its algorithm is unknown."""
        algorithm, _, value = text.partition(":")
        algorithm = algorithm.strip().lower()
        if algorithm not in hashlib.algorithms_guaranteed or algorithm.startswith("shake"):
            return None
        value = value.strip()
        if len(value) != 2 * hashlib.new(algorithm, usedforsecurity=False).digest_size:
            try:
                value = base64.b32decode(value.rstrip("=") + "=" * (-len(value.rstrip("=")) % 8), casefold=True).hex()
            except binascii.Error:
                pass  # stays as it is and fits nothing
        return cls(algorithm, value.lower())

    def fits(self, data: bytes) -> bool:
        return hashlib.new(self.algorithm, data, usedforsecurity=False).hexdigest() == self.hexadecimal


@dataclass
class Frame:
    """One record from pieces of its member; it never holds more than Content-Length allows."""

    held: bytearray = field(default_factory=bytearray)
    headers: dict[str, str] | None = None
    start: int = 0
    size: int = 0

    def add(self, piece: bytes) -> None:
        seen = max(0, len(self.held) - len(END) + 1)
        self.held += piece
        if self.headers is None:
            end = self.held.find(END, seen)
            if end < 0:
                if len(self.held) > HEAD:
                    raise ValueError("a record's header lines do not end")
                return
            if not self.held.startswith(b"WARC/"):
                raise ValueError("a member does not begin with a record")
            lines = (line.partition(":") for line in self.held[:end].decode().split("\r\n")[1:])
            self.headers = {name.strip(): value.strip() for name, _, value in lines}
            self.start, self.size = end + len(END), int(self.headers["Content-Length"])
        if len(self.held) > self.start + self.size + len(END):
            raise ValueError("Content-Length does not match the record")

    def record(self) -> Record:
        if self.headers is None or self.held[self.start + self.size :] != END:
            raise ValueError("Content-Length does not match the record")
        return Record(self.headers, bytes(self.held[self.start : self.start + self.size]))


def page_record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, date: str) -> Record:
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": date, "WARC-Payload-Digest": f"sha1:{_sha1(payload)}", "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        headers["WARC-Target-URI"] = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
    if refers_to is not None:
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return Record(headers, http + payload if refers_to is None else http)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, refers_to): which page's payload a record repeats; null where it holds its own."""
    rows = keyed(pages, "page_id").select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= SAME_BYTES, F.sha1("payload")))
    # few payloads occur more than once; Spark broadcasts their list if it is small and splits hot digests if not
    same = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(same, "digest", "left")
    return joined.select("page_id", "url", "payload", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, date: str = "2020-01-01T00:00:00Z", level: int = 4, roll_bytes: int = 256 << 20) -> DataFrame:
    """Writes pages (page_id, url, html) below the shared folder; the table of archives (path, records, bytes)."""
    folder = scratch_path(pages.sparkSession, "warc")

    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        listed, out, path, written, count = [], None, "", 0, 0

        def close() -> None:
            out.close()
            listed.append((path, count, written))

        for batch in batches:
            for page_id, url, payload, refers_to in zip(batch["page_id"], batch["url"], batch["payload"], batch["refers_to"], strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, written, count = store.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "WARC-Filename": name}
                    written += out.write(Record(info).pack(level)) or 0
                record = page_record(page_id, url, payload, None if pd.isna(refers_to) else int(refers_to), date).pack(level)
                out.write(record)
                written, count = written + len(record), count + 1
                if written >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pd.DataFrame(listed, columns=["path", "records", "bytes"])

    return materialise(with_revisits(pages).mapInPandas(write, LISTED), "archives")


@dataclass
class SequentialReader:
    """Records of one archive, from blocks of its bytes."""

    blocks: Iterable[bytes]

    def __iter__(self) -> Iterator[Record]:
        member, frame, fresh = zlib.decompressobj(31), Frame(), True
        for block in self.blocks:
            more = bool(block)
            while more:
                piece = member.decompress(block, BLOCK)
                frame.add(piece)
                fresh = member.eof
                if member.eof:
                    yield frame.record()
                    block = member.unused_data
                    member, frame = zlib.decompressobj(31), Frame()
                    more = bool(block)
                else:
                    block = member.unconsumed_tail
                    more = bool(block) or len(piece) == BLOCK
        if not fresh:
            raise ValueError("the archive ends within a record")


def record_row(record: Record, with_payload: bool) -> tuple:
    headers, kind = record.headers, record.headers["WARC-Type"]
    http, _, payload = record.block.partition(END)
    whole, digest = record.digest_of("WARC-Block-Digest"), record.digest_of("WARC-Payload-Digest")
    size = re.search(rb"(?im)^Content-Length:[ \t]*(\d+)\r?$", http)
    size = int(size[1]) if size else None
    intact = whole is None or whole.fits(record.block)
    sha1 = digest.hexadecimal if digest and digest.algorithm == "sha1" else None
    if kind == "response":
        intact &= (digest is None or digest.fits(payload)) and size in (None, len(payload))
        sha1, size = _sha1(payload), len(payload)
    return (
        headers["WARC-Record-ID"], kind, headers.get("WARC-Target-URI"), headers.get("WARC-Date"),
        payload if with_payload and kind == "response" else None, size, sha1, headers.get("WARC-Refers-To"), intact,
    )


def read_archives(archives: DataFrame, with_payload: bool = True, batch_bytes: int = 32 << 20) -> DataFrame:
    """Records of all archives in the table ``archives`` (path), warcinfo records included."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def blocks(path: str) -> Iterator[bytes]:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_stream(place, compression=None) as stream:
            while block := stream.read(BLOCK):
                yield block

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows, size = [], 0
                for record in SequentialReader(blocks(path)):
                    rows.append(record_row(record, with_payload))
                    size += 500 + len(record.block) * with_payload
                    if size >= batch_bytes:
                        yield _frame(rows, names)
                        rows, size = [], 0
                yield _frame(rows, names)

    files = archives.select("path")
    return files.repartition(max(1, archives.count())).mapInPandas(read, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    return frame.astype({"payload_bytes": "Int64"})


def page_of(record_id: F.Column) -> F.Column:
    """The page id in a record id."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).cast("long")


def verified(records: DataFrame) -> DataFrame:
    """The same records; a record that is not intact ends the query with an error that names it."""
    broken = F.raise_error(F.concat(F.lit("a digest or length does not match in record "), F.col("record_id")))
    return records.where(F.when(F.col("intact"), F.lit(True)).otherwise(broken.cast("boolean")))
