"""WARC records in seekable Zstandard bundles.

Records are gathered into frames of about 64 KB that can be decompressed alone, and frames into bundles of about
2 MB, so that a bundle is one binary value of a table that any store can hold. A bundle ends with a seek table
(a skippable frame with the compressed and plain size of each frame, as in the public seekable format); an index
beside it maps each record to its frame and to its place within the frame.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm._shared import table
from graphloom.session import ship

FRAME_BYTES, BUNDLE_BYTES = 64 << 10, 2 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
"""Fixed values of the seekable format: magic numbers of its last frame and of its footer."""
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
INDEX = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())]))
BUNDLES = "bundle_id string, archive binary, index array<struct<record_id:string,frame:int,offset:int,length:int>>"
RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def record(record_id: str, uri: str | None, payload: bytes, digest_hex: str, refers_to: str | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, whose Content-Length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri:
        head.append("WARC-Target-URI: " + " ".join(uri.split()))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode())
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at a place, as a row of RECORDS, and where the next one starts."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no record starts here")
    head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    start = end + 4
    stop = start + int(head["content-length"])
    block = data[start:stop]
    cut = block.index(b"\r\n\r\n") + 4
    http = {k.lower(): v for k, v in (x.split(": ", 1) for x in block[: cut - 4].decode().split("\r\n")[1:])}
    row = {
        "record_id": head["warc-record-id"][1:-1], "record_type": head["warc-type"], "target_uri": head.get("warc-target-uri"),
        "refers_to": head["warc-refers-to"][1:-1] if "warc-refers-to" in head else None,
        "payload_digest": base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "payload_bytes": int(http["content-length"]), "payload": block[cut:] if head["warc-type"] == "response" else None,
    }
    return row, stop + 4


class Bundle:
    """Writes frames, the seek table and the index of one bundle."""

    def __init__(self, level: int = 3):
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.sizes, self.index, self.plain, self.done = [], [], [], [], 0

    def add(self, record_id: str, data: bytes) -> None:
        offset = sum(map(len, self.plain))
        if offset and offset + len(data) > FRAME_BYTES:
            self.end_frame()
            offset = 0
        self.index.append({"record_id": record_id, "frame": len(self.frames), "offset": offset, "length": len(data)})
        self.plain.append(data)

    def end_frame(self) -> None:
        if self.plain:
            data = b"".join(self.plain)
            frame = self.compressor.compress(data)
            self.frames.append(frame), self.sizes.append((len(frame), len(data)))
            self.done += len(frame)
            self.plain = []

    def archive(self) -> bytes:
        self.end_frame()
        table_ = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table_)) + table_


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, read from the end of the archive."""
    n, _, magic = struct.unpack("<IBI", archive[-9:])
    if magic != SEEKABLE:
        raise ValueError("the archive has no seek table")
    sizes = list(struct.iter_unpack("<II", archive[-9 - 8 * n : -9]))
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def frame(archive: bytes, spot: tuple[int, int, int]) -> bytes:
    at, packed, plain = spot
    return zstandard.ZstdDecompressor().decompress(archive[at : at + packed], max_output_size=plain)


def read_record(archive: bytes, number: int, offset: int) -> dict:
    """One record by its index entry: only its frame is decompressed."""
    return parsed(frame(archive, seek_table(archive)[number]), offset)[0]


def write_bundles(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 1000) -> DataFrame:
    """The bundles of pages as a written table: bundle_id, archive, index.

    Of rows with equal payloads (the html in UTF-8; null: empty) of at least `least` bytes, that with the largest
    key is a response and the others are revisits that refer to it; all else are responses. Equal: the same SHA-1
    and length. Null keys are never the one that others refer to. Rows with one key make records of one id.
    Digests of large payloads are counted first, without the payloads. The digests that occur twice are a written table:
    while that is small, Spark broadcasts it and no payload is moved; beyond that each payload moves once, to
    one of SALTS tasks of its digest. Empty tables give no bundle; urls may be null, payloads of any size; other columns are not read.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(key).cast("string").alias("id"), F.col(key).alias("__key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= least)
    heads = table(large.groupBy("digest").agg(F.max("__key").cast("string").alias("head"), F.count("*").alias("n")).where("n > 1").select("digest", "head"))
    kept = F.when((F.length("payload") >= least) & ~F.col("head").eqNullSafe(F.col("id")), F.col("head"))
    salted = heads.select("digest", "head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left").withColumn("refers_to", kept).select("id", "url", "payload", "digest", "refers_to")

    def name(v: str | None) -> str | None:
        return None if v is None else f"urn:page:{v}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, bundle = TaskContext.get().partitionId(), 0, Bundle()

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{task:08d}-{made:08d}"]), pa.array([bundle.archive()], pa.binary()), pa.array([bundle.index], INDEX)], names=["bundle_id", "archive", "index"])

        for batch in batches:
            for id_, uri, payload, digest, refers in zip(*[batch[c] for c in ("id", "url", "payload", "digest", "refers_to")], strict=True):
                record_id = name(id_.as_py()) or "urn:page"
                bundle.add(record_id, record(record_id, uri.as_py(), payload.as_py(), digest.as_py(), name(refers.as_py())))
                if bundle.done >= BUNDLE_BYTES:
                    yield ended()
                    made, bundle = made + 1, Bundle()
        if bundle.index:
            yield ended()

    return table(rows.mapInArrow(run, BUNDLES))


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, frame by frame: RECORDS with bundle_id, frame and offset. payload is null for revisits."""
    ship(bundles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
        for batch in batches:
            for bundle_id, archive in zip(batch["bundle_id"], batch["archive"], strict=True):
                archive = archive.as_py()
                for number, spot in enumerate(seek_table(archive)):
                    data, at, rows, places = frame(archive, spot), 0, [], []
                    while at < len(data):
                        places.append(at)
                        row, at = parsed(data, at)
                        rows.append(row)
                    columns = [pa.array([r[n] for r in rows], k) for n, k in kinds]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([bundle_id.as_py()] * len(rows)), pa.array([number] * len(rows), pa.int32()), pa.array(places, pa.int32())], names=[n for n, _ in kinds] + ["bundle_id", "frame", "offset"])

    return bundles.select("bundle_id", "archive").mapInArrow(run, f"{RECORDS}, bundle_id string, frame int, offset int")
