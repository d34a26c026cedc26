"""How often does each item of a document occur in the whole corpus? Asked and answered in bulk.

Documents are dealt to chunks of about 4 MB of text. A chunk asks for the 64-bit hashes of its items,
each hash once, sorted, and cut by hash range into one packed row a bucket. A bucket adds up what all
chunks ask and answers each row in its own order, so that an answer needs neither hashes nor document ids.
The chunk then works out its items again and reads the answers off by position.

A hash reaches a bucket once per chunk at most, however many documents of the chunk hold it: hot lines,
passages and groups of copies are summed before the shuffle. Chunks and buckets grow in number with the
text, so a task holds about 8 MB of text or the hashes of as much; beyond MOST_TASKS tasks (some 400 GB of text) both grow in
size instead, chunks up to 64 MB, so that the packed rows (chunks times buckets) stay long: at 100 TB about a thousand bytes each.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.session import ship

CHUNK_BYTES = 4 << 20
TASK_BYTES = 8 << 20
MOST_CHUNK_BYTES, MOST_TASKS = 64 << 20, 50_000
ASK = "__bucket int, __chunk long, __n int, __asked binary"
ANSWER = "__chunk long, __bucket int, __answer binary"


class Chunked:
    """docs with a column __chunk, dealt by it. Rows that are alike in key and text share a chunk."""

    def __init__(self, docs: DataFrame, key: str, text: str):
        spark = docs.sparkSession
        ship(spark)
        size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tasks = min(max(-(-size // TASK_BYTES), min(most, -(-size // (1 << 20))), 1), MOST_TASKS)
        chunk = max(CHUNK_BYTES, min(MOST_CHUNK_BYTES, CHUNK_BYTES * size // (MOST_TASKS * TASK_BYTES)))
        self.chunks = max(-(-size // chunk), self.tasks)
        self.docs = docs.withColumn("__chunk", F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(self.chunks))).repartition(self.tasks, "__chunk")
        self.schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def ask(self, asker: Callable[[pa.Table], Iterator], *answers: DataFrame) -> DataFrame:
        """Rows for the buckets. asker(table, *earlier answers) gives (sorted unique hashes, arrays of their size)."""
        buckets = self.tasks

        def pack(chunk: int, hashes: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
            rows = [(b, chunk, n, data) for b, n, data in packed(hashes, columns, buckets)]
            return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["__bucket", "__chunk", "__n", "__asked"])

        def run(docs: pa.Table, *given: np.ndarray) -> pa.Table:
            released()
            return pack(docs["__chunk"][0].as_py(), *asker(docs, *given))

        return self.work(run, ASK, *answers)

    def work(self, run: Callable[..., pa.Table], schema: str, *answers: DataFrame) -> DataFrame:
        """run(documents of a chunk, answers to it) for each chunk."""
        if not answers:
            return self.docs.groupBy("__chunk").applyInArrow(lambda t: run(t), schema)
        (both,) = answers if len(answers) == 1 else [merged(answers)]
        n = len(answers)

        def cogrouped(docs: pa.Table, answer: pa.Table) -> pa.Table:
            each = [answer] if n == 1 else [answer.filter(pc.equal(answer["__round"], i)) for i in range(n)]
            return run(docs, *[unpacked_answer(a) for a in each])

        return self.docs.groupBy("__chunk").cogroup(both.repartition(self.tasks, "__chunk").groupBy("__chunk")).applyInArrow(cogrouped, schema)

    def answers(self, asked: DataFrame, answer: Callable[[np.ndarray, np.ndarray, list[np.ndarray]], np.ndarray], kinds: list[str]) -> DataFrame:
        """answer(order of the sorted hashes, starts of equal ones, columns as asked) gives a value for each asked hash."""

        def run(t: pa.Table) -> pa.Table:
            released()
            sizes = t["__n"].to_numpy()
            hashes, columns = unpacked(t["__asked"], sizes, kinds)
            order = np.argsort(hashes, kind="stable")
            new = np.ones(len(order), bool)
            new[1:] = hashes[order[1:]] != hashes[order[:-1]]
            starts = np.flatnonzero(new)
            number = np.empty(len(order), np.int64)
            number[order] = np.cumsum(new) - 1
            values = answer(order, starts, number, columns)
            cut = np.concatenate(([0], np.cumsum(sizes)))
            mask = columns[-1].astype(bool) if kinds and kinds[-1] == "flag" else None
            out = []
            for i in range(len(sizes)):
                part = values[cut[i] : cut[i + 1]]
                if mask is not None:
                    part = part[mask[cut[i] : cut[i + 1]]]
                out.append(part.tobytes())
            return pa.table([t["__chunk"], t["__bucket"], pa.array(out, pa.binary())], names=["__chunk", "__bucket", "__answer"])

        return asked.repartition(self.tasks, "__bucket").groupBy("__bucket").applyInArrow(run, ANSWER)


def released() -> None:
    """Give memory that earlier groups have freed back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def merged(answers: tuple[DataFrame, ...]) -> DataFrame:
    out = None
    for i, a in enumerate(answers):
        a = a.withColumn("__round", F.lit(i))
        out = a if out is None else out.unionByName(a)
    return out


def packed(hashes: np.ndarray, columns: list[np.ndarray], buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, number of hashes, bytes) for sorted unique hashes. By byte planes, since sorted high bytes compress to nothing."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    cut = np.concatenate(([0], edges, [len(hashes)])) if len(hashes) else np.zeros(1, np.int64)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        planes = np.ascontiguousarray(hashes[a:b].astype(">u8").view(np.uint8).reshape(-1, 8).T)
        low = planes[2:6] if _short(columns) else planes[2:8]
        parts = [planes[0].tobytes(), planes[1].tobytes(), np.ascontiguousarray(low.T).tobytes()]
        for c in columns:
            if not isinstance(c, str):
                parts.append(np.packbits(c[a:b]).tobytes() if c.dtype == bool else c[a:b].tobytes())
        yield int(bucket[a]), int(b - a), b"".join(parts)


def _short(columns: list) -> bool:
    return "48" in [c for c in columns if isinstance(c, str)]


SHORT = np.uint64(0xFFFFFFFFFFFF0000)
"""The bits that a hash of 48 bits keeps: enough for a filter that a longer hash follows."""


def unpacked(asked: pa.ChunkedArray, sizes: np.ndarray, kinds: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    total = int(sizes.sum())
    short = "48" in kinds
    types = [k for k in kinds if k != "48"]
    hashes = np.empty(total, np.uint64)
    columns = [np.empty(total, np.uint8 if k == "flag" else k) for k in types]
    at = 0
    for data, n in zip(asked, sizes.tolist(), strict=True):
        raw = np.frombuffer(data.as_buffer(), np.uint8)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, 0], whole[:, 1] = raw[:n], raw[n : 2 * n]
        width = 4 if short else 6
        whole[:, 2 : 2 + width] = raw[2 * n : (2 + width) * n].reshape(n, width)
        hashes[at : at + n] = whole.view(">u8").ravel()
        place = (2 + width) * n
        for c, k in zip(columns, types, strict=True):
            if k == "flag":
                used = -(-n // 8)
                c[at : at + n] = np.unpackbits(raw[place : place + used], count=n)
            else:
                used = n * c.itemsize
                c[at : at + n] = raw[place : place + used].view(c.dtype) if (place % c.itemsize == 0) else np.frombuffer(raw[place : place + used].tobytes(), c.dtype)
            place += used
        at += n
    return hashes, columns


def unpacked_answer(t: pa.Table) -> np.ndarray:
    """The answers of all buckets to a chunk, in the order of the hashes asked."""
    order = np.argsort(t["__bucket"].to_numpy())
    parts = t["__answer"].to_pylist()
    return np.frombuffer(bytearray().join(parts[i] for i in order), np.uint8) if parts else np.zeros(0, np.uint8)


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted unique hashes and how often each occurs, up to 255."""
    s = np.sort(hashes)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.flatnonzero(new)
    return s[at], np.minimum(np.diff(np.append(at, len(s))), 255).astype(np.uint8)


def total(counts: np.ndarray, order: np.ndarray, starts: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each asked hash, how often it occurs in the corpus, up to 255."""
    if not len(order):
        return np.zeros(0, np.uint8)
    sums = np.add.reduceat(counts[order].astype(np.int64), starts)
    return np.minimum(sums, 255).astype(np.uint8)[number]


def counted_pairs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted unique pairs of hashes (as two arrays), how often each occurs, up to 255, and the number of the pair of each item."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return a[at], b[at], np.minimum(np.diff(np.append(at, len(order))), 255).astype(np.uint8), place


def by_pairs(number: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, number) of asked hashes told apart by a second hash too, from the number of the first."""
    order = np.lexsort((two, number))
    new = np.ones(len(order), bool)
    new[1:] = (number[order[1:]] != number[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), out
