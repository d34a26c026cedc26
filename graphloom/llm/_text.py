"""Word spans and hashes of many texts at once, as numpy arrays over one byte buffer.

A word is a run of bytes outside the six ASCII separators (space, \\t, \\n, \\v, \\f, \\r), which
is `[^\\x20\\x09-\\x0D]+` over UTF-8. Hashes are polynomials over 64-bit words, read off prefix sums,
so a hash of any span costs two look-ups whatever its length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93, "again": 0xA24BAED4963EE407}
_SLICE = 1 << 20
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base, and of its inverse modulo 2**64."""
    if kind not in _powers or len(_powers[kind][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        base, out = _BASES[kind], []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _powers[kind] = (out[0], out[1])
    p, q = _powers[kind]
    return p[:n], q[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): all texts in one buffer, each followed by a space; null is as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):  # no chunk at all
        texts = pa.array([], pa.large_string())
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    texts = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(buf: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of buf. Works on slices of 1 MB that end at a separator;
    a single word that is longer than a slice is hashed by itself."""
    starts, ends, hashes, at = [], [], [], 0
    while at < len(buf):
        part = buf[at : at + _SLICE]
        stop = len(part)
        if at + stop < len(buf):
            back = np.flatnonzero(SEPARATOR[part[-4096:]])
            back = back + stop - len(part[-4096:]) if len(back) else np.flatnonzero(SEPARATOR[part])
            if len(back):
                stop = int(back[-1]) + 1
            else:  # one word fills the slice
                end = at + stop
                while end < len(buf):
                    hit = np.flatnonzero(SEPARATOR[buf[end : end + _SLICE]])
                    end += int(hit[0]) if len(hit) else len(buf[end : end + _SLICE])
                    if len(hit):
                        break
                whole = buf[at:end]
                raw = hashlib.blake2b((LOWER[whole] if lower else whole).tobytes(), digest_size=8).digest()
                starts.append(np.array([at])), ends.append(np.array([end])), hashes.append(np.frombuffer(raw, np.uint64))
                at = end
                continue
        part = part[:stop]
        gap = SEPARATOR[part]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
        s, e = edge[0::2], edge[1::2]
        p, q = powers("byte", stop)
        sums = np.zeros(stop + 1, np.uint64)
        np.cumsum(_BYTE[LOWER[part] if lower else part] * p, out=sums[1:])
        starts.append(s + at), ends.append(e + at)
        hashes.append(mix((sums[e] - sums[s]) * q[s] if len(s) else np.zeros(0, np.uint64)))
        at += stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def span_hashes(items: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str = "word") -> np.ndarray:
    """A hash of items[start:end] for each span of 64-bit items; kind "again" gives one that is independent of the first."""
    n = len(items)
    if kind == "again":
        items = mix(items + np.uint64(_BASES["again"]))
    p, q = powers(kind, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(items * p[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of the texts of one table: span and hash of each word, and where each text's words begin."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array, lower: bool = False):
        self.buf, self.offsets = joined(texts)
        self.starts, self.ends, self.hashes = words(self.buf, lower)
        self.first = np.searchsorted(self.starts, self.offsets)  # of text d: first[d] to first[d + 1]
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, k: int) -> np.ndarray:
        """Numbers of the words at which a window of k words of one text starts."""
        at = np.arange(len(self.starts))
        return at[self.first[1:][self.doc] - at >= k] if len(at) else at

    def place(self, at: np.ndarray) -> np.ndarray:
        """Number of a word within its text."""
        return at - self.first[self.doc[at]]

    def word_list(self, d: int) -> list[bytes]:
        return self.buf[self.offsets[d] : self.offsets[d + 1]].tobytes().split()
