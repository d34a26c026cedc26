"""Benchmark passages in documents, exact or edited, by the q-gram lemma.

Texts are lower-cased and cut to words (`\\w+`) joined by one space. A passage of m characters that stands in
a document with at most k edits shares at least m + 1 - q * (k + 1) of its q-grams with it, on diagonals
(place in the document less place in the passage) at most k apart. Diagonals are dealt to cells of k + 1;
each two neighbours make an overlapping band that holds any such run of diagonals whole. Bands with enough
shared q-grams are regions, and a banded alignment of the passage against the region decides.

Passages are read in blocks of bounded size; a block goes to every task, documents are streamed and never
shuffled, and a long document is worked off in overlapping slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from graphloom.llm._shared import on_plain_names
from graphloom.llm._text import mix
from graphloom.session import ship

BLOCK_CHARS = 4 << 20
SLICE_CHARS = 1 << 18
POSTINGS = 1 << 22
"""Shared q-grams that are looked at together."""
LEAST_SHARED = 4
_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15


def plain(text: str | None) -> str:
    """The words of text, each with a space before and after; empty without words."""
    words = _WORD.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(c: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q-gram."""
    if len(c) < q:
        return np.zeros(0, np.uint64)
    single = mix(c.astype(np.uint64) + np.uint64(1))
    have, width = single, 1
    while width * 2 <= q:
        have = have[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + have[width:]
        width *= 2
    if width < q:  # the last part overlaps what is there: both ends of the q-gram
        have = have[: len(c) - q + 1] * np.uint64(pow(_BASE, 61, 1 << 64)) + have[q - width :]
    return mix(have)


def edits(passage: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int] | None:
    """(edits, end in region) of the best place of passage in region, None above most. Only diagonals that a
    placement with at most `most` edits can touch are kept: band entry b of row i is column i + b - most."""
    width = len(region) - len(passage) + 2 * most + 1
    if width <= 0:
        return None
    j, far = np.arange(width, dtype=np.int32), np.int32(1 << 28)
    held = np.full(width + 1, far, np.int32)  # one more entry, always far: nothing comes from beyond the band
    row, above = held[:width], held[1:]
    row[(j >= most) & (j - most <= len(region))] = 0
    padded = np.concatenate([np.full(most, 0xFFFFFFFF, np.uint32), region, np.full(most + 1, 0xFFFFFFFF, np.uint32)])
    for i, ch in enumerate(passage.tolist()):
        best = above + 1
        np.minimum(best, row + (padded[i : i + width] != ch), out=best)
        best -= j
        np.minimum.accumulate(best, out=best)
        np.add(best, j, out=row)
        if i & 7 == 7 and row.min() > most:
            return None
    end = len(passage) - most + j
    row = np.where((end >= 0) & (end <= len(region)), row, far)
    at = int(row.argmin())
    return (int(row[at]), int(end[at])) if row[at] <= most else None


def gram_length(m: int, q: int, percent: int) -> int:
    """The longest q-grams, up to q, of which a passage of m characters must share LEAST_SHARED with any place within its budget of edits; else the longest of which it must share one."""
    most = m * percent // 100 + 1
    return max(1, min(q, (m + 1 - LEAST_SHARED) // most)) if (m + 1 - LEAST_SHARED) // most >= 3 else max(1, min(q, m // most))


@dataclass
class Passages:
    """A block of passages, indexed by q-gram."""

    ids: list
    texts: list[str]
    q: int
    percent: int

    def __post_init__(self):
        self.codes = [codes(t) for t in self.texts]
        m = np.array([len(c) for c in self.codes], np.int64)
        self.budget = m * self.percent // 100
        self.least = np.maximum(1, m + 1 - self.q * (self.budget + 1))
        grams = [qgrams(c, self.q) for c in self.codes]
        every = np.concatenate(grams)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.starts = np.unique(every[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(every))
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.grams >> np.uint64(42)).astype(np.int64)] = True
        self.reach = int(m.max() + 2 * self.budget.max() + 2)

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(passage, edits, start, end) for each region of text that holds a passage."""
        c = codes(text)
        h = qgrams(c, self.q)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(42)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        real = self.grams[spot] == h[at]
        at, spot = at[real], spot[real]
        n = self.ends[spot] - self.starts[spot]
        if not len(n):
            return []
        span = int(len(c) + self.reach) + 2
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()), POSTINGS))
        for a, z in zip(cut, [*cut[1:], len(n)], strict=True):  # so many shared q-grams at a time
            part = n[a:z]
            post = np.repeat(self.starts[spot[a:z]] - np.concatenate(([0], np.cumsum(part)[:-1])), part) + np.arange(part.sum())
            item, diagonal = self.item[post], np.repeat(at[a:z], part) - self.place[post]
            k, inverse = np.unique(np.concatenate([keys, item * (2 * span) + diagonal // (self.budget[item] + 1) + span]), return_inverse=True)
            weights = np.concatenate([counts, np.ones(len(item), np.int64)])
            keys, counts = k, np.bincount(inverse, weights, len(k)).astype(np.int64)
        with_next = counts.copy()
        beside = keys[1:] == keys[:-1] + 1
        with_next[:-1][beside] += counts[1:][beside]
        out = []
        for k in keys[with_next >= self.least[keys // (2 * span)]].tolist():  # every band is aligned, also one beside a region that was found
            i, b = k // (2 * span), k % (2 * span) - span
            step = int(self.budget[i]) + 1
            a, z = max(0, b * step - step), min(len(c), (b + 2) * step + len(self.codes[i]) + step)
            exact = text.find(self.texts[i], a, z)
            if exact >= 0:
                out.append((i, 0, exact, exact + len(self.texts[i])))
            elif (found := edits(self.codes[i], c[a:z], step - 1)) is not None:
                out.append((i, found[0], max(a, a + found[1] - len(self.codes[i])), a + found[1]))
        return out

    def best(self, texts: list[str]) -> list[dict[int, tuple[int, int, int]]]:
        """For each text, the place with the fewest edits, then the first, of each passage in it.

        Short texts are searched together, with more blanks between them than any passage has edits: no placement
        can reach over. Long ones are searched in slices that overlap by more than a passage.
        """
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        gap = "\0" * (int(self.budget.max()) + 1)
        group: list[int] = []
        filled = 0

        def together() -> None:
            starts = np.cumsum([0] + [len(texts[n]) + len(gap) for n in group])
            for i, e, s, z in self.search(gap.join(texts[n] for n in group)):
                k = int(np.searchsorted(starts, max(s, z - len(self.texts[i]) // 2), "right")) - 1
                own = found[group[k]]
                own[i] = min(own.get(i, (1 << 30, 0, 0)), (e, max(0, s - int(starts[k])), z - int(starts[k])))

        for n, text in enumerate(texts):
            if len(text) > SLICE_CHARS:
                for a in range(0, max(1, len(text) - self.reach), SLICE_CHARS):
                    for i, e, s, z in self.search(text[a : a + SLICE_CHARS + 2 * self.reach]):
                        found[n][i] = min(found[n].get(i, (1 << 30, 0, 0)), (e, s + a, z + a))
                continue
            group.append(n)
            filled += len(text) + len(gap)
            if filled > SLICE_CHARS:
                together()
                group, filled = [], 0
        if group:
            together()
        return found


def blocks(benchmark: DataFrame, item: str, text: str, q: int, percent: int, least_words: int) -> Iterator[list[Passages]]:
    """Passages, block by block; those for which q-grams of q would ask for nothing have shorter ones."""
    ship(benchmark.sparkSession)
    benchmark = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text"))
    item, text = "item", "text"
    size = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    parts = -(-size // BLOCK_CHARS)
    for p in range(parts):
        rows = benchmark.where(F.pmod(F.xxhash64(item, text), F.lit(parts)) == p).select(item, text).collect()
        by: dict[tuple[int, int], tuple[list, list]] = {}
        for i, t in rows:
            t = plain(t)
            if len(t.split()) >= max(1, least_words):
                ids, texts = by.setdefault(gram_length(len(t), q, percent), ([], []))
                ids.append(i), texts.append(t)
        if by:
            yield [Passages(ids, texts, k, percent) for k, (ids, texts) in sorted(by.items())]


def find_passages(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", q: int = 8, percent: int = 10, least_words: int = 1) -> DataFrame:
    """One row for each document and passage found in it: key, item, edits, start, end, passage.

    percent: edits allowed, as a share of the passage's characters (with the blank before and after), whatever its length: q-grams
    are shorter where the lemma would else ask for nothing. edits is the least over all places, start and end are places in plain(text), passage is what stands there
    in the document. Passages of fewer than least_words words, which is to be asked for, are not looked for. Null and
    empty texts hold nothing; rows with one key or a null key are documents of their own and give rows of their
    own. Equal passages under several items each give a row. Other columns of docs are not returned.
    """
    slim = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    schema = f"key {slim.schema['__key'].dataType.simpleString()}, item {benchmark.schema[item].dataType.simpleString()}, edits int, start int, end int, passage string"
    out, id_type = docs.sparkSession.createDataFrame([], schema), to_arrow_type(benchmark.schema[item].dataType)
    for passages in blocks(benchmark, item, item_text, q, percent, least_words):

        def run(batches: Iterator[pa.RecordBatch], passages: list[Passages] = passages) -> Iterator[pa.RecordBatch]:
            names = ["key", "item", "edits", "start", "end", "passage"]
            for batch in batches:
                texts = [plain(t.as_py()) for t in batch["__text"]]
                rows = [(n, p.ids[i], e, s, z, texts[n][s:z]) for p in passages for n, found in enumerate(p.best(texts)) for i, (e, s, z) in found.items()]
                keys = batch["__key"].take(pa.array([r[0] for r in rows], pa.int64()))
                rest = [pa.array([r[k] for r in rows], kind) for k, kind in ((2, pa.int32()), (3, pa.int32()), (4, pa.int32()), (5, pa.string()))]
                yield pa.RecordBatch.from_arrays([keys, pa.array([r[1] for r in rows], id_type), *rest], names=names)

        out = out.unionByName(slim.mapInArrow(run, schema))
    return out.toDF(key, item, *out.columns[2:])


def without_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", q: int = 8, percent: int = 10, least_words: int = 1) -> DataFrame:
    """docs, all columns of any names, without the rows that find_passages() would find a passage in."""
    parts = blocks(benchmark, item, item_text, q, percent, least_words)

    def clean(kept: DataFrame, column: str) -> DataFrame:
        for passages in parts:

            def run(batches: Iterator[pa.RecordBatch], passages: list[Passages] = passages) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    texts = [plain(t.as_py()) for t in batch[column]]
                    held = [p.best(texts) for p in passages]
                    yield batch.filter(pa.array([not any(h[n] for h in held) for n in range(len(texts))], pa.bool_()))

            kept = kept.mapInArrow(run, kept.schema)
        return kept

    return on_plain_names(docs, clean, text)
