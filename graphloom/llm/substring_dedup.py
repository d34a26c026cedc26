"""Exact repeated passages, found with fixed-block anchors.

Every window of w words holds one whole block of b = (w + 1) / 2 words that starts at a multiple of b
words. So only those non-overlapping blocks are indexed (1/b of the words), and every rolling window of b
words probes the index. A block that occurs nowhere else rules out all windows that hold it. Windows whose
block has a partner are the extended hits: they are compared whole, and the union of the repeated ones is
the set of maximal exact repeats. No pairs are formed: each stage counts occurrences by hash, so the work
is linear whatever the size of a group of copies.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm._chunks import SHORT, Chunked, by_pairs, counted, counted_pairs, total
from graphloom.llm._shared import on_plain_names
from graphloom.llm._text import Words, span_hashes

ADDED = "n_words long, n_removed long, kept_text string, removed_spans array<struct<start:long,end:long>>"


def _anchors(w: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each rolling window, words at which blocks start, their hashes); blocks are not yet hits."""
    at = w.windows(block)
    rolling = span_hashes(w.hashes, at, at + block) & SHORT
    is_block = w.place(at) % block == 0
    return rolling, at[is_block], rolling[is_block]


def _open_windows(w: Words, window: int, block: int, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows whose block is a hit, and two hashes of each, 128 bits in all."""
    _, at, anchors = _anchors(w, block)
    found = np.zeros(len(w.starts), bool)
    index = np.unique(anchors)
    found[at] = hit[np.searchsorted(index, anchors)].astype(bool) if len(index) else False
    starts = w.windows(window)
    starts = starts[found[starts + (-w.place(starts)) % block]] if len(starts) else starts
    return starts, span_hashes(w.hashes, starts, starts + window), span_hashes(w.hashes, starts, starts + window, "again")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """Remove each word that lies in a window of `window` words whose word sequence starts anywhere else too.

    Adds n_words, n_removed, kept_text (kept words joined by one space) and removed_spans (word numbers,
    end excluded). Windows are judged on the input; all copies go, the first included. Null and empty texts
    have no words; texts of fewer than `window` words are never touched. Rows with the same key, or a null
    key, are separate documents. Columns of docs that have the name of an added one are replaced.
    Whole windows are compared by 128 bits; index and probe hashes have 48 and only rule windows out. Texts are read whole,
    of any length; other columns of docs may have any name.
    """
    if window < 1 or window % 2 == 0:
        raise ValueError("window must be odd")
    return on_plain_names(docs, lambda plain, k, t: _dedup(plain, k, t, window), key, text, added=["n_words", "n_removed", "kept_text", "removed_spans"])


def _dedup(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """dedup_substrings() of docs with plain names."""
    block = (window + 1) // 2
    corpus = Chunked(docs, key, text)

    def ask_blocks(t: pa.Table) -> tuple:
        rolling, _, anchors = _anchors(Words(t[text]), block)
        hashes, counts = counted(rolling)
        return hashes, ["48", counts, np.isin(hashes, anchors)]

    def indexed_and_probed(order, starts, number, columns) -> np.ndarray:
        counts, indexed = columns
        held = np.maximum.reduceat(indexed[order], starts)[number] if len(order) else indexed
        return ((total(counts, order, starts, number) > 1) & (held > 0)).astype(np.uint8)

    def ask_windows(t: pa.Table, hit: np.ndarray) -> tuple:
        _, one, two = _open_windows(Words(t[text]), window, block, hit)
        one, two, counts, _ = counted_pairs(one, two)
        return one, [counts, two]

    def repeated(order, starts, number, columns) -> np.ndarray:
        counts, two = columns
        return (total(counts, *by_pairs(number, two)) > 1).astype(np.uint8)

    def cut(t: pa.Table, hit: np.ndarray, again: np.ndarray) -> pa.Table:
        w = Words(t[text])
        starts, one, two = _open_windows(w, window, block, hit)
        if len(starts):
            starts = starts[again[counted_pairs(one, two)[3]].astype(bool)]
        depth = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + window, -1)
        gone = np.cumsum(depth[:-1]) > 0
        kept, spans, removed = [], [], np.zeros(len(w.counts), np.int64)
        for d in range(len(w.counts)):
            a, b = w.first[d], w.first[d + 1]
            here, own = gone[a:b], w.word_list(d)
            removed[d] = int(here.sum())
            edge = np.flatnonzero(np.diff(np.concatenate(([False], here, [False])).view(np.int8))) if removed[d] else []
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[0::2], edge[1::2], strict=True)])
            kept.append(b" ".join(compress(own, ~here) if removed[d] else own).decode("utf-8"))
        out = t.drop_columns(["__chunk"])
        for name, values, kind in (
            ("n_words", w.counts, pa.int64()), ("n_removed", removed, pa.int64()), ("kept_text", kept, pa.string()),
            ("removed_spans", spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ):
            out = out.append_column(name, pa.array(values, kind))
        return out

    hits = corpus.answers(corpus.ask(ask_blocks), indexed_and_probed, ["48", "uint8", "flag"])
    again = corpus.answers(corpus.ask(ask_windows, hits), repeated, ["uint8", "uint64"])
    return corpus.work(cut, f"{corpus.schema}, {ADDED}", hits, again)
