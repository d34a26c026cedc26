"""Repeated runs of lines, found by winnowing.

Of every w consecutive lines (lines without a word are passed over), the one with the least hash is a
fingerprint. Any run of w lines that stands in two places has the same fingerprint in both, so fingerprints
that occur once rule out all windows they stand for. The others are joined by position: each place of a window around
a fingerprint gets the first place in the corpus where the same window stands (document and line), by 128 bits. Windows that
lie next to each other and whose first places do too are one match, extended up and down as far as that goes; what lies
in matches with an earlier place is deleted. No pairs are formed within a group: each place is joined to the first only.

With a bound by content (`words`) the windows are, besides those of w lines, those of fewer lines that hold so many words,
and short texts as wholes. Each has its minimum, so any of these runs holds a fingerprint wherever it stands.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm._chunks import Chunked, by_pairs, counted, total
from graphloom.llm._shared import on_plain_names
from graphloom.llm._text import Words, span_hashes

WHOLE = np.uint64(0x94D049BB133111EB)
"""Sets the hash of a whole text apart from that of the same lines within one."""

ADDED = "n_lines long, n_removed_lines long, kept_text string, removed_lines array<long>, matches array<struct<line:long,lines:long,first_key:long,first_line:long>>"
MATCH = pa.list_(pa.struct([("line", pa.int64()), ("lines", pa.int64()), ("first_key", pa.int64()), ("first_line", pa.int64())]))
FIRST = np.dtype([("here", "u1"), ("key", "<i8"), ("line", "<i8")])
"""What a window is told: whether its chunk has the first place, and where that is."""


class _Lines:
    """Lines with a word: hash of the words, text and number within the text of each."""

    def __init__(self, texts: pa.ChunkedArray, w: int, least: int | None = None):
        self.least = least
        words = Words(texts)
        breaks = np.flatnonzero(words.buf == 10)
        line = np.searchsorted(breaks, words.starts) + words.doc  # each text begins a line
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        start = np.flatnonzero(new)
        self.hashes = span_hashes(words.hashes, start, np.append(start[1:], len(line)))
        self.sizes = np.diff(np.append(start, len(line)))
        self.doc = words.doc[start]
        self.texts = len(words.counts)
        self.first = np.searchsorted(self.doc, np.arange(self.texts + 1))
        breaks_before = np.searchsorted(breaks, words.offsets[:-1])
        self.number = (line[start] - self.doc) - breaks_before[self.doc]  # within the text, blank lines counted
        self.words = words
        self.at, self.length, self.whole = self._spans(w)
        self.place = np.zeros(len(self.at), np.int64)  # of the least line of each window, the last of equals
        for k in range(1, w + 1):
            some = np.flatnonzero(self.length == k)
            if len(some):
                view = self.hashes[self.at[some, None] + np.arange(k)]
                self.place[some] = self.at[some] + k - 1 - view[:, ::-1].argmin(axis=1)

    def _spans(self, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first line, number of lines, is a whole text) of the windows of w lines and, with a bound by words, of those of fewer lines that reach it and of texts that have neither."""
        at = np.arange(len(self.hashes))
        left = self.first[1:][self.doc] - at if len(at) else at
        starts, lengths, short = [at[left >= w]], [np.full(np.count_nonzero(left >= w), w)], np.zeros(0, bool)
        if self.least is not None:
            sums = np.concatenate(([0], np.cumsum(self.sizes)))
            for k in range(1, w):
                some = at[left >= k]
                some = some[sums[some + k] - sums[some] >= self.least]
                starts.append(some), lengths.append(np.full(len(some), k))
            a, b = self.first[:-1], self.first[1:]
            short = (b > a) & (b - a < w) & (sums[b] - sums[a] < self.least)
            starts.append(a[short]), lengths.append((b - a)[short])
        lengths = np.concatenate(lengths)
        return np.concatenate(starts), lengths, np.arange(len(lengths)) >= len(lengths) - np.count_nonzero(short)

    def fingerprints(self) -> np.ndarray:
        """Hashes of the selected lines, one for each place."""
        return self.hashes[np.unique(self.place)]

    def opened(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first line, number of lines, hash, second hash) of the windows that may stand in two places: their fingerprint does. hit: by sorted unique fingerprint."""
        mark = self.hashes[self.place]
        some = hit[np.searchsorted(np.unique(mark), mark)].astype(bool) if len(mark) else np.zeros(0, bool)
        at, length = self.at[some], self.length[some]
        apart = np.where(self.whole[some], WHOLE, np.uint64(0))
        return at, length, span_hashes(self.hashes, at, at + length) ^ apart, span_hashes(self.hashes, at, at + length, "again") ^ apart


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", run: int = 4, words: int | None = None) -> DataFrame:
    """Delete lines that lie in a run of `run` or more lines with words that also stands earlier.

    Lines are the parts between \\n; two are equal if their words are (white space aside). Earlier: a lower
    key (an integer), or the same key and a lower line; null keys come last. Adds n_lines (lines with a word),
    n_removed_lines, kept_text (the rest, joined by \\n, blank lines kept) and removed_lines (their numbers
    from 0 among all lines). Null texts have no lines and a null kept_text; texts with fewer than `run` lines
    are left alone unless `words` is given. Then a run of fewer lines is deleted too if it holds `words` or more
    words and stands earlier, and so is a text of fewer lines and words if an earlier text has just its lines. Among rows with one key the earlier is a matter of their text's hash. Columns of docs that
    have the name of an added one are replaced; others may have any name. Texts are
    read whole, of any length. A null key is given as the largest integer in matches. A key that is no integer raises ValueError.
    """
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{key} has to be an integer: lower keys come first")
    added = ["n_lines", "n_removed_lines", "kept_text", "removed_lines", "matches"]
    return on_plain_names(docs, lambda plain, k, t: _dedup(plain, k, t, run, words), key, text, added=added)


def _dedup(docs: DataFrame, key: str, text: str, run: int, words: int | None) -> DataFrame:
    """dedup_lines() of docs with plain names."""
    corpus = Chunked(docs, key, text)
    last = np.iinfo(np.int64).max

    def ordered(t: pa.Table) -> pa.Table:
        return t.sort_by([(key, "ascending"), (text, "ascending")])

    def places(t: pa.Table) -> np.ndarray:
        return np.array([last if v is None else v for v in t[key].to_pylist()], np.int64)

    def ask_marks(t: pa.Table) -> tuple:
        lines = _Lines(t[text], run, words)
        marks, counts = counted(lines.fingerprints())
        return marks, [counts]

    def joined(order, starts, number, columns) -> np.ndarray:
        return (total(columns[0], order, starts, number) > 1).astype(np.uint8)

    def firsts(t: pa.Table, lines: _Lines, at: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted unique pairs of hashes, the first window with each, and the number of each window's pair."""
        by = np.lexsort((lines.number[at], places(t)[lines.doc[at]], two, one))
        new = np.ones(len(by), bool)
        new[1:] = (one[by[1:]] != one[by[:-1]]) | (two[by[1:]] != two[by[:-1]])
        number = np.empty(len(by), np.int64)
        number[by] = np.cumsum(new) - 1
        return one[by[new]], two[by[new]], at[by[new]], number

    def ask_runs(t: pa.Table, hit: np.ndarray) -> tuple:
        t = ordered(t)
        lines = _Lines(t[text], run, words)
        at, _, one, two = lines.opened(hit)
        one, two, first, _ = firsts(t, lines, at, one, two)
        chunk = t["__chunk"][0].as_py()
        return one, [places(t)[lines.doc[first]], np.full(len(first), chunk, np.int64), lines.number[first].astype(np.int64), two]

    def joined_places(order, starts, number, columns) -> np.ndarray:
        """For each window, the first place in the corpus where it stands: by key, then chunk, then line."""
        if not len(order):
            return np.zeros(0, FIRST)
        place, chunk, line, two = columns
        _, _, number = by_pairs(number, two)
        by = np.lexsort((line, chunk, place, number))
        head = np.ones(len(by), bool)
        head[1:] = number[by[1:]] != number[by[:-1]]
        first = by[head][number]
        out = np.zeros(len(order), FIRST)
        out["here"], out["key"], out["line"] = (place == place[first]) & (chunk == chunk[first]), place[first], line[first]
        return out

    def matches_of(lines: _Lines, at: np.ndarray, length: np.ndarray, told: np.ndarray) -> list[list[dict]]:
        """Windows with an earlier place, put together: next to each other here and there, they are one match."""
        out: list[list[dict]] = [[] for _ in range(lines.texts)]
        for i in np.lexsort((length, at)).tolist():
            d, line, size = int(lines.doc[at[i]]), int(lines.number[at[i]]), int(length[i])
            end = int(lines.number[at[i] + size - 1]) + 1
            last = out[d][-1] if out[d] else None
            same = last and last["first_key"] == int(told["key"][i]) and line - last["line"] == int(told["line"][i]) - last["first_line"] and line <= last["line"] + last["lines"]
            if same:
                last["lines"] = max(last["lines"], end - last["line"])
            else:
                out[d].append({"line": line, "lines": end - line, "first_key": int(told["key"][i]), "first_line": int(told["line"][i])})
        return out

    def cut(t: pa.Table, hit: np.ndarray, first_places: np.ndarray) -> pa.Table:
        t = ordered(t)
        lines = _Lines(t[text], run, words)
        at, length, one, two = lines.opened(hit)
        told = first_places.view(FIRST)
        _, _, first, number = firsts(t, lines, at, one, two)
        told = told[number]
        later = ~(told["here"].astype(bool) & (first[number] == at)) if len(at) else np.zeros(0, bool)
        at, length, told = at[later], length[later], told[later]
        depth = np.zeros(len(lines.hashes) + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + length, -1)
        gone = np.cumsum(depth[:-1]) > 0
        kept, numbers = [], []
        for d, whole in enumerate(t[text].to_pylist()):
            own = slice(lines.first[d], lines.first[d + 1])
            drop = set(lines.number[own][gone[own]].tolist())
            numbers.append(sorted(drop))
            kept.append(whole if not drop else "\n".join(x for i, x in enumerate(whole.split("\n")) if i not in drop))
        out = t.drop_columns(["__chunk"])
        for name, values, kind in (("n_lines", np.diff(lines.first), pa.int64()), ("n_removed_lines", [len(x) for x in numbers], pa.int64()), ("kept_text", kept, pa.string()), ("removed_lines", numbers, pa.list_(pa.int64())), ("matches", matches_of(lines, at, length, told), MATCH)):
            out = out.append_column(name, pa.array(values, kind))
        return out

    hits = corpus.answers(corpus.ask(ask_marks), joined, ["uint8"])
    first_places = corpus.answers(corpus.ask(ask_runs, hits), joined_places, ["int64", "int64", "int64", "uint64"])
    return corpus.work(cut, f"{corpus.schema}, {ADDED}", hits, first_places)
