"""Greedy longest-match token counts with a linear automaton.

The vocabulary is a trie over bytes. Where a word leaves the trie, the failure link leads to the node that
stands for what is left after the tokens that must be popped, and their number is kept with the link. So each
byte of a word is read once and no piece is ever built. A word is matched with a space before it, as byte-level
vocabularies mark the start of a word.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm._shared import on_plain_names
from graphloom.session import ship

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
MOST_BYTES = 64 << 20
_built: dict[str, "Automaton"] = {}


def byte_names() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: printable ones stand for themselves, the others for 256 and on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str = TOKENIZER) -> list[bytes]:
    """Tokens of a byte-level vocabulary file, as bytes."""
    names = byte_names()
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return sorted({bytes(names[c] for c in t) for t in vocabulary if t and all(c in names for c in t)})


class Automaton:
    """Counts the tokens that greedy longest match cuts a word into. A byte that no token begins with is a token of its own."""

    def __init__(self, tokens: list[bytes], cached: int = 1 << 18):
        self.go: dict[int, int] = {}  # node * 256 + byte: child
        ends, parent = [True], [(0, 0)]
        for t in [bytes([b]) for b in range(256)] + list(tokens):
            node = 0
            for b in t:
                child = self.go.get(node << 8 | b)
                if child is None:
                    child = self.go[node << 8 | b] = len(ends)
                    ends.append(False), parent.append((node, b))
                node = child
            ends[node] = True
        depth = [0] * len(ends)
        for v in range(1, len(ends)):
            depth[v] = depth[parent[v][0]] + 1
        self.link, self.popped = [0] * len(ends), [0] * len(ends)
        for v in sorted(range(1, len(ends)), key=depth.__getitem__):
            if ends[v]:
                self.popped[v] = 1
            else:
                u, b = parent[v]
                z, n = self.link[u], self.popped[u]
                while (child := self.go.get(z << 8 | b)) is None:
                    n += self.popped[z]
                    z = self.link[z]
                self.link[v], self.popped[v] = child, n
        self.known: dict[bytes, int] = {}
        self.cached = cached

    def count(self, word: bytes) -> int:
        n, node, go, link, popped = 0, 0, self.go, self.link, self.popped
        for b in word:
            child = go.get(node << 8 | b)
            while child is None:
                n += popped[node]
                node = link[node]
                child = go.get(node << 8 | b)
            node = child
        while node:
            n += popped[node]
            node = link[node]
        return n

    def total(self, words: list[bytes]) -> int:
        """Tokens of all words, each with a space before it. Short words are counted once and remembered."""
        n, known = 0, self.known
        for w in words:
            k = known.get(w)
            if k is None:
                k = self.count(b" " + w)
                if len(w) <= 32:
                    if len(known) >= self.cached:
                        known.clear()
                    known[w] = k
            n += k
        return n


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: list[bytes] | str = TOKENIZER) -> DataFrame:
    """docs with n_words, n_tokens (greedy longest match) and n_bytes. Null and empty texts have none of each.

    vocabulary: tokens, or the path of a byte-level vocabulary file that the driver reads. It goes to every
    task, so it may hold 64 MB at most. Texts are counted whole and one by one; repeated rows count alike.
    Columns of docs named like an added one are replaced, others may have any name.
    """
    ship(docs.sparkSession)
    tokens = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else list(vocabulary)
    if sum(map(len, tokens)) > MOST_BYTES:
        raise ValueError("the vocabulary is too large to go to every task")
    name = hashlib.sha256(b"\0".join(tokens)).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
        if name not in _built:
            _built.clear()
            _built[name] = Automaton(sent.value)
        automaton = _built[name]
        for batch in batches:
            rows = []
            for t in batch[text]:
                raw = (t.as_py() or "").encode("utf-8")
                words = raw.split()
                rows.append((len(words), automaton.total(words), len(raw)))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "n_words", "n_tokens", "n_bytes"])

    def counted(plain: DataFrame, column: str) -> DataFrame:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
        return plain.mapInArrow(lambda batches: run(batches, column), f"{schema}, n_words long, n_tokens long, n_bytes long")

    return on_plain_names(docs, counted, text, added=["n_words", "n_tokens", "n_bytes"])
