"""The best documents of a corpus for each of many queries, by lists in order of impact and the best position algorithm.

Documents are dealt as Spark reads them. One pass counts documents, terms and in how many documents each term of the queries
stands. A second one cuts each task's documents into segments of bounded size. In a segment each term has a list of documents
by falling impact (its share of a document's score) and a way to look a document up in it. A query goes down its lists in
step; each document met is looked up in all lists of the query at once, which gives its whole score and marks its places as
seen. The best position of a list is the end of the stretch from its begin in which every place is seen, by going down or by
looking up: it lies at or below the last place read. No document not yet met can score more than the impacts that follow the
best positions, together. The query ends in a segment as soon as that sum is strictly below its k-th best score so far in
the task, since equal scores are told apart by key. Only the best k of each query leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from graphloom.llm._text import joined, words
from graphloom.session import ship

QUERY_BYTES = 8 << 20
"""Text of queries that goes to every task at once; each further block is another pass over the documents."""
SLICE_BYTES = 4 << 20
POSTINGS = 1 << 20
FIRST_STEP = 64
SALTS = 256
TERM = np.arange(256, dtype=np.uint8)
TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20
TERM[0x41:0x5B] += 0x20


class Texts:
    """Terms `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` of texts, A-Z in lower case: hash, length and text of each."""

    def __init__(self, texts: pa.Array):
        buf, offsets = joined(texts)
        self.buf = TERM[buf]
        self.starts, self.ends, self.hashes = words(self.buf)
        first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_BYTES of text each; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at, filled = 0, 0
    for i, n in enumerate(sizes):
        if i > at and filled + n > SLICE_BYTES:
            yield at, i
            at, filled = i, 0
        filled += int(n)
    if at < len(sizes):
        yield at, len(sizes)


class Queries:
    """Terms of a block of queries: hashes of the vocabulary, and for each query its terms and how often it has them."""

    def __init__(self, ids: list, texts: list[str | None]):
        t = Texts(pa.array(texts, pa.string()))
        self.ids = ids
        self.vocabulary, first, number = np.unique(t.hashes, return_index=True, return_inverse=True)
        self.lengths = (t.ends - t.starts)[first]
        self.queries = []
        for q in range(len(ids)):
            self.queries.append(np.unique(number[t.doc == q], return_counts=True) if t.counts[q] else (np.zeros(0, np.int64), np.zeros(0, np.int64)))

    def postings(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of the terms of the vocabulary in texts; told by 64 bits and the length."""
        size = len(self.vocabulary)
        if not size or not len(t.hashes):
            return (np.zeros(0, np.int64),) * 3
        at = np.minimum(np.searchsorted(self.vocabulary, t.hashes), size - 1)
        own = (self.vocabulary[at] == t.hashes) & (self.lengths[at] == t.ends - t.starts)
        pair, n = np.unique(t.doc[own] * size + at[own], return_counts=True)
        return pair // size, pair % size, n


class Segment:
    """Documents with a list by falling impact for each term, and ways to look a document up in a list."""

    def __init__(self, size: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, vocabulary: int):
        order = np.lexsort((-impact, term))
        self.size, self.doc, self.impact = size, doc[order], impact[order]
        self.cut = np.searchsorted(term[order], np.arange(vocabulary + 1))
        self.by_doc = np.lexsort((self.doc, term[order]))
        self.tables: dict[int, np.ndarray] = {}

    def places(self, term: int, docs: np.ndarray) -> np.ndarray:
        """The place of each document in a term's list, or -1. Long lists have a table, in short ones it is searched for."""
        a, z = self.cut[term], self.cut[term + 1]
        if 8 * (z - a) >= self.size:
            if term not in self.tables:
                self.tables[term] = np.full(self.size, -1, np.int32)
                self.tables[term][self.doc[a:z]] = np.arange(z - a, dtype=np.int32)
            return self.tables[term][docs]
        by = self.by_doc[a:z]
        at = np.minimum(np.searchsorted(self.doc[by], docs), z - a - 1)
        return np.where(self.doc[by[at]] == docs, by[at] - a, -1)

    def best(self, terms: np.ndarray, times: np.ndarray, keys: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): the k best by score, then key. floor: what k documents elsewhere have at least; -1 if there are not so many."""
        held = [(int(t), int(n), self.cut[t], self.cut[t + 1]) for t, n in zip(terms, times, strict=True) if self.cut[t + 1] > self.cut[t]]
        unseen = [np.ones(z - a + 1, bool) for _, _, a, z in held]
        met, best = np.zeros(self.size, bool), [0] * len(held)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, FIRST_STEP
        while held:
            read = [self.doc[a + at : min(a + at + step, z)] for _, _, a, z in held if a + at < z]
            new = np.unique(np.concatenate(read)) if read else np.zeros(0, np.int64)
            new = new[~met[new]]
            met[new] = True
            total = np.zeros(len(new), np.int64)
            bound = 0
            for i, (t, n, a, z) in enumerate(held):
                place = self.places(t, new)
                own = np.flatnonzero(place >= 0)
                total[own] += n * self.impact[a + place[own]]
                unseen[i][place[own]] = False
                best[i] += int(unseen[i][best[i] :].argmax())  # the last entry, behind the list, stays unseen
                if best[i] < z - a:
                    bound += n * int(self.impact[a + best[i]])
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, total])
            if len(docs) > k:
                order = np.lexsort((keys[docs], -scores))[:k]
                docs, scores = docs[order], scores[order]
            least = max(int(scores[-1]) if len(docs) == k else -1, floor)
            if not bound or bound < least:
                break
            at, step = at + step, 2 * step
        return docs, scores


def _weights(counts: dict[int, int], size: int) -> np.ndarray:
    n = counts.get(-1, 0)
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(t, 0) + 1))) for t in range(size)], np.int64)


def _counted(slim: DataFrame, queries: Queries) -> dict[int, int]:
    """Documents that hold each term; under -1 the documents with a term, under -2 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, terms = np.zeros(len(queries.vocabulary), np.int64), 0, 0
        for batch in batches:
            for a, z in slices(batch["__text"]):
                t = Texts(batch["__text"].slice(a, z - a))
                held += np.bincount(queries.postings(t)[1], minlength=len(held))
                documents, terms = documents + int((t.counts > 0).sum()), terms + int(t.counts.sum())
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], at]), pa.int32()), pa.array(np.concatenate([[documents, terms], held[at]]), pa.int64())], names=["term", "n"])

    return {r.term: r.n for r in slim.select("__text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _found(slim: DataFrame, queries: Queries, counts: dict[int, int], k: int, schema: str, id_type: pa.DataType) -> DataFrame:
    weights, n_docs, n_terms, vocabulary = _weights(counts, len(queries.vocabulary)), counts.get(-1, 0), counts.get(-2, 0), len(queries.vocabulary)
    asked = [(t[weights[t] > 0], n[weights[t] > 0]) for t, n in queries.queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        top = [(none, none, np.zeros(0, bool)) for _ in asked]  # scores, keys, which keys are null
        parts: list[tuple] = []
        size = filled = 0

        def search() -> None:
            nonlocal parts, size, filled
            doc, term, times, counts, keys, null = (np.concatenate(x) for x in zip(*parts, strict=True))
            m = 75 + (25 * counts * n_docs) // n_terms
            impact = weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
            s = Segment(size, doc, term, impact, vocabulary)
            for q, (terms, n) in enumerate(asked):
                scores, own, gone = top[q]
                docs, more = s.best(terms, n, keys, k, int(scores[-1]) if len(scores) == k else -1)
                if len(docs):
                    scores, own, gone = np.concatenate([scores, more]), np.concatenate([own, keys[docs]]), np.concatenate([gone, null[docs]])
                    order = np.lexsort((own, gone, -scores))[:k]
                    top[q] = (scores[order], own[order], gone[order])
            parts, size, filled = [], 0, 0

        for batch in batches:
            for a, z in slices(batch["__text"]):
                t = Texts(batch["__text"].slice(a, z - a))
                key = batch["__key"].slice(a, z - a)
                doc, term, times = queries.postings(t)
                null = key.is_null().to_numpy(zero_copy_only=False)
                parts.append((doc + size, term, times, t.counts, key.fill_null(2**63 - 1).to_numpy(), null))
                size, filled = size + z - a, filled + len(doc)
                if filled >= POSTINGS:
                    search()
        if filled:
            search()
        q = np.repeat(np.arange(len(top)), [len(s) for s, _, _ in top])
        if len(q):
            scores, keys, null = (np.concatenate(x) for x in zip(*top, strict=True))
            ids = pa.array(queries.ids, id_type).take(pa.array(q))
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), ids, pa.array(keys, pa.int64(), mask=null), pa.array(scores, pa.int64())], names=["__query", "__item", "__key", "score"])

    return slim.mapInArrow(run, schema)


def rank_documents(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", k: int = 20) -> DataFrame:
    """For each row of queries its k documents of the highest score above 0: item, rank (from 1), key, score.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), a document's score the sum over the query's terms, repeats included, of
    weight * (10^9 tf div (1000 tf + 12 m)) with m = 75 + 25 n N div L, in whole numbers. Equal scores rank by ascending key, null
    last. The key is a whole number; others raise ValueError. Null and empty texts have no terms: as documents they are not found
    and not counted, as queries they find nothing, nor do empty tables. Texts are read whole. Repeated rows, and rows with one key, are documents (or
    queries) of their own. Other columns are not returned and may have any name.
    """
    ship(docs.sparkSession)
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{key} has to be a whole number")
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("__key"), F.col(f"`{text}`").alias("__text"))
    asked = queries.select(F.col(f"`{item}`").alias("__item"), F.col(f"`{item_text}`").alias("__text"))
    kind = asked.schema["__item"].dataType
    schema = f"__query int, __item {kind.simpleString()}, __key long, score long"
    size = asked.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    parts, found = -(-size // QUERY_BYTES), None
    for p in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("__text"), F.lit(parts)) == p).collect() if parts > 1 else asked.collect()
        block = Queries([r[0] for r in rows], [r[1] for r in rows])
        each = _found(slim, block, _counted(slim, block), k, schema, to_arrow_type(kind)).withColumn("__block", F.lit(p))
        found = each if found is None else found.unionByName(each)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema).withColumn("__block", F.lit(0))
    order = [F.col("score").desc(), F.col("__key").asc_nulls_last()]
    found = found.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for more in (["__salt"], []):  # the best of some tasks each, then of all
        found = found.withColumn("__rank", F.row_number().over(Window.partitionBy("__block", "__query", *more).orderBy(*order))).where(F.col("__rank") <= k)
    return found.select(F.col("__item").alias(item), F.col("__rank").alias("rank"), F.col("__key").cast(docs.schema[key].dataType).alias(key), "score")
