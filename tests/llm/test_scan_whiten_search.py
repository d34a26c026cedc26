import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import queries
from graphloom.llm.license_rules import BASE, rules
from graphloom.llm.license_scan import CERTAINTY, scan_licenses
from graphloom.llm.ranked_search import Segment, rank_documents
from graphloom.llm.whitening import Spectrum, updated, whiten

# License scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scan(text, table):
    """The same rules by single characters and all pairs, without keywords."""
    words = WORD.findall((text or "").translate(LOWER))
    line = " " + "".join(w + " " for w in words)
    found = []
    for n, (level, label, _, pattern) in enumerate(table):
        for m in re.finditer(rf"(?<= )(?:{pattern})(?= )", line, re.ASCII):
            start = line[: m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" ") + 1, level, n, label))
    kept = [x for x in found if x[2] == 0 or not any(y is not x and y[0] <= x[0] and y[1] >= x[1] and y[2] <= x[2] and (y[0], -y[1], y[2], y[3]) < (x[0], -x[1], x[2], x[3]) for y in found)]
    base = [x for x in found if x[2] == 0]
    labels = sorted({x[4] for x in kept})
    doubt = math.prod(1 - CERTAINTY[min(x[2] for x in kept if x[4] == label)] for label in labels)
    return len(words), len(base), min((x[0] for x in base), default=None), max((x[0] for x in base), default=None), ",".join(sorted({x[4] for x in base})), ",".join(labels), 1 - doubt, sorted(x[:3] + (x[4],) for x in kept)


def sample(pattern, r):
    """A text that a pattern of these rules matches: alternatives, options and counts by chance."""

    def one(node):
        kind, arg = node
        name = str(kind)
        if name == "LITERAL":
            return chr(arg)
        if name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            return "".join("".join(map(one, inner)) for _ in range(r.randint(low, min(high, low + 2))))
        if name == "SUBPATTERN":
            return "".join(map(one, arg[3]))
        if name == "BRANCH":
            return "".join(map(one, r.choice(arg[1])))
        if name == "IN":
            k, v = arg[0]
            if str(k) == "LITERAL":
                return chr(v)
            return r.choice("0123456789") if "DIGIT" in str(v) and "NOT" not in str(v) else chr(v[0]) if str(k) == "RANGE" else "w"
        raise AssertionError(node)

    return "".join(map(one, re._parser.parse(pattern)))


def test_keywords_stand_in_what_rules_match():
    r = random.Random(1)
    table = rules()
    assert len(table) > 250 and {label for _, label, _, _ in table[: len(BASE)]} == set(BASE.values())
    for _, label, keyword, pattern in table:
        for _ in range(12):
            text = sample(pattern, r)
            assert re.fullmatch(pattern, text), (label, text)
            assert set(keyword.split("|")) & set(text.split(" ")), (label, keyword, text)


def test_license_scan(spark):
    r = random.Random(2)
    table = rules()
    texts = [None, "", " .,;", "CC BY", "cc by cc by cc-by", "GENERAL\nPUBLIC\tLICENSE", "all rights all rights reserved", "mit und Lizenz", "x " * 30 + "cc by " * 700, "All Rights Reserved. ÀLL RIGHTS RESERVED", "©2020 © 2021", "K cc by"]
    texts += [" filler ".join(r.choice(["", "X-", "(", "über "]) + r.choice([str.upper, str])(sample(r.choice(table)[3], r)).replace(" ", r.choice([" ", ", ", "-", "\n"])) for _ in range(r.randint(1, 5))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "cc by", 1)] * 2, "doc_id long, text string, score int").withColumnRenamed("doc_id", "a.b")
    out = scan_licenses(df)
    assert out.columns[:2] == ["a.b", "text"] and out.columns.count("score") == 1
    rows = out.collect()
    assert len(rows) == len(texts) + 2
    for x in rows:
        want = scan(x.text, table)
        got = (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels)
        assert got == want[:6], (x.text, got, want)
        assert abs(x.score - want[6]) < 1e-12 and 0 <= x.score <= 1
        assert sorted((d.start, d.end, d.level, d.label) for d in x.detections) == want[7], x.text
    assert scan_licenses(df.limit(0)).collect() == []


# Whitening


@pytest.mark.parametrize("dims", [1, 2, 7, 40])
def test_rank_one_updates(dims):
    r = np.random.default_rng(dims)
    for trial in range(6):
        s = Spectrum(dims)
        rows = np.floor(r.normal(size=(60, dims)) * 9)
        rows[10:20] = rows[10]  # repeats
        if trial % 2:
            rows[:, : dims // 2] = 0  # no variance there, many equal eigenvalues
        if trial == 5:
            rows *= np.logspace(0, 6, dims)
        for x in rows:
            s.add(x)
        other = Spectrum(dims)
        for x in rows[::-1] + 3:
            other.add(x)
        both = np.concatenate([rows, rows + 3])
        s.merge(other)
        scatter = (both - both.mean(0)).T @ (both - both.mean(0))
        size = max(np.abs(scatter).max(), 1e-9)
        assert np.abs((s.vectors * s.values) @ s.vectors.T - scatter).max() < 1e-11 * size
        assert np.abs(s.vectors.T @ s.vectors - np.eye(dims)).max() < 1e-12
    values, vectors = updated(np.array([1.0, 1.0, 1.0]), np.eye(3), np.array([0.0, 2.0, 0.0]), 1.0)
    assert np.allclose(values, [1, 1, 5])


def test_whitening(spark):
    r = np.random.default_rng(3)
    good = [(i, [float(np.float32(v)) for v in r.normal(size=6) * [1, 2, 3, 1, 1, 1] + [0, 0, 0, 1, 0, 0]]) for i in range(300)] + [(7, [1.0] * 6)] * 5 + [(None, [0.0] * 6)]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (905, [1.0, 2.0]), (906, [1e30] * 6)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumns({"x.y": F.lit(1), "N": F.lit(2)}).repartition(37)
    out, w = whiten(df, components=4)
    assert out.columns == ["vec_id", "embedding", "x.y", "n", "deviation", "whitened"]
    rows = out.collect()
    assert Counter(x.vec_id for x in rows) == Counter(i for i, _ in good)
    x = np.floor(64 * np.array([v for _, v in good])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    v = np.cov((n * x - s).T / n, bias=True)
    values, vectors = np.linalg.eigh(v)
    assert np.allclose(w.values, values[::-1][:4], rtol=1e-12) and np.allclose(w.explained, values[::-1][:4] / np.trace(v), rtol=1e-12)
    assert np.allclose(np.abs((w.vectors * vectors[:, ::-1][:, :4]).sum(0)), 1, atol=1e-12) and w.identity_error < 1e-12
    for q in rows:
        own = np.floor(64 * np.array(q.embedding)).astype(np.int64) + 1_000_000
        assert q.n == n and q.deviation == int(((n * own - s) ** 2).sum())
        assert np.allclose(q.whitened, (own - s / n) @ w.vectors / np.sqrt(w.values), atol=1e-6)


def test_whitening_of_little(spark):
    empty, none = whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert none is None and empty.collect() == [] and empty.columns[-1] == "whitened"
    out, w = whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>"))
    assert [(x.n, x.deviation, x.whitened) for x in out.collect()] == [(3, 0, [])] * 3 and w.identity_error == 0


def test_whitening_query(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=40)], i % 3) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    out = queries.op12_embedding_whitening(spark, str(tmp_path)).collect()
    assert len(out) == 120 * 32 and {x.component for x in out} == set(range(1, 33)) and len({x.identity_error for x in out}) == 1
    y = np.zeros((120, 32))
    for x in out:
        y[x.vec_id, x.component - 1] = x.whitened
    assert np.abs(y.T @ y / 120 - np.eye(32)).max() < 1e-10 and np.abs(y.mean(0)).max() < 1e-10


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for d in terms for t in set(d))
    out = []
    for item, text in items:
        scores = []
        for (key, _), d in zip(docs, terms):
            tf, score = Counter(d), 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * len(d) * n_docs) // n_terms
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def test_ranked_search(spark, monkeypatch):
    r = random.Random(4)
    vocabulary = [f"w{int(r.expovariate(0.05))}" for _ in range(400)] + ["ÀB", "Àb", "K", "ſ", "a_b", "x@y"]
    text = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    copies = text(30)
    docs = [(i, r.choice([str.upper, str])(text(r.randint(0, 60)))) for i in range(400)] + [(1000 + i, copies) for i in range(120)] + [(5, "w1 w2"), (5, "w1 w2"), (None, copies), (2000, None), (2001, ""), (2002, ". ,"), (2003, text(200000))]
    items = [(i, text(r.randint(1, 25))) for i in range(20)] + [(90, copies), (91, None), (92, ""), (93, "unknown"), (94, "w1 w1 w1"), (None, "w2 w3")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"a.b": F.lit(1), "score": F.lit(2)}).repartition(7)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for k in (1, 20):
        out = rank_documents(d, q, k=k)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, out.collect())) == ranked(docs, items, k)
    assert rank_documents(d.limit(0), q).collect() == [] and rank_documents(d, q.limit(0)).collect() == []
    with pytest.raises(ValueError):
        rank_documents(d.withColumn("doc_id", F.col("doc_id").cast("string")), q)
    monkeypatch.setattr("graphloom.llm.ranked_search.QUERY_BYTES", 600)  # several blocks of queries
    assert Counter(map(tuple, rank_documents(d, q, k=3).collect())) == ranked(docs, items, 3)


def test_best_positions_stop_early():
    """The k best are exact, from lists that are not read to their ends."""
    r = np.random.default_rng(6)
    size, terms = 20_000, 3
    doc, term = np.tile(np.arange(size), terms), np.repeat(np.arange(terms), size)
    impact = np.floor(r.pareto(0.7, size * terms) * 1000).astype(np.int64)
    s = Segment(size, doc, term, impact, terms)
    read = []
    places = s.places
    s.places = lambda t, docs: read.append(len(docs)) or places(t, docs)
    keys = r.permutation(size)
    docs, scores = s.best(np.arange(terms), np.array([1, 2, 1]), keys, 10, -1)
    total = impact[:size] + 2 * impact[size : 2 * size] + impact[2 * size :]
    want = np.lexsort((keys, -total))[:10]
    assert docs.tolist() == want.tolist() and scores.tolist() == total[want].tolist()
    assert sum(read) < size * terms / 4
