"""A quality classifier from trusted positives and unlabelled text (non-negative PU learning).

The model is linear over measures of a text. Its risk is prior * (loss of positives as positive) +
max(0, loss of unlabelled as negative - prior * loss of positives as negative): the second part estimates the
risk on negatives without having any, and cannot fall below zero. The class prior is estimated from positives and
unlabelled rows alone: no part of the text space can hold a larger share of the positives than the prior lets it hold of
all rows, so the least ratio of the two shares over the top scores of a first model, taken on rows it did not see, is the
prior. Measures of all texts are taken on Spark and written; the fit sees a bounded sample of them; all texts are
scored by Spark expressions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm._shared import table
from graphloom.llm._text import Words, span_hashes
from graphloom.session import ship

SAMPLE = 20_000
SHARES = {
    "symbols": b"#*$%&|<>@^~=_+{}[]\\", "pipes": b"|", "bangs": b"!", "digits": b"0123456789", "stops": b".?!", "commas": b",;:",
    "upper": bytes(range(65, 91)), "quotes": b"\"'()", "breaks": b"\n",
}
RATES = [*SHARES, "word_length", "long_words", "distinct", "next_equal", "repeats", "dup_lines", "vowels"]
FEATURES = [f"{n}_{k}" for n in RATES for k in ("raw", "some", "much")] + ["length", "tiny", "short"]


def measures(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row of FEATURES for each text. Empty and null texts have zeros, but for `tiny` and `short`."""
    w = Words(texts)
    n = np.maximum(w.counts, 1)
    size = np.maximum(np.diff(w.offsets) - 1, 1)
    doc_of = lambda at: np.searchsorted(w.offsets, at, "right") - 1
    per = lambda mask, by: np.bincount(doc_of(np.flatnonzero(mask)), minlength=len(n)) / by
    rates = {}
    for name, characters in SHARES.items():
        hit = np.zeros(256, bool)
        hit[list(characters)] = True
        rates[name] = per(hit[w.buf], n if name in ("symbols", "pipes", "bangs", "stops", "commas") else size)
    vowel = np.zeros(256, bool)
    vowel[list(b"aeiouyAEIOUY")] = True
    rates["vowels"] = per(vowel[w.buf], size)
    length = w.ends - w.starts
    rates["word_length"] = np.bincount(w.doc, length, len(n)) / n
    rates["long_words"] = np.bincount(w.doc, length > 18, len(n)) / n
    same = np.zeros(len(w.doc), bool)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    rates["next_equal"] = np.bincount(w.doc, same, len(n)) / n
    rates["distinct"] = np.bincount(np.unique(np.stack([w.doc.astype(np.uint64), w.hashes]), axis=1)[0].astype(np.int64) if len(w.doc) else w.doc, minlength=len(n)) / np.sqrt(n)
    at = w.windows(5)
    h = span_hashes(w.hashes, at, at + 5)
    order = np.lexsort((h, w.doc[at]))
    again = np.zeros(len(at), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (w.doc[at[order]][1:] == w.doc[at[order]][:-1])
    rates["repeats"] = np.bincount(w.doc[at[order]], again, len(n)) / n
    breaks = np.flatnonzero(w.buf == 10)
    line = np.searchsorted(breaks, w.starts) + w.doc
    new = np.flatnonzero(np.diff(line, prepend=-1))
    hl, dl = span_hashes(w.hashes, new, np.append(new[1:], len(line))) if len(new) else np.zeros(0, np.uint64), w.doc[new]
    order = np.lexsort((hl, dl))
    twice = np.zeros(len(hl), bool)
    twice[1:] = (hl[order][1:] == hl[order][:-1]) & (dl[order][1:] == dl[order][:-1])
    rates["dup_lines"] = np.bincount(dl[order], twice, len(n)) / np.maximum(np.bincount(dl, minlength=len(n)), 1)
    out = []
    for name in RATES:
        x = np.asarray(rates[name], float)
        x = np.where(w.counts > 0, x, 0.0)
        out += [np.minimum(x, 20), np.tanh(4 * x), np.tanh(x / 0.02)]
    return np.stack([*out, np.log1p(w.counts), w.counts < 5, w.counts < 20], axis=1).astype(float)


def held_out(key: Column) -> Column:
    """True for rows that nothing may be learnt from: CRC-32 of the key as text leaves 2 by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, intercept) over raw measures, by Adam on the non-negative risk with logistic loss. Starts at zero: reruns agree."""
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-6
    p, u = (np.hstack([(x - mean) / scale, np.ones((len(x), 1))]) for x in (positive, unlabelled))
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 0.5 * (1 + np.tanh(z / 2))
    for k in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        rest = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        g = prior * (p.T @ (sp - 1)) / len(p) + rest if negative >= 0 else -rest
        g = g + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * 0.998**k * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w[:-1] / scale, float(w[-1] - (w[:-1] / scale) @ mean)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled rows: the least, over thresholds, of the share of unlabelled rows above by that of positives.

    Each half of the rows is scored by a model fit on the other. The threshold is chosen with a margin for chance (delta), so
    that few rows decide nothing; it lies between 1 % and 99 %.
    """
    found = []
    for i in (0, 1):
        p, u, p2, u2 = positive[i::2], unlabelled[i::2], positive[1 - i :: 2], unlabelled[1 - i :: 2]
        if min(len(p), len(u), len(p2), len(u2)) == 0:
            continue
        w, b = fit(p, u, 0.5)
        sp, su = np.sort(p2 @ w + b), np.sort(u2 @ w + b)
        at = np.unique(sp)
        above_p, above_u = 1 - np.searchsorted(sp, at) / len(sp), 1 - np.searchsorted(su, at) / len(su)
        margin = np.sqrt(np.log(4 / delta) / 2 / len(su)) + np.sqrt(np.log(4 / delta) / 2 / len(sp))
        k = int(np.argmin((above_u + margin) / above_p))
        found.append(above_u[k] / above_p[k])
    return float(min(max(np.mean(found), 0.01), 0.99)) if found else 0.5


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                rows = measures(part["text"])
                yield pa.RecordBatch.from_arrays([part["key"], *[pa.array(rows[:, i]) for i in range(rows.shape[1])]], names=["key", *FEATURES])

    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in FEATURES))


def sampled(rows: DataFrame, most: int) -> np.ndarray:
    """FEATURES of about `most` distinct keys of rows at the most: those whose hash lies below a threshold that a count sets, the least first.

    The filter runs where the rows are; only what it leaves, one row a key, goes to the driver.
    """
    n = rows.count()
    if n > most:
        rows = rows.where(F.xxhash64("key").cast("double") < F.lit(-(2.0**63) + 2.0**64 * most / n))
    few = rows.dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").limit(most)
    return np.array(few.select(*FEATURES).toPandas(), float).reshape(-1, len(FEATURES))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, threshold: float = 0.7) -> DataFrame:
    """One row per row of docs: key, held_out, score (0 to 1) and predicted (1 at the threshold or above).

    Learns from rows that are not held out: at most `sample` positives and `sample` unlabelled ones, the first by
    a hash of the key, each key once. A key with several labels counts as positive if any is; other labels are not used.
    Labels, keys and other columns are never inputs of a score: equal texts score alike, empty and null ones too. Texts are
    read whole, of any length. Without positives or text to learn from all scores are 0.5. Other columns of docs are not
    returned and may have any name.
    """
    rows = table(measured(docs, key, text).withColumn("held_out", held_out(F.col("key"))))
    good = labels.where(F.col(f"`{label}`").cast("int") == 1).select(F.col(f"`{key}`").alias("key")).where("key IS NOT NULL").distinct()
    open_rows = rows.where("NOT held_out AND key IS NOT NULL")
    positive, unlabelled = sampled(open_rows.join(good, "key", "left_semi"), sample), sampled(open_rows, sample)
    learn = len(positive) and len(unlabelled)
    weights, bias = fit(positive, unlabelled, class_prior(positive, unlabelled)) if learn else (np.zeros(len(FEATURES)), 0.0)
    z = F.lit(bias)
    for n, w in zip(FEATURES, weights.tolist(), strict=True):
        z = z + F.col(n) * F.lit(w)
    out = rows.select(F.col("key").alias(key), "held_out", (1 / (1 + F.exp(-z))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def crc_held_out(key: object) -> bool:
    """held_out() for one key, for tests."""
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2
