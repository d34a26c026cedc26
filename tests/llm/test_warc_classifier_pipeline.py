import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm.decontaminate import plain
from graphloom.llm.mixing import mix_sources
from graphloom.llm.quality_classifier import FEATURES, class_prior, crc_held_out, fit, measures, sampled, score_quality
from graphloom.llm.warc import Bundle, frame, parsed, read_bundles, read_record, record, seek_table, write_bundles
from tests.llm.test_native import measures as measures_of
from tests.llm.test_ngram_join import expected
from tests.llm.test_passages_tokens import distance


def test_bundle_round_trip():
    b, texts = Bundle(), [b"", b"x" * 10, b"\r\n\r\nWARC/1.1\r\n\r\n", random.Random(0).randbytes(200_000)] + [bytes([i]) * 3000 for i in range(100)]
    for i, t in enumerate(texts):
        b.add(f"urn:page:{i}", record(f"urn:page:{i}", "http://a/b c", t, hashlib.sha1(t).hexdigest(), None))
    archive = b.archive()
    assert len(seek_table(archive)) > 3
    for i, e in enumerate(b.index):
        row = read_record(archive, e["frame"], e["offset"])
        assert row["record_id"] == f"urn:page:{i}" and row["payload"] == texts[i] and row["payload_bytes"] == len(texts[i])
    assert sum(len(frame(archive, s)) for s in seek_table(archive)) == sum(e["length"] for e in b.index)
    assert parsed(record("urn:page:1", None, b"abc", hashlib.sha1(b"abc").hexdigest(), "urn:page:9"), 0)[0]["payload"] is None


def test_pages_and_revisits(spark):
    long = "é" * 700
    rows = [(1, "u1", long), (2, None, long), (3, "u3", "short"), (4, "u4", "short"), (5, "u5", None), (6, "u 6\n", ""), (7, "u7", long), (None, "n", long), (8, "v", "z" * 999), (9, "v", "z" * 999), (7, "again", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    bundles = write_bundles(pages)
    out = read_bundles(bundles).collect()
    assert len(out) == len(rows)
    for x in out:
        key = x.record_id.removeprefix("urn:page:")
        want = [r for r in rows if ("urn:page" if r[0] is None else str(r[0])) == key]
        raw = (want[0][2] or "").encode()
        assert x.payload_bytes == len(raw) and x.payload_digest == hashlib.sha1(raw).hexdigest()
        if len(raw) >= 1000 and key != "7":
            assert (x.record_type, x.refers_to, x.payload) == ("revisit", "urn:page:7", None)
        else:
            assert x.record_type == "response" and bytes(x.payload) == raw
    by = {b.bundle_id: b for b in bundles.collect()}
    for x in out:
        assert read_record(bytes(by[x.bundle_id].archive), x.frame, x.offset)["record_id"] == x.record_id
    assert read_bundles(write_bundles(pages.limit(0))).collect() == []


def test_measures_do_not_depend_on_neighbours():
    texts = [None, "", "a b c d e f a b c d e f", "Line one.\nLine one.\n", "A!! B!! | c", "é" * 30, "x x x x"]
    together = measures(pa.array(texts, pa.string()))
    assert together.shape == (len(texts), len(FEATURES)) and np.isfinite(together).all()
    for i, t in enumerate(texts):
        assert np.allclose(measures(pa.array([t], pa.string()))[0], together[i])


def test_pu_fit_finds_the_boundary():
    r = np.random.default_rng(0)
    good, bad = r.normal(1.5, 1, (20000, 3)), r.normal(-1.5, 1, (5000, 3))
    w, b = fit(good[:10000], np.vstack([good[10000:], bad[:2500]]), prior=0.8)
    assert (good @ w + b > 0).mean() > 0.95 and (bad[2500:] @ w + b < 0).mean() > 0.95


def risk(w, p, u, prior):
    """Non-negative risk by its definition, with the last weight as intercept and the decay of the fit."""
    loss = lambda x, sign: np.log1p(np.exp(-sign * (x @ w[:-1] + w[-1]))).mean()
    return prior * loss(p, 1) + max(0.0, loss(u, -1) - prior * loss(p, -1))


def test_fit_against_an_independent_minimiser():
    r = np.random.default_rng(3)
    p, u = r.normal(0.7, 1, (400, 2)), np.vstack([r.normal(0.7, 1, (300, 2)), r.normal(-0.7, 1, (200, 2))])
    w, b = fit(p, u, prior=0.6)
    best, step = np.zeros(3), 1.0
    at = risk(best, p, u, 0.6)
    while step > 1e-5:  # compass search: no gradient, nothing shared with the fit
        for move in [s * step * e for e in np.eye(3) for s in (1, -1)]:
            if risk(best + move, p, u, 0.6) < at:
                best, at = best + move, risk(best + move, p, u, 0.6)
                break
        else:
            step /= 2
    assert risk(np.append(w, b), p, u, 0.6) <= at + 0.002


def test_prior_from_positives_and_unlabelled_rows():
    r = np.random.default_rng(5)
    for share in (0.3, 0.85):
        good, bad = r.normal(2, 1, (8000, 3)), r.normal(-2, 1, (4000, 3))
        u = np.vstack([good[4000 : 4000 + int(3000 * share)], bad[: 3000 - int(3000 * share)]])
        assert abs(class_prior(good[:4000], u[r.permutation(len(u))]) - share) < 0.05
    assert class_prior(good[:0], u) == 0.5


def test_sample_is_bounded_and_takes_each_key_once(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS key", *[f"1.0D AS `{n}`" for n in FEATURES])
    assert sampled(rows, 5000).shape == (2000, len(FEATURES)) and 100 < len(sampled(rows, 300)) <= 300 and sampled(rows.limit(0), 5).shape == (0, len(FEATURES))


def test_scores(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdeiou") for _ in range(r.randint(2, 8)))
    good = lambda: " ".join(word() for _ in range(r.randint(10, 60))) + "."
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(r.randint(10, 60)))
    rows = [(i, good() if i % 5 else bad()) for i in range(600)] + [(600, None), (601, ""), (None, "a b c"), (5, "a b c"), (5, "a b c")]
    rows.append((602, "long " * 200_000))
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, `held.out` int")
    labels = spark.createDataFrame([(i, int(bool(i % 5))) for i in range(0, 600, 2)] + [(None, 1), (7, None), (2, 1)], "doc_id long, quality int")
    out = score_quality(docs, labels).collect()
    assert len(out) == len(rows)
    assert all(x.held_out == crc_held_out(x.doc_id) and 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in out)
    held = [x for x in out if x.held_out and x.doc_id < 600]
    assert sum(x.predicted == bool(x.doc_id % 5) for x in held) > 0.95 * len(held)
    assert {x.score for x in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels).collect() == []


def test_pipeline_stage_by_stage(spark, tmp_path):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdeiou") for _ in range(r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n)) + "."
    items = [(i, text(20)) for i in range(4)]
    rows = []
    for i in range(160):
        t = text(r.randint(12, 80))
        if i % 10 == 1:
            t = rows[-1][1] if r.random() < 0.5 else rows[-1][1] + " " + word()
        if i % 10 == 5:
            t = t + " " + items[i % 4][1] + " " + t[:30]
        if i % 10 == 7:
            t = " ".join(w + "!!" for w in t.upper().split())
        rows.append((i, t, "en", r.choice(["s1", "s2", None]), len(t)))
    rows += [(160, None, "en", "s1", None), (161, "", None, "s1", 0), rows[3], (None, text(30), "en", "s1", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    plain_rows = lambda df: Counter(tuple(x) for x in df.collect())
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, out = plain_rows(docs), stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        out = spark.read.parquet(str(tmp_path / f"out{k}"))
        if name != "sharding":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = plain_rows(out)
        if name == "quality_rules":
            assert after <= before and not any("!!" in x[1] for x in after)
            base = lambda m: m[0] >= 10 and 100 * m[4] <= 20 * m[0]
            assert after == Counter({x: n for x, n in before.items() if base(measures_of(x[1])) and "!!" not in x[1]})
        if name == "ngram_join":
            flat = [(x[0], x[1]) for x in before]
            comp = {(k, t): c for (k, t), (_, _, c) in zip(flat, expected(flat))}
            assert set(after) == {x for x in before if comp[x[0], x[1]] in (x[0], None)} and set(after.values()) == {1}
        if name == "decontaminate":
            held = lambda t: any(distance(plain(p), plain(t)) <= len(plain(p)) // 10 for _, p in items)
            assert set(after) == {x for x in before if not held(x[1])} and len(after) < len(before)
        if name == "source_mix":
            copies = {x.doc_id: x.copies for x in mix_sources(docs).select("doc_id", "copies").collect()}
            assert after == Counter({x: copies[x[0]] for x in before if copies[x[0]]})
        if name == "sharding":
            assert Counter(tuple(x)[:5] for x in out.select("doc_id", "text", "lang", "source", "n_chars").collect()) == before
            for s in out.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect():
                assert s.s == list(range(len(s.s)))
        docs = out
    assert Counter(x.doc_id for x in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(x.doc_id for x in docs.collect())
