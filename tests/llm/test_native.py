import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm.decontaminate import find_passages, without_passages
from graphloom.llm.line_dedup import dedup_lines
from graphloom.llm.mixing import draw, mix_sources, mixed
from graphloom.llm.ngram_join import keep_one
from graphloom.llm.quality_rules import BASE, fit, keep_good, measured, quality_rules, rules
from graphloom.llm.sharding import shard_documents
from graphloom.llm.substring_dedup import dedup_substrings
from graphloom.llm.token_counts import count_tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "one", "a b c d e a b c d e", "x " * 40, "# a\n# a\n\n\n b|c", "é ü d\x0be\ff\rg", "Line one.\nLine one.\nLine one.\n", " lead and trail ", "日本 語" * 3]


def measures(t):
    t = t or ""
    w = WORD.findall(t)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len({j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 5)}))


def test_quality_measures(spark):
    r = random.Random(0)
    texts = TEXTS + ["".join(r.choice(["a", "b", "#c", "É"]) + r.choice(" \n\t") for _ in range(r.randint(0, 80))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(None, "x", 9), (3, "one", 9), (3, "one", 9)], "doc_id long, text string, n_words int")
    out = quality_rules(df)
    assert out.columns[:2] == ["doc_id", "text"] and out.count() == len(texts) + 3
    for x in out.collect():
        want = measures(x.text)
        assert tuple(x[c] for c in BASE) == want, x.text
        assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert 0 <= x.posterior <= 1 and not (x.base_failed and x.kept)


def test_quality_of_nothing(spark):
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def em(rows, rounds=400):
    """Two classes of documents, three kinds of votes: expectation-maximisation over single documents, by lists."""
    docs = [k for k, n in rows.items() for _ in range(n)]
    p = [0.05 if -1 in d else 0.95 for d in docs]
    for _ in range(rounds):
        good = sum(p)
        prior = (good + 1) / (len(docs) + 2)
        share = []
        for j in range(len(docs[0])):
            bad_on_good, all_on_good = sum(q for q, d in zip(p, docs) if d[j] == -1), sum(q for q, d in zip(p, docs) if d[j])
            bad_on_bad, all_on_bad = sum(1 - q for q, d in zip(p, docs) if d[j] == -1), sum(1 - q for q, d in zip(p, docs) if d[j])
            share.append(((bad_on_good + 1) / (all_on_good + 100), (bad_on_bad + 1) / (all_on_bad + 2)))
        of = {}
        for d in set(docs):
            a, b = prior, 1 - prior
            for v, (g, w) in zip(d, share):
                a, b = a * (g if v == -1 else 1 - g if v == 1 else 1), b * (w if v == -1 else 1 - w if v == 1 else 1)
            of[d] = a / (a + b)
        new = [of[d] for d in docs]
        if max(abs(x - y) for x, y in zip(p, new)) < 1e-9:
            break
        p = new
    return prior, share, of


def drawn(seed, n=1500):
    """Votes of four rules of very different worth, one of them no better than chance."""
    r, rows = random.Random(seed), Counter()
    for _ in range(n):
        good = r.random() < 0.8
        rows[tuple(0 if r.random() < 0.2 else (-1 if r.random() < (g if good else b) else 1) for g, b in ((0.02, 0.9), (0.05, 0.7), (0.01, 0.5), (0.1, 0.1)))] += 1
    return rows


def test_em_against_an_independent_one(spark):
    rows = drawn(1)
    df = spark.createDataFrame([(*k, n) for k, n in rows.items()], "__vote_a int, __vote_b int, __vote_c int, __vote_d int, n long")
    model = fit(df, list("abcd"), rounds=60)
    prior, share, _ = em(rows)
    assert abs(model["prior"] - prior) < 0.01
    for n, (g, b) in zip("abcd", share):
        assert abs(model["votes"][n][0] - g) < 0.01 and abs(model["votes"][n][1] - b) < 0.02
    assert abs(model["votes"]["a"][1] - 0.9) < 0.1 and abs(model["votes"]["d"][1] - model["votes"]["d"][0]) < 0.1  # nothing holds a useless rule up


def test_posterior_and_verdict_against_an_independent_em(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdeiou") for _ in range(r.randint(2, 8)))
    clean = lambda: " ".join(word() for _ in range(r.randint(30, 60))) + "."
    spoiled = [lambda t: t.replace(" ", " ## "), lambda t: t.upper(), lambda t: t.replace(" ", "! "), lambda t: t[:-1], lambda t: t.upper().replace(" ", "!! ")]
    texts = [clean() if i % 4 else r.choice(spoiled)(clean()) for i in range(400)] + TEXTS
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    votes = measured(df, "text").select("doc_id", *BASE, *[v.cast("int").alias(n) for n, v in rules().items()]).collect()
    failed = {x.doc_id: x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words for x in votes}
    rows = Counter(tuple(x[n] for n in rules()) for x in votes if not failed[x.doc_id])
    _, _, of = em(rows)
    out = {x.doc_id: x for x in quality_rules(df).collect()}
    for x in votes:
        got, d = out[x.doc_id], tuple(x[n] for n in rules())
        assert got.base_failed == failed[x.doc_id]
        if not got.base_failed:
            assert abs(got.posterior - of[d]) < 0.02 and (got.kept == (of[d] >= 0.5) or abs(of[d] - 0.5) < 0.02)
        assert not (got.base_failed and got.kept)


def clashing(spark):
    """Columns that operators might use themselves, one with a dot, nulls in all."""
    names = ["doc_id", "text", "source", "size", "rate", "copies", "taken", "n_words", "posterior", "same", "__part", "__key", "__md5", "class", "a.b", "c0"]
    long = "x" * 300_000 + " " + " ".join(f"w{i}" for i in range(20_000)) + "."
    texts = ["one two three four five six seven eight nine ten eleven twelve.", long, None, "", "one two three four five six seven eight nine ten eleven twelve.", "One lone sentence of more than ten words stands in this short text here."]
    rows = [(i, t, "s1" if i % 2 else None, *[777 + i if i % 3 else None for _ in names[3:]]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string' if n in ('text', 'source') else 'int'}" for n in names))


def test_stages_give_back_any_columns_as_they_were(spark):
    df = clashing(spark)
    rows = {x.doc_id: tuple(x) for x in df.collect()}
    for stage, kept in ((keep_good, {0, 1, 4, 5}), (keep_one, {0, 1, 2, 3, 5})):
        out = stage(df)
        assert out.columns == df.columns and {x.doc_id: tuple(x) for x in out.collect()} == {k: rows[k] for k in kept}
        assert stage(df.limit(0)).collect() == []
    out = mixed(df)
    assert out.columns == df.columns and all(tuple(x) == rows[x.doc_id] for x in out.collect())
    out = shard_documents(df)
    mine = [c for c in df.columns if c != "size"]
    assert out.columns[: len(mine)] == mine
    for x in out.collect():
        assert tuple(x)[: len(mine)] == tuple(v for v, c in zip(rows[x[0]], df.columns) if c != "size")
    whole = quality_rules(df)
    assert whole.columns[:3] == ["doc_id", "text", "source"] and {x["a.b"] for x in whole.collect()} == {x["a.b"] for x in df.collect()}
    assert mix_sources(df).where("`a.b` = 778").count() == 1


def test_mix_targets_and_copies(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 9), r.choice(["s1", "s2", "s3", None, "hot", "hot", "hot"]), 0) for i in range(3000)] + [(3000, None, "empty", 0), (None, "a b", "s1", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = mix_sources(df).collect()
    by = {}
    for x in out:
        by.setdefault(x.source, []).append(x)
        assert x.taken in (x.size * math.floor(x.rate), x.size * (math.floor(x.rate) + 1)) and x.taken <= 2 * x.size
    names = sorted((s for s in by if s), key=str) + [None]
    size = {s: sum(x.size for x in by[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while True:  # share, stop those above their limit, share the excess again
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
            free.discard(s)
    for s in names:
        assert abs(by[s][0].target - target[s]) < 1e-6
        assert abs(sum(x.taken for x in by[s]) - target[s]) <= 6 * 9 * math.sqrt(len(by[s])) + 1e-6
    assert mixed(df).count() == sum(x.copies for x in out) and mixed(df).columns == df.columns
    assert mix_sources(df.limit(0)).collect() == []


def test_draws_are_uniform(spark):
    u = [x[0] for x in spark.range(4000).select(draw(F.col("id"))).collect()]
    assert abs(sum(u) / len(u) - 0.5) < 0.02 and 0 <= min(u) and max(u) < 1


def spark_hash(*values):
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64((v & (2**64 - 1)).to_bytes(8, "little") if isinstance(v, int) else v, seed=h).intdigest()
    return h


def place(key, shards):
    """The tree again, child by child. ints of the tree hash as 4 bytes."""
    four = lambda v: v.to_bytes(4, "little")
    def pick(at, weights):
        best = []
        for c, w in enumerate(weights):
            u = ((spark_hash(*map(four, at), four(c), key) >> 11) + 0.5) / 2.0**53
            best.append((-math.log(u) / w, c))
        return min(best)[1]
    layout = [[2, 2, 2]] * (shards // 6) + [[1]] * (shards % 6)
    a = pick([1], [sum(r) for r in layout])
    b = pick([2, a], layout[a])
    c = pick([3, a, b], [1] * layout[a][b])
    return sum(sum(r) for r in layout[:a]) + b * 2 + c


def test_shards(spark):
    rows = [(i, f"text {i % 50}", 1) for i in range(4000)] + [(None, None, 1), (5, "text 5", 1), (5, "text 5", 1)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string, slot int")).collect()
    assert len(out) == len(rows) and {x.law for x in out} == {"key"}
    per = Counter(x.shard for x in out)
    assert set(per) == set(range(24)) and max(per.values()) < 1.4 * len(rows) / 24
    for s in per:
        assert sorted(x.slot for x in out if x.shard == s) == list(range(per[s]))
    moved = [x for x in out if x.grown_shard != x.shard]
    assert all(x.grown_shard == 24 for x in moved) and abs(len(moved) - len(rows) / 25) < 5 * math.sqrt(len(rows) / 25)
    for x in out:
        raw = (x.text or "").encode()
        assert x.size == len(raw) + 8 and x.text_crc32 == (None if x.text is None else zlib.crc32(raw))
    for x in out[:300]:
        assert x.shard == place(x.doc_id, 24) and x.grown_shard == place(x.doc_id, 25)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text")
    for n in (5, 7, 12, 23, 25, 26):
        out = shard_documents(df, shards=n).collect()
        assert all(0 <= x.shard < n and x.grown_shard in (x.shard, n) for x in out) and any(x.grown_shard == n for x in out)
        grown = {x.doc_id: x.shard for x in shard_documents(df, shards=n + 1, opened=n // 6 * 6).collect()}
        assert all(grown[x.doc_id] == x.grown_shard for x in out)
    assert shard_documents(df.limit(0)).collect() == []


def test_slots_hang_on_rows_alone(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'x' AS text")
    got = []
    for parts in ("4", "37"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got.append({x.doc_id: (x.shard, x.slot) for x in shard_documents(df).collect()})
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_other_operators_give_back_any_columns_as_they_were(spark):
    """Columns with dots, of the names that an operator adds or uses itself, and nulls in all; a very long text; repeated rows."""
    df = clashing(spark).withColumns({"__chunk": F.lit(5), "__bucket": F.lit(None).cast("int"), "x.y": F.lit("k"), "Kept_Text": F.lit(1), "edits": F.lit(2)})
    df = df.union(df.where("doc_id = 4"))
    rows = sorted(map(repr, df.collect()))
    item = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, `t.x` string").withColumn("text", F.lit("zz"))
    for run in (dedup_lines, lambda d: dedup_lines(d, words=50), dedup_substrings, count_tokens):
        out = run(df)
        added = [c for c in out.columns if c not in df.columns]
        mine = [c for c in df.columns if c.lower() not in {a.lower() for a in out.columns[-6:]} or c in out.columns]
        names = [c for c in df.columns if c in out.columns and c not in ("n_words",)]
        assert added and {"__chunk", "x.y", "a.b"} <= set(mine)
        assert sorted(map(repr, out.select(*[F.col(f"`{c}`") for c in names]).collect())) == sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in names]).collect()))
        assert run(df.limit(0)).collect() == []
    out = without_passages(df, item, item_text="t.x")
    assert out.columns == df.columns and sorted(map(repr, out.collect())) == sorted(x for x, y in zip(map(repr, df.collect()), df.collect()) if y.doc_id not in (0, 4)) and len(rows) == 7
    assert without_passages(df.limit(0), item, item_text="t.x").collect() == [] and without_passages(df, item.limit(0), item_text="t.x").count() == 7
    found = find_passages(df.withColumnRenamed("doc_id", "d.k"), item.withColumnRenamed("item_id", "i.k"), key="d.k", item="i.k", item_text="t.x")
    assert found.columns[:2] == ["d.k", "i.k"] and sorted(x[0] for x in found.collect()) == [0, 4, 4]


def test_string_keys_of_lines_are_refused(spark):
    with pytest.raises(ValueError):
        dedup_lines(spark.createDataFrame([("k0", "a")], "doc_id string, text string"))


def test_pipeline_over_nothing_and_over_dotted_names(spark, tmp_path):
    df = clashing(spark).withColumn("x.y", F.lit(1))
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, d in (("all", df), ("none", df.limit(0))):
        for _, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, str(tmp_path))
        assert d.count() == (0 if name == "none" else d.count()) and "x.y" in d.columns
