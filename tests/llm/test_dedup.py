import random
import re
from collections import Counter

import pytest

from graphloom.llm import queries
from graphloom.llm.line_dedup import dedup_lines
from graphloom.llm.substring_dedup import dedup_substrings
from tests.oracle import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int) -> list[tuple]:
    r = random.Random(seed)
    vocab = ["a", "b", "ü", "d'e", "x" * 50, " ", "日本"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", "\n", "\t ", "  \r\n"]) for _ in range(n))
    shared = [text(n) for n in (8, 20, 40, 9)]
    rows = [(i, "".join(r.choice([text(r.randint(0, 30)), r.choice(shared)]) for _ in range(r.randint(0, 4))), "s") for i in range(60)]
    return rows + [(60, None, "s"), (61, "", None), (None, shared[2], "s"), (3, shared[2], "s"), (3, shared[2], "s"), (64, shared[1] * 30, "s")]


def expected(rows: list[tuple], w: int) -> list[tuple]:
    docs = [WORD.findall(t or "") for _, t, *_ in rows]
    seen = Counter(tuple(d[i : i + w]) for d in docs for i in range(len(d) - w + 1))
    out = []
    for (k, *_), d in zip(rows, docs):
        gone = {j for i in range(len(d) - w + 1) if seen[tuple(d[i : i + w])] > 1 for j in range(i, i + w)}
        out.append((k, len(d), len(gone), " ".join(x for j, x in enumerate(d) if j not in gone)))
    return out


@pytest.mark.parametrize("window", [5, 7])
def test_substrings_against_brute_force(spark, window):
    rows = corpus(window)
    df = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, n_words string"), window=window)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()]
    order = lambda x: (str(x[0]), x[1:])
    assert sorted(got, key=order) == sorted(expected(rows, window), key=order)
    assert all(sum(s.end - s.start for s in r.removed_spans) == r.n_removed for r in df.collect())


def test_substrings_of_nothing(spark):
    df = dedup_substrings(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == [] and df.columns == ["doc_id", "text", "n_words", "n_removed", "kept_text", "removed_spans"]


def line_expected(rows: list[tuple], run: int) -> dict:
    docs = {}
    for k, t in rows:
        lines = (t or "").split("\n")
        docs[k] = [(i, tuple(x.encode().split())) for i, x in enumerate(lines) if x.encode().split()]
    seen, out = set(), {}
    for k in sorted(docs):
        d, gone = docs[k], set()
        for i in range(len(d) - run + 1):
            window = tuple(x for _, x in d[i : i + run])
            if window in seen:
                gone |= {n for n, _ in d[i : i + run]}
            seen.add(window)
        out[k] = sorted(gone)
    return out


@pytest.mark.parametrize("run", [1, 3])
def test_lines_against_brute_force(spark, run):
    r = random.Random(run)
    rows = [(i, "\n".join(r.choice(["a", "b c", "", " ", "d", "e f", "é"]) for _ in range(r.randint(0, 25)))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, rows[0][1]), (43, rows[0][1])]
    got = {x.doc_id: x for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), run=run).collect()}
    want = line_expected(rows, run)
    assert {k: x.removed_lines for k, x in got.items()} == want
    for k, t in rows:
        assert got[k].kept_text == (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(want[k])))


def content_expected(rows: list[tuple], run: int, words: int) -> dict:
    docs = {}
    for k, t in rows:
        docs[k] = [(i, tuple(x.encode().split())) for i, x in enumerate((t or "").split("\n")) if x.encode().split()]
    seen, out = set(), {}
    for k in sorted(docs):
        d, gone = docs[k], set()
        size = lambda part: sum(len(x) for _, x in part)
        for i in range(len(d)):
            for n in range(1, min(run, len(d) - i) + 1):
                part = d[i : i + n]
                kinds = [False] if n == run or size(part) >= words else [True] if n == len(d) else []
                for whole in kinds:
                    window = whole, tuple(x for _, x in part)
                    if window in seen:
                        gone |= {j for j, _ in part}
                    seen.add(window)
        out[k] = sorted(gone)
    return out


def test_lines_by_content_against_brute_force(spark):
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice(["a", "b c", "", " ", "d", "e f g", "é h i j k"]) for _ in range(r.randint(0, 9)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "only here once\nand here"), (83, "only  here once\n\nand here"), (84, "and here")]
    got = {x.doc_id: x for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), run=4, words=6).collect()}
    want = content_expected(rows, 4, 6)
    assert {k: x.removed_lines for k, x in got.items()} == want
    assert want[83] == [0, 2] and want[84] == []


def test_long_line_and_short_copy_are_repeats(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"x\n{long}\ny"), (2, f"z\n{long}"), (3, "short text"), (4, "short text"), (5, None)]
    got = {x.doc_id: x.kept_text for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), words=50).collect()}
    assert got == {1: rows[0][1], 2: "z", 3: "short text", 4: "", 5: None}


def test_matches_are_maximal_and_tell_the_first_place(spark):
    rows = [(1, "a\nb\nc\nd\ne\nf"), (2, "x\na\nb\n\nc\nd\ne\ny"), (3, "b\nc\nd\ne\nz\nb\nc\nd\ne")]
    got = {x.doc_id: [tuple(m) for m in x.matches] for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), run=4).collect()}
    assert got == {1: [], 2: [(1, 6, 1, 0)], 3: [(0, 4, 1, 1), (5, 4, 1, 1)]}


def test_lines_with_null_keys_repeats_and_clashing_names(spark):
    text = "a\nb\nc\nd"
    rows = [(None, text, 1), (4, text, 2), (4, text, 3), (None, text, 4), (5, None, 5), (6, "long " * 100_000 + "\n" + text, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, matches int")
    got = sorted((x.doc_id is None, x.doc_id, x.n_removed_lines) for x in dedup_lines(df).collect())
    assert [n for _, _, n in got] == [0, 4, 0, 4, 4, 4] and got[2][1] == 5
    assert dedup_lines(df.limit(0)).collect() == []


def test_content_query_against_sql(spark):
    assert compare(spark, "op2_content_dedup", queries.op2_content_dedup, queries.oracle_sql()["op2_content_dedup"], "/root/testdata/sf0.001")
