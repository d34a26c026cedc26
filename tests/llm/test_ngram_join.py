import random

from graphloom.llm.components import components
from graphloom.llm.ngram_join import keep_one, link_documents


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[top(i)] = min(low.get(top(i), k), k)
    return [(k, len(s), low.get(top(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcd") for _ in range(4))
    base = [[word() for _ in range(r.randint(1, 90))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 1, 2, 4, 6])):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            w += r.choice(base)[: r.randint(0, 15)]
        rows.append((i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (None, rows[0][1]), (5, rows[9][1]), (n + 3, "One two"), (n + 4, "one TWO"), (None, "zz yy xx ww vv uu tt")]


def check(spark, rows):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_links_against_brute_force(spark):
    check(spark, corpus(1, 220))


def test_links_with_small_groups(spark, monkeypatch):
    monkeypatch.setattr("graphloom.llm.ngram_join.GROUP_TOKENS", 300)
    check(spark, corpus(2, 200))


def test_no_rows(spark):
    assert link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_one(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (1, "a b c d e f g", "x"), (None, "A b c d e f g", "x"), (3, None, "x"), (4, "", "x"), (5, "other words", "x"), (None, "null key only", "z")]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[4], rows[5], rows[6], rows[7]], key=str)


def test_keep_one_of_rows_alike_in_key_and_text(spark):
    rows = [(1, "a b c d e f", "y", 2), (1, "a b c d e f", "x", 1), (1, "a b c d e f", "x", 1), (1, "u v w x y z", "k", 3), (None, "n m o p q r", "s", 1), (None, "N m o p q r", "t", 1), (2, " ", "x", 1), (2, " ", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `sour.ce` string, same int")
    got = [sorted(map(tuple, keep_one(df.repartition(n)).collect()), key=str) for n in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == 5 and sum(x[0] == 1 for x in got[0]) == 2 and sum(x[0] is None for x in got[0]) == 1


def test_components_of_a_long_path(spark):
    r = random.Random(3)
    names = list(range(40))
    r.shuffle(names)
    df = spark.createDataFrame(list(zip(names, names[1:])) + [(100, 101), (7, 7)], "a long, b long")
    assert {(x.node, x.label) for x in components(df).collect()} == {(n, 0) for n in names} | {(100, 100), (101, 100)}
