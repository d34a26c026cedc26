import random

import numpy as np
import pytest

from graphloom.llm.decontaminate import codes, edits, find_passages, plain, qgrams, without_passages
from graphloom.llm.token_counts import Automaton, count_tokens


def distance(p, t):
    """Fewest edits of p against any part of t."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i in range(len(p)):
            new.append(min(row[i] + (p[i] != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_alignment_against_full_table():
    r = random.Random(0)
    for _ in range(400):
        p = "".join(r.choice("ab") for _ in range(r.randint(1, 12)))
        t = "".join(r.choice("ab") for _ in range(r.randint(0, 16)))
        most = r.randint(0, 4)
        want = distance(p, t)
        got = edits(codes(p), codes(t), most)
        assert (got[0] if got else None) == (want if want <= most else None), (p, t, most)


@pytest.mark.parametrize("q", [1, 2, 3, 5, 7, 9, 12])
def test_qgrams_are_of_q(q):
    c = codes("".join(random.Random(q).choice("abcé") for _ in range(500)))
    names = {}
    for i, h in enumerate(qgrams(c, q).tolist()):
        assert names.setdefault(h, c[i : i + q].tobytes()) == c[i : i + q].tobytes()
    assert len(set(names.values())) == len(names) and len(qgrams(c, q)) == 501 - q and len(qgrams(c[:0], q)) == 0


def edited(r, s, n):
    s = list(s)
    for _ in range(n):
        i = r.randrange(len(s))
        s[i : i + 1] = r.choice([[], [r.choice("xyz")], [s[i], r.choice("xyz")]])
    return "".join(s)


def test_passages_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((40, 30, 12, 8, 5, 6))] + [(6, None), (7, ""), (8, "too short"), (9, "Ä! b c d e")]
    rows = []
    for i in range(80):
        p = r.choice(items[:6])[1]
        rows.append((i, f"{text(r.randint(0, 60))} {edited(r, p, r.choice([0, 1, 3, 8, 20]))}, {text(r.randint(0, 20))}", "s"))
    rows += [(80, None, "s"), (81, "", "s"), (None, items[0][1].upper() + "!", "s"), (3, "x ä b? C d e", "s")]
    rows += [(82, text(900) + " " + items[1][1] + " " + text(900), "s")]
    monkeypatch.setattr("graphloom.llm.decontaminate.SLICE_CHARS", 700)
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string, edits string"), spark.createDataFrame(items, "item_id long, text string")
    budget = {i: len(plain(t)) * 10 // 100 for i, t in items if plain(t)}
    assert budget[0] > 10 and budget[8] == 1
    want = sorted(((k, i, e) for k, t, _ in rows for i, p in items if i in budget and (e := distance(plain(p), plain(t))) <= budget[i]), key=str)
    got = find_passages(docs, bench).collect()
    assert sorted(((x.doc_id, x.item_id, x.edits) for x in got), key=str) == want
    found = {(k, i) for k, i, _ in want}
    clean = [x for x in rows if not any((x[0], i) in found and distance(plain(dict(items)[i]), plain(x[1])) <= budget[i] for i in budget)]
    assert sorted(map(tuple, without_passages(docs, bench).collect()), key=str) == sorted(clean, key=str)
    assert find_passages(docs.limit(0), bench).collect() == [] == find_passages(docs, bench.limit(0)).collect()
    assert without_passages(docs, bench.limit(0)).count() == len(rows)


def test_short_passages_have_their_budget(spark):
    items = [(0, "Too short!"), (1, "zebra"), (2, "a"), (3, "?"), (4, "one two three four")]
    rows = [(0, "This is too  SHORT."), (1, "two shorter, to short"), (2, "a zebra"), (3, "zebras"), (4, "zebra zebra"), (5, "One two three, four"), (6, "one two thee four"), (7, None), (8, "one to thre fur")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(x.doc_id, x.item_id, x.edits) for x in find_passages(docs, bench).collect()]
    want = [(k, i, e) for k, t in rows for i, p in items if plain(p) and (e := distance(plain(p), plain(t))) <= len(plain(p)) // 10]
    assert sorted(got) == sorted(want) and (6, 4, 1) in want and (1, 0, 1) in want and not any(k == 8 for k, *_ in want)
    assert find_passages(docs, bench, least_words=5).count() == 0


def test_periodic_passages_have_the_least_edits(spark, monkeypatch):
    monkeypatch.setattr("graphloom.llm.decontaminate.POSTINGS", 500)
    r, items, rows = random.Random(8), [], []
    for i in range(40):
        period = "".join(r.choice("abc ") for _ in range(r.randint(3, 12)))
        items.append((i, period * r.randint(5, 25)))
        rows.append((i, "x y z " + edited(r, items[-1][1], r.randint(0, 8)) + period * r.randint(0, 6) + " " + edited(r, items[-1][1], r.randint(0, 8))))
    got = {(x.doc_id, x.item_id): x.edits for x in find_passages(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(k, i): e for k, t in rows for i, p in items if plain(p) and (e := distance(plain(p), plain(t))) <= len(plain(p)) // 10}
    assert got == want and len(want) > 30


def greedy(word, tokens):
    n = 0
    while word:
        k = next((k for k in range(len(word), 0, -1) if word[:k] in tokens), 1)
        word, n = word[k:], n + 1
    return n


def test_automaton_against_greedy():
    r = random.Random(1)
    for _ in range(60):
        tokens = {bytes(r.choice(b" abc") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 30))}
        a = Automaton(sorted(tokens), cached=4)
        for _ in range(40):
            w = bytes(r.choice(b"abcd") for _ in range(r.randint(0, 25)))
            assert a.total([w, w]) == 2 * greedy(b" " + w, tokens)


def test_token_counts(spark):
    tokens = [b" t", b" the", b"he", b"e", "é".encode()]
    rows = [(1, "the t\nthe", 0), (2, None, 0), (3, "", 0), (3, " \t", 0), (None, "thé " * 300, 0), (4, "t" * 5000, 0)]
    got = count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_words int"), vocabulary=tokens).collect()
    for x in got:
        words = (x.text or "").encode().split()
        assert (x.n_words, x.n_tokens) == (len(words), sum(greedy(b" " + w, set(tokens)) for w in words))
    assert len(got) == 6
