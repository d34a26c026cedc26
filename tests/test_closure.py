"""Paths by doubling, against brute force."""

import random
from pathlib import Path

from graphloom.operators import cycles, frontier
from graphloom.operators.cycles import strong_components
from graphloom.operators.frontier import closure
from graphloom.operators.lines import closure_of, lines_of, reached


def brute(edges):
    pairs = set(edges)
    while True:
        more = pairs | {(a, d) for a, b in pairs for c, d in pairs if b == c}
        if more == pairs:
            return pairs
        pairs = more


def test_chains_cycles_and_random_graphs(spark):
    draw = random.Random(3)
    graphs = [[("a", "a")], [("a", "b"), ("b", "c"), ("c", "a")], [(i, i + 1) for i in range(13)], [(i, (i + 1) % 7) for i in range(7)] + [(3, "x"), ("x", "y")]]
    graphs += [[(draw.randrange(9), draw.randrange(9)) for _ in range(11)] for _ in range(6)]
    edges = [(f"{n}/{a}", f"{n}/{b}") for n, g in enumerate(graphs) for a, b in g]
    got = [tuple(r) for r in closure(spark.createDataFrame(edges, "source string, target string")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(edges)


def test_no_edges(spark):
    assert closure(spark.createDataFrame([], "source string, target string")).isEmpty()


def test_reached_along_lines(spark):
    """Chains, rings, rings with tails, trees both ways, a self-loop, repeated edges and random graphs, from all nodes and from some."""
    draw = random.Random(5)
    graphs = [[("a", "a")], [("a", "a"), ("b", "a"), ("a", "c")], [("a", "b"), ("b", "c"), ("c", "a")], [(i, i + 1) for i in range(37)], [(i, (i + 1) % 16) for i in range(16)], [(i, (i + 1) % 7) for i in range(7)] + [(3, "x"), ("x", "y"), ("z", 1)]]
    graphs += [[(i, i // 2) for i in range(1, 20)], [(i // 3, i) for i in range(1, 20)], [("a", "b"), ("a", "b"), ("b", "c")]]
    graphs += [[(draw.randrange(n), draw.randrange(n)) for _ in range(m)] for n, m in ((9, 8), (9, 11), (14, 12), (20, 18), (20, 22), (6, 14))]
    edges = [(f"{n}/{a}", f"{n}/{b}") for n, g in enumerate(graphs) for a, b in g]
    want = brute(edges)
    lines = lines_of(spark.createDataFrame(edges, "source string, target string"))
    seeds = sorted({x for e in edges for x in e}) + ["nowhere"]
    for some in (seeds, seeds[::5]):
        got = [tuple(r) for r in reached(lines, spark.createDataFrame([(s,) for s in some], "seed string")).collect()]
        assert len(got) == len(set(got)) and set(got) == {p for p in want if p[0] in some}


def test_a_long_ring_is_one_line(spark):
    n = 3000
    lines = lines_of(spark.range(n).selectExpr("id AS source", f"(id + 1) % {n} AS target"))
    assert lines.members.count() == n and lines.members.select("line", "loop").distinct().count() == 1 and lines.leads.isEmpty()
    assert reached(lines, spark.createDataFrame([(5,), (7,)], "seed long")).count() == 2 * n


def test_components_against_brute_force(spark):
    draw = random.Random(8)
    graphs = [[("a", "a")], [("a", "b"), ("b", "a"), ("b", "b")], [(i, i + 1) for i in range(9)], [(i, (i + 1) % 5) for i in range(5)] + [(2, "t"), ("t", "u"), ("u", "t"), ("v", 0)]]
    graphs += [[(draw.randrange(n), draw.randrange(n)) for _ in range(m)] for n, m in ((8, 10), (12, 15), (20, 26), (20, 50))]
    edges = [(f"{n}/{a}", f"{n}/{b}") for n, g in enumerate(graphs) for a, b in g]
    pairs = brute(edges)
    want = {}
    for a, b in pairs:
        if a != b and (b, a) in pairs:
            want[a] = min(want.get(a, a), b)
    rows = [tuple(r) for r in strong_components(spark.createDataFrame([*edges, *edges[:3], (None, "0/a"), ("0/a", None)], "source string, target string")).collect()]
    assert len(rows) == len(want) and dict(rows) == want
    assert {tuple(r) for r in closure_of(spark.createDataFrame(edges, "source string, target string")).collect()} == pairs


def test_trees_fold_before_labels_are_sent(spark, monkeypatch):
    """of trees with ways home, whichever way round, few ways are left for the rounds of labels; among them random graphs, and nodes that lead to a circle or hang on one without lying on it."""
    draw = random.Random(20)
    tree = [(i, j) for i in range(1, 201) for j in ([k for k in (2 * i, 2 * i + 1) if k <= 200] or [1])] + [("in", 150), (70, "out"), ("in", "out")]
    graphs = [tree, [(b, a) for a, b in tree]]
    graphs += [[(draw.randrange(n), draw.randrange(n)) for _ in range(round(n * more))] for n in (2, 3, 5, 8, 12) for more in (1.1, 1.3, 1.6, 2) for _ in range(3)]
    edges = [(f"{n}/{a}", f"{n}/{b}") for n, g in enumerate(graphs) for a, b in g]
    seen = []
    monkeypatch.setattr(cycles, "_labels", lambda e, f=cycles._labels: seen.append(e.where("source LIKE '0/%' OR source LIKE '1/%'").count()) or f(e))
    ahead = {}
    for a, b in edges:
        ahead.setdefault(a, set()).add(b)
    reach = {}
    for x in {x for e in edges for x in e}:
        met, front = set(), [x]
        while front:
            new = ahead.get(front.pop(), set()) - met
            met |= new
            front += new
        reach[x] = met
    own = {x: min(y for y in met if x in reach[y]) for x, met in reach.items() if any(x in reach[y] and y != x for y in met)}
    rows = [tuple(r) for r in strong_components(spark.createDataFrame(edges, "source string, target string")).collect()]
    assert len(rows) == len(own) and dict(rows) == own and sum(seen) <= len(tree) / 10


def test_a_knit_circle_costs_rows_in_its_length(spark):
    """A tree of ways out and ways home from each leaf: everything reaches everything, and no pair of nodes or lines is formed."""
    n = 2000
    at = spark.range(1, n + 1)
    e = at.selectExpr("id AS source", "explode(IF(2 * id + 1 <= 2000, array(2 * id, 2 * id + 1), array(1L))) AS target").unionByName(spark.createDataFrame([(1000, 2000), (2000, n + 5), (0, 3)], "source long, target long"))
    lines = lines_of(e)
    assert lines.members.where("loop").count() == n and lines.members.where("loop").select("knot").distinct().count() == 1 and lines.leads.count() <= 3
    assert reached(lines, spark.createDataFrame([(7,), (n + 5,), (0,)], "seed long")).count() == 2 * n + 2


def test_no_lines(spark):
    lines = lines_of(spark.createDataFrame([], "source string, target string"))
    assert lines.members.isEmpty() and reached(lines, spark.createDataFrame([("a",)], "seed string")).isEmpty()


def test_written_tables_can_be_removed(spark):
    before = len(frontier.WRITTEN)
    t = frontier.written(spark.range(3))
    path = Path(frontier.WRITTEN[-1])
    assert t.count() == 3 and path.exists()
    frontier.remove_written(spark, before)
    assert not path.exists() and len(frontier.WRITTEN) == before
