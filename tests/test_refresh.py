import os
import random
from collections import Counter

from graphloom.model import make_model
from graphloom.operators import refresh, rules
from graphloom.operators.retrieval import retrieval_units
from graphloom.operators.store import Store, changed_rows

NODE = "doc_id string, ord int, id string, type string, label string, properties string, derivation string, note string, evidence struct<location:string,quote:string,artifact:string,by:string,at:string>"
EDGE = "doc_id string, ord int, predicate string, source string, target string, qualifier string, derivation string, note string, evidence struct<location:string,quote:string,artifact:string,by:string,at:string>, properties string"
DOCUMENT = "doc_id string, layer string, ontology_version string, sources array<struct<path:string,sha256:string>>"


def graph(spark, docs: dict[str, tuple]):
    d = [(k, "base", "1", [(f"f/{k}", f"{hash((k, repr(v)))}")]) for k, v in docs.items()]
    n = [(k, i, x, t, f"{x} by {k}", "{}", "derived", None, None) for k, (nodes, _) in docs.items() for i, (x, t) in enumerate(nodes)]
    e = [(k, i, "knows", s, t, None, "derived", None, None, None) for k, (_, edges) in docs.items() for i, (s, t) in enumerate(edges)]
    return spark.createDataFrame(d, DOCUMENT), spark.createDataFrame(n, NODE), spark.createDataFrame(e, EDGE)


def some(r: random.Random, k: int) -> tuple:
    nodes = [(f"n{r.randint(0, 14)}", r.choice(["a", "a", "b", "odd"])) for _ in range(r.randint(0, 3))] + [(f"own{k}", "a")]
    return nodes, [(r.choice(nodes)[0] if r.random() < 0.7 else f"n{r.randint(0, 16)}", f"n{r.randint(0, 16)}") for _ in range(r.randint(0, 4))]


def rows(df):
    return Counter(map(repr, df.select(*sorted(df.columns)).collect()))


def test_refreshed_equals_rebuilt(spark, tmp_path):
    model = make_model(spark, classes=[("base", "a", "K", None, None, None), ("base", "b", "K", "a", None, None)], predicates=[("base", "knows", False)], licensed=[("base", "knows", "a", "a", None, None), ("base", "knows", "a", "b", None, None)], imports=[("base", None, "1", "n")])
    r = random.Random(7)
    docs = {f"d{k}": some(r, k) for k in range(12)}
    store = Store(spark, str(tmp_path / "store"), refresh.KEYS, buckets=16)
    refresh.build(store, *graph(spark, docs), model)
    for step in range(2):
        edited = {f"d{k}": some(r, k) for k in r.sample(range(14), 2)}  # changed, or new
        gone = [k for k in r.sample(sorted(docs), 1) if k not in edited]
        docs = {k: v for k, v in docs.items() if k not in gone} | edited
        done = refresh.refresh(store, spark.createDataFrame([(g,) for g in gone], "doc_id string"), *graph(spark, edited), model)
        whole = graph(spark, docs)
        for name, t in zip(("documents", "nodes", "edges"), whole):
            assert rows(store.read(name)) == rows(t), (step, name)
        assert rows(store.read("units")) == rows(retrieval_units(*whole[1:], 50, whole[0])), step
        assert rows(store.read("findings")) == rows(rules.validate(*whole, model)), step
        assert done["findings"].count() <= len(docs) + 2


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    store = Store(spark, str(tmp_path / "s"), {"t": "k"}, buckets=32)
    store.write(t=t)
    old = Store(spark, store.path, store.keys, 32, store.schemas, store.at)
    store.replace(t=(spark.createDataFrame([(5, 100), (2000, 1)], "k long, v long"), spark.createDataFrame([(5,), (9,)], "k long")))
    a, b = old.heads(), store.heads()
    assert 1 <= len({k for k in {*a, *b} if a.get(k) != b.get(k)}) <= 3
    want = {x: x % 7 for x in range(1000)} | {5: 100, 2000: 1}
    del want[9]
    assert {r.k: r.v for r in store.read("t").collect()} == want and {r.k: r.v for r in old.read("t").collect()} == {x: x % 7 for x in range(1000)}
    gone, come = changed_rows(old, store, "t")
    differ = {tuple(r) for r in gone.subtract(come).collect()}, {tuple(r) for r in come.subtract(gone).collect()}
    assert differ == ({(5, 5), (9, 2)}, {(5, 100), (2000, 1)}) and gone.count() < 200


def test_untouched_files_are_not_read(spark, tmp_path):
    for name, text in (("a.txt", "one"), ("b.txt", "two"), ("c.txt", "three"), ("d/e.txt", "four")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    first = refresh.listing(spark, str(tmp_path), "*.txt")
    manifest = spark.createDataFrame(refresh.read_files(spark, first).drop("text").collect(), "file string, length long, modified timestamp, sha256 string")
    (tmp_path / "b.txt").write_text("TWO")
    os.utime(tmp_path / "b.txt", (10, 10))
    os.utime(tmp_path / "c.txt", (20, 20))  # touched, not changed
    (tmp_path / "a.txt").unlink()
    (tmp_path / "f.txt").write_text("five")
    os.chmod(tmp_path / "d/e.txt", 0)  # would fail if it were opened
    now = refresh.listing(spark, str(tmp_path), "*.txt")
    read = refresh.read_files(spark, refresh.suspects(now, manifest))
    assert {r.file.rsplit("/", 1)[1] for r in read.collect()} == {"b.txt", "c.txt", "f.txt"}
    short = lambda t: {(r.file.rsplit("/", 1)[1], r.change) for r in t.collect()}
    assert short(refresh.file_changes(read, now, manifest)) == {("b.txt", "changed"), ("f.txt", "added"), ("a.txt", "gone")}
    versioned = manifest.selectExpr("*", "IF(file LIKE '%e.txt', '0', '1') AS version")
    assert short(refresh.file_changes(read, now, versioned, "1")) == {("b.txt", "changed"), ("f.txt", "added"), ("a.txt", "gone"), ("e.txt", "changed")}
    os.chmod(tmp_path / "d/e.txt", 0o644)


def test_documents_from_files(spark):
    d, _, _ = graph(spark, {"x": ([], []), "y": ([], [])})
    assert [r.doc_id for r in refresh.documents_from(d, spark.createDataFrame([("f/y",), ("f/z",)], "path string")).collect()] == ["y"]
