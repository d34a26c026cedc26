"""Documents whose word shingles overlap, found with a token-group matrix.

1. Every shingle is counted over the corpus (in bulk, see _chunks). Linked documents share at least the
   threshold's part of the larger set, so a document fewer of whose shingles occur elsewhere has no link and
   is done. What is left, a small part of the corpus, goes on as sets; equal sets go on once.
2. Sets are put into groups of similar ones by the least hash among their shared shingles; a group holds
   131,072 tokens at most, larger ones are split by hash. Each group is opened against itself; the parts of a
   split group share the set with the most frequent tokens, which ties their links together.
3. The matrix: for each token of a set's prefix (its rarest tokens; linked sets share one of them) the groups
   that hold it. Tokens with one class are dropped, tokens with the same groups count once. Two groups that
   share a token are opened against each other unless they are one class already or their sizes forbid a link:
   a set is compared with the members only if its overlap with the union of the group's tokens is large enough.
4. Links make classes. Copies are never expanded to pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm._chunks import SHORT, Chunked, counted, total
from graphloom.llm._shared import on_plain_names, table
from graphloom.llm._text import Words, mix, span_hashes
from graphloom.llm.components import components
from graphloom.session import ship

GROUP_TOKENS = 1 << 17


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole text as one if it has fewer than `size` words."""
    at = w.windows(size)
    hashes, cut = span_hashes(w.hashes, at, at + size), np.searchsorted(at, w.first)
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    whole = dict(zip(short.tolist(), span_hashes(w.hashes, w.first[short], w.first[short + 1]), strict=True))
    return [np.array([whole[d]], np.uint64) if d in whole else np.unique(hashes[cut[d] : cut[d + 1]]) for d in range(len(w.counts))]


def _name(tokens: np.ndarray) -> str | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest() if len(tokens) else None


class _Open:
    """Sets of a group, and which tokens they hold: a row of the token-group matrix made whole."""

    def __init__(self, tokens: list[np.ndarray]):
        member = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        every = np.concatenate(tokens)
        order = np.argsort(every, kind="stable")
        self.tokens, self.member, self.sizes = every[order], member[order], np.array([len(t) for t in tokens])

    def overlaps(self, query: np.ndarray, least: int) -> np.ndarray | None:
        """Shared tokens of query with each member; None if even the union of the group has fewer than least."""
        a, b = np.searchsorted(self.tokens, query, "left"), np.searchsorted(self.tokens, query, "right")
        n = b - a
        if np.count_nonzero(n) < least:
            return None
        a, n = a[n > 0], n[n > 0]
        spots = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(self.member[spots], minlength=len(self.sizes))


class _Union:
    def __init__(self, n: int):
        self.up, self.left = list(range(n)), n

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
            self.left -= 1
        return i != j


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of docs: key, text_md5, n_shingles and component_id.

    Words are lower-cased (A-Z). Two documents link when 100 * intersection >= percent * union of their sets of
    distinct `size`-word shingles; a text with fewer words is one shingle of its own kind. component_id is the
    least key reachable by links, the row's own included. Null and empty texts have no shingles and no links.
    Rows with a null key link like others but give no component_id; those linked with null keys alone get null.
    text_md5 tells rows of one key apart. Other columns of docs are not returned and may have any name. Texts are read whole, of any length.
    """
    return _linked(docs, key, text, size, percent).drop("class").withColumnRenamed("key", key)


def _linked(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """key, text_md5, n_shingles, component_id and class (a name that rows linked with each other share)."""
    slim = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"), F.md5(F.col(f"`{text}`").cast("binary")).alias("text_md5"))
    corpus = Chunked(slim, "__key", "__text")

    def distinct_sets(t: pa.Table) -> tuple[list[np.ndarray], list[str | None], list[int]]:
        """Set and name of each text; numbers of the texts that are the first with their set."""
        sets = shingle_sets(Words(t["__text"], lower=True), size)
        names = [_name(s) for s in sets]
        first = {n: i for i, n in reversed(list(enumerate(names))) if n}
        return sets, names, sorted(first.values())

    def ask(t: pa.Table) -> tuple:
        sets, _, first = distinct_sets(t)
        hashes, counts = counted(np.concatenate([sets[i] for i in first] or [np.zeros(0, np.uint64)]) & SHORT)
        return hashes, ["48", counts]

    def answer(order, starts, number, columns) -> np.ndarray:
        return total(columns[0], order, starts, number)

    def keep(t: pa.Table, counts: np.ndarray) -> pa.Table:
        sets, names, first = distinct_sets(t)
        asked = np.unique(np.concatenate([sets[i] for i in first] or [np.zeros(0, np.uint64)]) & SHORT)
        n = len(sets)
        tokens, prefix, least, score = [None] * n, [None] * n, [None] * n, [None] * n
        for i in first:
            s = sets[i]
            df = counts[np.searchsorted(asked, s & SHORT)]
            shared = s[df > 1]
            if 100 * len(shared) < percent * len(s):
                continue
            order = np.lexsort((s, df))[: len(s) + 1 - -(-percent * len(s) // 100)]
            tokens[i], prefix[i] = s.tobytes(), s[order][df[order] > 1].view(np.int64)
            least[i], score[i] = int(mix(shared ^ np.uint64(0x5851F42D4C957F2D)).min().view(np.int64)), float(df.mean())
        columns = [t["__key"], t["text_md5"], pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.string())]
        columns += [pa.array(tokens, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(least, pa.int64()), pa.array(score, pa.float64())]
        return pa.table(columns, names=["key", "text_md5", "n_shingles", "set", "tokens", "prefix", "least", "score"])

    kind = slim.schema["__key"].dataType.simpleString()
    counts = corpus.answers(corpus.ask(ask), answer, ["48", "uint8"])
    profile = table(corpus.work(keep, f"key {kind}, text_md5 string, n_shingles long, set string, tokens binary, prefix array<long>, least long, score double", counts))
    sets = table(profile.where("tokens IS NOT NULL").select("set", F.col("n_shingles").alias("n"), "tokens", "prefix", "least", "score").dropDuplicates(["set"]))
    return _labelled(profile, _classes(sets, percent))


def _classes(sets: DataFrame, percent: int) -> DataFrame:
    """(set, class) for sets that have more than one member in their class or might have."""

    ship(sets.sparkSession)

    def linked(shared: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
        return (100 + percent) * shared >= percent * (n + sizes)

    def open_self(t: pa.Table) -> pa.Table:
        names = t["set"].to_pylist()
        tokens = [np.frombuffer(b, np.uint64) for b in t["tokens"].to_pylist()]
        group, union, out = _Open(tokens), _Union(len(names)), []
        for i, q in enumerate(tokens):
            shared = group.overlaps(q, -(-percent * len(q) // 100)) if union.left > 1 else None
            for j in [] if shared is None else np.flatnonzero(linked(shared, len(q), group.sizes)):
                if union.join(i, int(j)):
                    out.append((names[i], names[int(j)]))
        return pa.table([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], names=["a", "b"])

    def open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                one, two = left.as_py(), right.as_py()
                group, done = _Open([np.frombuffer(m["tokens"], np.uint64) for m in two]), set()
                for m in one:
                    q = np.frombuffer(m["tokens"], np.uint64)
                    shared = group.overlaps(q, -(-percent * len(q) // 100))
                    for j in [] if shared is None else np.flatnonzero(linked(shared, len(q), group.sizes)):
                        pair = (m["class"], two[int(j)]["class"])
                        if pair[0] != pair[1] and pair not in done:
                            done.add(pair)
                            out.append(pair)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], names=["a", "b"])

    keys = sets.groupBy("least").agg(F.count("*").alias("members"), F.greatest(F.lit(1), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("parts"), F.max_by("set", F.struct("score", "set")).alias("lead"))
    keys = table(keys)
    group = F.xxhash64("least", F.pmod(F.xxhash64("set"), F.col("parts"))).alias("grp")
    shared_leads = keys.where("parts > 1").select("least", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("lead").alias("set"))
    leads = shared_leads.select("set", F.xxhash64("least", "part").alias("grp"))
    members = sets.join(keys.where("members > 1"), "least").select("set", group).unionByName(leads).distinct()
    within = members.join(sets.select("set", "tokens"), "set").select("grp", "set", "tokens").groupBy("grp").applyInArrow(open_self, "a string, b string")
    near = components(within)

    placed = sets.join(keys.select("least", "parts"), "least").join(near.withColumnRenamed("node", "set"), "set", "left")
    placed = table(placed.select("set", "n", group, F.coalesce("label", "set").alias("class"), "prefix"))
    held = placed.select(F.explode("prefix").alias("token"), "grp", "class")
    across = held.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("token")
    matrix = held.join(across, "token").select("token", "grp").distinct()
    alike = matrix.groupBy("token").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("grp")).alias("x"), F.bit_xor(F.xxhash64("grp", F.lit(7))).alias("y")).where("c > 1")
    matrix = table(matrix.join(alike.groupBy("c", "x", "y").agg(F.min("token").alias("token")).select("token"), "token"))
    sizes = placed.groupBy("grp").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.min("n").alias("few"), F.max("n").alias("many"))
    one, two = (sizes.select(*[F.col(c).alias(f"{c}_{s}") for c in sizes.columns]) for s in "ab")
    pairs = matrix.withColumnRenamed("grp", "grp_a").join(matrix.withColumnRenamed("grp", "grp_b"), "token").where("grp_a < grp_b").select("grp_a", "grp_b").distinct()
    pairs = pairs.join(one, "grp_a").join(two, "grp_b").where(f"NOT (lo_a = hi_a AND lo_b = hi_b AND lo_a = lo_b) AND {percent} * few_a <= 100 * many_b AND {percent} * few_b <= 100 * many_a")
    pairs = table(pairs.select("grp_a", "grp_b"))
    wanted = pairs.select(F.explode(F.array("grp_a", "grp_b")).alias("grp")).distinct()
    packs = placed.drop("prefix", "n").join(wanted, "grp").join(sets.select("set", "tokens"), "set").groupBy("grp").agg(F.collect_list(F.struct("class", "tokens")).alias("pack"))
    both = pairs.join(packs.select(F.col("grp").alias("grp_a"), F.col("pack").alias("left")), "grp_a").join(packs.select(F.col("grp").alias("grp_b"), F.col("pack").alias("right")), "grp_b")
    far = components(both.select("left", "right").mapInArrow(open_pairs, "a string, b string"))
    return placed.select("set", "class").join(far.withColumnRenamed("node", "class"), "class", "left").select("set", F.coalesce("label", "class").alias("class"))


def _labelled(profile: DataFrame, classes: DataFrame) -> DataFrame:
    """component_id and class for each row of profile. Counts by set first, so that a large class stays one row per set, then by class
    within each task before the shuffle; the least keys are a written table, one row a class of several sets."""
    least = profile.where("set IS NOT NULL").groupBy("set").agg(F.min("key").alias("first"))
    placed = table(least.join(classes, "set", "left").select("set", "first", F.coalesce("class", "set").alias("class")))
    lowest = table(placed.groupBy("class").agg(F.min("first").alias("lowest"), F.count("*").alias("sets")).where("sets > 1").drop("sets"))
    labels = placed.join(lowest, "class", "left").select("set", "class", F.coalesce("lowest", "first").alias("component_id"))
    out = profile.select("key", "text_md5", "n_shingles", "set").join(labels, "set", "left")
    return out.select("key", "text_md5", "n_shingles", F.when(F.col("set").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"), "class")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, its columns as they are, with one row of each class: that with the least key (null last), then the least MD5 of the text, then of the whole row.

    Rows without words stay, as do those that are in no class with others; of wholly repeated rows with words one stays.
    That row is the one whose key is the class's component_id, so no class is gathered or joined to its rows.
    """

    def run(plain: DataFrame, k: str, t: str) -> DataFrame:
        linked = _linked(plain, k, t, 5, 75).where("n_shingles > 0")
        named = linked.where(F.col("key") == F.col("component_id")).groupBy("key", "class").agg(F.min("text_md5").alias("md5")).select("key", "md5")
        nameless = linked.where("component_id IS NULL").groupBy("class").agg(F.min("text_md5").alias("md5")).select(F.lit(None).cast(linked.schema["key"].dataType).alias("key"), "md5")
        kept = table(named.unionByName(nameless).distinct().withColumnsRenamed({"key": "__key", "md5": "__kept"}))
        marked = plain.where(F.col(t).isNotNull()).withColumn("__md5", F.md5(F.col(t).cast("binary")))
        held = marked.join(kept, F.col(k).eqNullSafe(F.col("__key")) & (F.col("__md5") == F.col("__kept"))).drop("__kept", "__key").withColumn("__row", F.md5(F.to_json(F.struct(*plain.columns))))
        first = held.groupBy(k, "__md5").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
        again = table(first.where("__n > 1").select(F.col(k).alias("__key"), F.col("__md5").alias("__kept"), "__first"))
        once = held.join(again, F.col(k).eqNullSafe(F.col("__key")) & (F.col("__md5") == F.col("__kept")), "left")
        single = once.where("__first IS NULL").select(plain.columns)
        several = once.where("__row = __first").dropDuplicates([k, "__md5"]).select(plain.columns)
        bare = plain.where(F.col(t).isNull() | ~F.col(t).rlike(r"[^\x20\x09-\x0D]"))
        return single.unionByName(several).unionByName(bare)

    return on_plain_names(docs, run, key, text)
