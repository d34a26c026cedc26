"""Document quality by weak supervision, in DataFrame functions only.

Rules look at one document each and vote good (1), bad (-1) or abstain (0). How far each can be trusted is
not set by hand: expectation-maximisation over the counts of vote patterns estimates, for good and for bad
documents, how often each rule that votes is right. An abstention tells nothing. The posterior probability of
being good replaces the rule that all must pass. The patterns are at most 3 to the number of rules, whatever the corpus.

The base rules decide what they decide: documents that fail them are rejected and not learnt from. Among the others
estimation starts from "a bad vote makes a bad document likely", which fixes what the two classes stand for; no estimate
is bounded after that. A smoothing prior worth 100 votes (one of them bad) for good documents and 2 votes (one bad) for
bad ones keeps rules that never vote from deciding anything. What several thresholds on the same characters say is one vote.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm._shared import on_plain_names, table
from graphloom.llm._words_sql import count_of, word_array

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*BASE, "base_failed", "posterior", "kept"]
ROUNDS = 40
GOOD_PRIOR, BAD_PRIOR = (1.0, 99.0), (1.0, 1.0)
"""Smoothing: bad and good votes added to those counted on good documents, and on bad ones."""


def _per_word(n: str, bad: float, good: float) -> Column:
    rate = F.col(n) / F.greatest(F.col("n_words"), F.lit(1))
    return F.when(rate > bad, -1).when(rate <= good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Name and vote of each rule, over the columns that measured() adds."""
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    variety = F.col("__distinct") / F.greatest(F.col("n_words"), F.lit(1))
    words = F.greatest(F.col("n_words"), F.lit(1))
    flooded = (F.col("n_symbols") > 0.1 * words) | (F.col("n_symbols") > 0.1 * F.col("word_chars")) | (F.col("__pipes") > 0.15 * words)
    return {
        "symbols": F.when(flooded, -1).when((F.col("n_symbols") <= 0.01 * words) & (F.col("__pipes") == 0), 1).otherwise(0),
        "shouting": _per_word("__bangs", 0.2, 0.02),
        "capitals": F.when(F.col("__upper") > 0.4 * F.col("word_chars"), -1).when(F.col("__upper") <= 0.15 * F.col("word_chars"), 1).otherwise(0),
        "repeats": _per_word("n_repeat_words", 0.2, 0.0),
        "lines": F.when(F.col("__lines") < 2, 0).when(F.col("n_dup_lines") > 0.4 * F.col("__lines"), -1).when(F.col("n_dup_lines") == 0, 1).otherwise(0),
        "word_length": F.when((mean < 2) | (mean > 14), -1).when(mean.between(3, 10), 1).otherwise(0),
        "variety": F.when(F.col("n_words") < 30, 0).when(variety < 0.15, -1).when(variety > 0.3, 1).otherwise(0),
        "sentences": F.when(F.col("n_words") < 20, 0).when(F.col("__stops") == 0, -1).otherwise(1),
    }


def measured(docs: DataFrame, text: str, size: int = 5) -> DataFrame:
    """docs with the base measures and helper columns. All work is on the arrays of one row: nothing is shuffled."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("__words", word_array(F.col(text))).withColumn("__text", t)
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("__line", lines).withColumn("n_words", F.size("__words").cast("long"))
    window = F.transform(F.sequence(F.lit(0), (F.col("n_words") - size).cast("int")), lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(size)]))
    out = out.withColumn("__windows", F.when(F.col("n_words") >= size, window).otherwise(F.array().cast("array<bigint>")))
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__placed", F.when(again, placed))
    twice = F.filter("__placed", lambda x, i: F.coalesce(F.get("__placed", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("__placed", i + 1)["h"] == x["h"], F.lit(False)))
    out = out.withColumn("__starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("__starts", zero, lambda a, p: F.struct((a["n"] + p + size - F.greatest(p, a["end"])).alias("n"), (p + size).alias("end")), lambda a: a["n"])
    out = out.withColumns({
        "word_chars": (F.length("__text") - count_of(F.col("__text"), " \t\n\x0b\f\r")).cast("long"),
        "n_symbols": count_of(F.col("__text"), SYMBOLS),
        "n_dup_lines": (F.size("__line") - F.size(F.array_distinct("__line"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "__pipes": count_of(F.col("__text"), "|"),
        "__bangs": count_of(F.col("__text"), "!"),
        "__upper": count_of(F.col("__text"), UPPER),
        "__stops": count_of(F.col("__text"), ".?!"),
        "__lines": F.size("__line"),
        "__distinct": F.size(F.array_distinct("__words")),
    })
    return out


def _log_odds(model: dict) -> Column:
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for name, votes in model["votes"].items():
        vote = F.col(f"__vote_{name}")
        good, bad = votes
        odds = odds + F.when(vote == 1, math.log((1 - good) / (1 - bad))).when(vote == -1, math.log(good / bad)).otherwise(0.0)
    return odds


def _posterior(model: dict | None) -> Column:
    return F.lit(0.95) if model is None else 1 / (1 + F.exp(-_log_odds(model)))


def fit(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict | None:
    """{prior, votes: {rule: (share of bad votes on good documents, and on bad ones)}} from rows of votes and n; None without rows.

    The patterns, of which there are at most 3 to the number of rules, become one row; all rounds are one expression over it.
    """
    votes = F.array(*[F.col(f"__vote_{n}").cast("int") for n in names])
    rows = patterns.groupBy(votes.alias("v")).agg(F.sum("n").cast("double").alias("n")).agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("all"))
    none = F.array_repeat(F.lit(0.0), len(names))
    state = lambda prior, good, bad: F.struct(prior.alias("prior"), good.alias("good"), bad.alias("bad"))
    fields = ("good_down", "good_up", "bad_down", "bad_up")

    def told(shares: Column, row: Column) -> Column:
        """Log of the likelihood of a row's votes by the shares of bad votes."""
        return F.aggregate(F.zip_with(shares, row["v"], lambda s, v: F.when(v == -1, F.log(s)).when(v == 1, F.log(1 - s)).otherwise(0.0)), F.lit(0.0), lambda x, y: x + y)

    def summed(posterior) -> Column:
        """Votes of all rows by kind, weighted with the posterior of each."""

        def add(acc: Column, row: Column) -> Column:
            good = row["n"] * posterior(row)
            grown = lambda f, kind, w: F.zip_with(acc[f], row["v"], lambda t, v: t + F.when(v == kind, w).otherwise(0.0)).alias(f)
            bad = row["n"] - good
            return F.struct((acc["good"] + good).alias("good"), (acc["bad"] + bad).alias("bad"), *[grown(f, kind, w) for f, kind, w in zip(fields, (-1, 1, -1, 1), (good, good, bad, bad), strict=True)])

        return F.aggregate("all", F.struct(F.lit(0.0).alias("good"), F.lit(0.0).alias("bad"), *[none.alias(f) for f in fields]), add)

    def estimated(t: Column) -> Column:
        share = lambda down, up, prior: F.zip_with(t[down], t[up], lambda d, u: (d + prior[0]) / (d + u + sum(prior)))
        return state((t["good"] + 1) / (t["good"] + t["bad"] + 2), share("good_down", "good_up", GOOD_PRIOR), share("bad_down", "bad_up", BAD_PRIOR))

    def again(m: Column, _: Column) -> Column:
        return estimated(summed(lambda row: 1 / (1 + F.exp(F.log((1 - m["prior"]) / m["prior"]) + told(m["bad"], row) - told(m["good"], row)))))

    start = estimated(summed(lambda row: F.when(F.array_min(row["v"]) < 0, 0.05).otherwise(0.95)))
    first = rows.where("size(all) > 0").select("all", start.alias("m"))
    r = first.select(F.aggregate(F.sequence(F.lit(2), F.lit(max(rounds, 2))), F.col("m"), again).alias("m")).first()
    return r and {"prior": r.m.prior, "votes": {n: (r.m.good[j], r.m.bad[j]) for j, n in enumerate(names)}}


def _failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _votes(docs: DataFrame, text: str, carry: list[Column]) -> DataFrame:
    return measured(docs, text).select(*carry, *BASE, *[v.cast("byte").alias(f"__vote_{n}") for n, v in rules().items()])


def _judged(votes: DataFrame, threshold: float) -> DataFrame:
    """votes, which are read twice, with base_failed, posterior and kept."""
    names = list(rules())
    patterns = votes.where(~_failed()).groupBy(*[f"__vote_{n}" for n in names]).agg(F.count("*").alias("n"))
    model = fit(table(patterns), names)
    out = votes.withColumn("base_failed", _failed()).withColumn("posterior", _posterior(model))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).drop(*[f"__vote_{n}" for n in names])


def quality_rules(docs: DataFrame, text: str = "text", carry: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """docs (or the columns in carry) with the base measures, base_failed, posterior and kept.

    base_failed: fewer than 10 words, or over 20 % of the words in 5-word windows found twice or more. kept:
    not base_failed and a posterior of at least the threshold. Null text counts as empty and fails. Texts are read
    whole, of any length; repeated rows are judged alike, one by one. Columns of docs named like an added one are
    replaced, others may have any name. A table without rows gives none. Measures are taken once and written to the
    shared folder beside the columns that are carried.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ADDED]
    places = {n: f"c{i}" for i, n in enumerate(docs.columns)}
    plain = docs.toDF(*places.values())
    votes = table(_votes(plain, places[text], [F.col(places[n]) for n in names]))
    return _judged(votes, threshold).select(*[places[n] for n in names], *ADDED).toDF(*names, *ADDED)


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with its columns, that quality_rules() keeps.

    Measures are taken once and written without the texts; what is rejected is told by the MD5 of the text, which is all
    that a judgement hangs on. Rows with a null text are rejected.
    """
    md5 = lambda c: F.md5(F.col(c).cast("binary"))

    def run(plain: DataFrame, t: str) -> DataFrame:
        judged = _judged(table(_votes(plain.where(F.col(t).isNotNull()), t, [md5(t).alias("__md5")])), threshold)
        rejected = table(judged.where("NOT kept").select("__md5").distinct())
        return plain.where(F.col(t).isNotNull()).withColumn("__md5", md5(t)).join(rejected, "__md5", "left_anti").drop("__md5")

    return on_plain_names(docs, run, text)
