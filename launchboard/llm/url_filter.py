"""URL filter: list rules first, then a character language-model ratio.

Urls that a list rule decides train two smoothed variable-order Markov models over
characters, one of accepted and one of rejected urls (Witten-Bell interpolation of
the contexts of ``ORDER`` down to 0 characters). A url without a rule is accepted
if its log-likelihood difference per character reaches a threshold, calibrated
where the two training classes are told apart best. DataFrame functions only.

Models see host and path in lower case with every digit as ``0``, begin padding and
an end mark. Urls of one such shape score alike, so counting and scoring work on
distinct shapes: the hottest host is one row after the first, partial aggregation.

Defined cases: null urls and urls without ``://`` have an empty host and path, and
their shape is the end mark alone; without training urls of both classes every
undecided url is allowed; repeated rows are judged each; an empty table gives no
rows; other columns are ignored. Of fitting rules the longest wins, then the
alphabetically first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchboard.llm.store import Scratch

#: Characters of context in the longest contexts.
ORDER = 4
#: Steps in which the threshold is sought.
STEPS = 400

PAD, END = "\x02", "\x03"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``rule`` is host and path prefix, like ``example.net/en/``."""

    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, _UPPER, _UPPER.lower()), path


def match_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, else nulls."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.rule) if rule is None else rule.when(fits, r.rule)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def shape(host: Column, path: Column) -> Column:
    return F.regexp_replace(F.lower(F.concat(host, path)), "[0-9]", "0")


def grams(shapes: DataFrame, order: int) -> DataFrame:
    """A row per character of ``shape``: it and the ``order`` characters before."""
    padded = F.concat(F.lit(PAD * order), "shape", F.lit(END))
    return shapes.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("shape") + 1))).withColumn(
        "gram", F.substring(padded, F.col("at"), F.lit(order + 1))).drop("at")


def gram_scores(counts: DataFrame, order: int) -> DataFrame:
    """(gram, gain): log ratio of the two models' probabilities of a gram's last
    character, from ``counts`` (gram, accepted, rejected) of all grams.

    Level k holds the last k + 1 characters. Its counts are sums over the longest
    grams, its contexts' totals and distinct followers are sums over its counts, and
    P_k = (n + T * P_(k-1)) / (N + T) with T followers; unseen contexts pass P_(k-1)
    on. Below order 0 stands the uniform distribution over all characters.
    """
    names = ("accepted", "rejected")
    below = None
    for k in range(order + 1):
        level = counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("tail")).agg(
            *(F.sum(n).alias(n) for n in names)).withColumn("context", F.substring("tail", 1, k))
        totals = [f(x) for n in names for f, x in (
            (lambda x: F.sum(x).alias(f"n_{x}"), n), (lambda x: F.count_if(F.col(x) > 0).alias(f"t_{x}"), n))]
        if k == 0:
            # one row of sums over at most as many rows as there are characters
            row = level.agg(F.count(F.lit(1)).alias("v"), *totals).first()
            both = level.withColumns({c: F.lit(row[c] or 0) for n in names for c in (f"n_{n}", f"t_{n}")})
            both = both.withColumns({f"b_{n}": F.lit(1.0 / max(row["v"], 1)) for n in names})
        else:
            both = (level.join(level.groupBy("context").agg(*totals), "context")
                    .withColumn("lower", F.substring("tail", 2, k))
                    .join(below, "lower"))
        probability = {
            f"p_{n}": F.when(F.col(f"n_{n}") == 0, F.col(f"b_{n}")).otherwise(
                (F.col(n) + F.col(f"t_{n}") * F.col(f"b_{n}")) / (F.col(f"n_{n}") + F.col(f"t_{n}")))
            for n in names}
        done = both.select("tail", *(v.alias(k) for k, v in probability.items()))
        below = done.select(F.col("tail").alias("lower"), *(
            F.col(f"p_{n}").alias(f"b_{n}") for n in names))
    return done.select(F.col("tail").alias("gram"),
                       (F.log("p_accepted") - F.log("p_rejected")).alias("gain"))


def shape_scores(shapes: DataFrame, order: int = ORDER) -> DataFrame:
    """(shape, accepted, rejected, score) from (shape, accepted, rejected) counts."""
    spark = shapes.sparkSession
    scratch = Scratch(spark, "url-filter")
    cut = grams(shapes, order)
    counts = scratch.keep(cut.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "grams")
    # equal grams of a shape need one lookup
    terms = cut.groupBy("shape", "gram").agg(
        F.count(F.lit(1)).alias("n"), F.first("accepted").alias("accepted"),
        F.first("rejected").alias("rejected"))
    scored = terms.join(gram_scores(counts, order), "gram")
    return scratch.keep(scored.groupBy("shape").agg(
        F.first("accepted").alias("accepted"), F.first("rejected").alias("rejected"),
        (F.sum(F.col("n") * F.col("gain")) / F.sum("n")).alias("score")), "scores")


def calibrate(scores: DataFrame, steps: int = STEPS) -> float | None:
    """The threshold between the least and the greatest training score with the
    least sum of the two classes' error rates; None without both classes. Training
    scores are counted in ``steps`` bins, and only the counts reach the driver."""
    trained = scores.where("accepted + rejected > 0")
    edge = trained.agg(F.min("score").alias("lo"), F.max("score").alias("hi"),
                       F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).first()
    if not edge["a"] or not edge["r"]:
        return None
    lo, width = edge["lo"], max(edge["hi"] - edge["lo"], 1e-9) / steps
    rows = (trained.groupBy(F.floor((F.col("score") - lo) / width).alias("bin"))
            .agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).collect())
    by_bin = {int(x["bin"]): (x["a"], x["r"]) for x in rows}
    passed, kept, best = 0, edge["r"], (math.inf, 0.0)
    costs = []
    for k in range(steps + 1):
        # threshold at the lower edge of bin k: accepted urls below it are lost
        costs.append((passed / edge["a"] + kept / edge["r"], k))
        a, r = by_bin.get(k, (0, 0))
        passed, kept = passed + a, kept - r
    least = min(c for c, _ in costs)
    at = [k for c, k in costs if c <= least + 1e-12]
    return lo + width * (at[0] + at[-1]) / 2


def filter_urls(pages: DataFrame, rules: list[Rule], order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row of ``pages``."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, decided = match_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumns({"rule": rule, "decided": decided,
                                "shape": shape(F.col("host"), F.col("path"))})
    shapes = judged.groupBy("shape").agg(
        F.count_if(F.col("decided") == "allow").alias("accepted"),
        F.count_if(F.col("decided") == "block").alias("rejected"))
    scores = shape_scores(shapes, order)
    threshold = calibrate(scores)
    model = (F.lit("allow") if threshold is None else
             F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return judged.join(scores.select("shape", "score"), "shape", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("decided", model).alias("verdict"), "score")
