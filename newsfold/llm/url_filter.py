"""URL verdicts by rules and, where no rule fits, by the ratio of two character language models.

Both models are smoothed Markov models of variable order: an address's next character is predicted from up to ``ORDER``
characters before it, each order mixed with the next shorter one in proportion to how often its context has met a new
character (Witten-Bell), down to a uniform distribution. One model is counted on all addresses that the rules allow,
the other on all that they block. An address is judged by the difference of its log-likelihoods per character against
a cut that is calibrated on the same labelled addresses. Column expressions, joins and aggregates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfold.llm.scratch import Scratch

#: (verdict, host, path prefix).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ORDER = 4
SYMBOLS = 256
#: Differences are told apart by so much when the cut is calibrated.
CUT_STEP = 0.01
#: At most so many scored character runs (about 40 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_RUNS = 500_000

START = "\u0002"


def address() -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr("url", "://")
    return F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)"))


def host_and_path(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``, both empty for a null url and one without ``://``."""
    rest = F.coalesce(address(), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.translate(host, upper, upper.lower())).withColumn("path", path)


def rule_of(rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as ``struct(rule, verdict)``; null where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda rule: len(rule[1] + rule[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def runs(addresses: DataFrame) -> DataFrame:
    """``address, allowed, run``: each character of an address with the ``ORDER`` before it."""
    padded = F.concat(F.lit(START * ORDER), F.col("address"))
    each = addresses.where("length(address) > 0").withColumn("padded", padded)
    at = F.explode(F.sequence(F.lit(1), F.length("address")))
    return each.select("address", "allowed", "padded", at.alias("at")).select(
        "address", "allowed", F.substring("padded", F.col("at"), F.lit(ORDER + 1)).alias("run")
    )


def ratios(counts: DataFrame) -> DataFrame:
    """``run, ratio``: the log of how much likelier the run's last character is among allowed addresses.

    ``counts`` has ``run, n_allow, n_block`` of every run that occurs in any address.
    """
    shorter = None
    for order in range(ORDER + 1):
        own = counts.groupBy(F.right("run", F.lit(order + 1)).alias("part")).agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
        context = Window.partitionBy(F.left("part", F.lit(order))) if order else None
        if order:
            sums = {side: (F.sum("n_" + side).over(context), F.sum((F.col("n_" + side) > 0).cast("bigint")).over(context)) for side in ("allow", "block")}
            own = own.select("*", *(value.alias(f"{kind}_{side}") for side, pair in sums.items() for kind, value in zip(("all", "kinds"), pair)))
            own = own.withColumn("tail", F.right("part", F.lit(order))).join(shorter, "tail")
        else:
            # All characters together: a row, not a window over everything.
            total = own.agg(*(f(s).alias(f"{kind}_{s[2:]}") for s in ("n_allow", "n_block") for kind, f in (("all", F.sum), ("kinds", lambda c: F.count_if(F.col(c) > 0)))))
            own = own.join(F.broadcast(total)).withColumns({"p_allow": F.lit(1.0 / SYMBOLS), "p_block": F.lit(1.0 / SYMBOLS)})
        mixed = []
        for side in ("allow", "block"):
            n, everything, kinds, less = (F.col(f"{name}_{side}") for name in ("n", "all", "kinds", "p"))
            mixed.append(F.when(everything > 0, (n + kinds * less) / (everything + kinds)).otherwise(less).alias(f"p_{side}"))
        shorter = own.select(F.col("part").alias("tail"), *mixed)
    return shorter.select(F.col("tail").alias("run"), (F.ln("p_allow") - F.ln("p_block")).alias("ratio"))


def scored(scratch: Scratch, addresses: DataFrame) -> DataFrame:
    """Add ``score``, the mean ratio over the characters of each (distinct) address; empty ones are left out."""
    split = runs(addresses)
    tallied = split.groupBy("run").agg(F.count_if(F.expr("allowed <=> true")).alias("n_allow"), F.count_if(F.expr("allowed <=> false")).alias("n_block"))
    model = scratch.keep(ratios(scratch.keep(tallied, "runs")), "ratios")
    if model.count() <= BROADCAST_RUNS:
        model = F.broadcast(model)
    return split.join(model, "run").groupBy("address").agg(F.first("allowed").alias("allowed"), F.avg("ratio").alias("score"))


def calibrated_cut(labelled: DataFrame) -> float:
    """The cut with the least sum of the two shares of labelled addresses on the wrong side; 0 without both labels.

    It lies in the middle between the neighbouring scores; of equally good gaps the lowest wins. The scores are counted
    by steps of ``CUT_STEP``, which are few however many addresses there are.
    """
    steps = labelled.groupBy(F.floor(F.col("score") / CUT_STEP).alias("step"))
    steps = steps.agg(F.count_if("allowed").alias("n_allow"), F.count_if(~F.col("allowed")).alias("n_block"))
    upto = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    wrong = F.coalesce(F.sum("n_allow").over(upto), F.lit(0)) / F.sum("n_allow").over(whole)
    right = F.coalesce(F.sum("n_block").over(upto), F.lit(0)) / F.sum("n_block").over(whole)
    gap = (F.lag("step").over(Window.orderBy("step")) + 1 + F.col("step")) / 2
    best = steps.select("step", F.coalesce(gap, F.col("step")).alias("middle"), F.sum("n_allow").over(whole).alias("a"), F.sum("n_block").over(whole).alias("b"), (right - wrong).alias("gain"))
    row = best.where("a > 0 AND b > 0").orderBy(F.desc(F.round("gain", 9)), "step").first()
    return float(row["middle"]) * CUT_STEP if row else 0.0


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row.

    Addresses are the part behind ``://`` and counted once each. A null url, one without ``://`` and one with nothing
    behind it have no score and are allowed, unless a rule fits. Repeated rows are judged each; other columns are
    ignored.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    found = host_and_path(pages.select("page_id", "url")).withColumn("address", address()).withColumn("found", rule_of(rules))
    addresses = found.select("address", (F.col("found.verdict") == "allow").alias("allowed")).where("address IS NOT NULL").distinct()
    scores = scratch.keep(scored(scratch, addresses), "scores")
    cut = calibrated_cut(scores.where("allowed IS NOT NULL"))
    by_model = F.when(F.col("score") < cut, "block").otherwise("allow")
    judged = found.join(scores.select("address", "score"), "address", "left")
    return judged.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", by_model).alias("verdict"), "score")
