"""URL rules and, for what they leave open, the likelihood ratio of two character models; SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.functions.joins import broadcast_if, is_small
from gridmend.llm.tables import saved

RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\u0002", "\u0003"
MODEL_ROWS, BINS = 2_000_000, 400


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``path``: both empty for a NULL url or one without ``://``."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def fitting(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, pattern in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first, so it comes last here
        host, slash, path = pattern.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def grams(url: Column, order: int) -> Column:
    """Every character of a url, and its end, after the ``order`` characters before it."""
    chars = F.split(F.concat(F.lit(START * order), F.coalesce(url, F.lit("")), F.lit(END)), "")
    n = F.size(chars) - order
    # All characters beside the next ones: cut once, where substrings at every place would each walk there.
    beside = F.slice(F.arrays_zip(*[F.slice(chars, F.lit(k + 1), F.size(chars)) for k in range(order + 1)]), F.lit(1), n)
    return F.transform(beside, lambda g: F.concat_ws("", *[g[str(k)] for k in range(order + 1)]))


def log_ratios(counts: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log P(last character | those before) of the accepted model less that of the rejected one.

    ``counts`` has (gram, good, bad). Each model mixes the orders 0 to ``order`` after Witten and Bell: a
    context seen n times with t different successors trusts its own counts by n / (n + t) and the next
    shorter context for the rest, down to a uniform choice of 256 characters. Contexts a model has not
    seen leave everything to the shorter one.
    """
    table = counts.select("gram", F.lit(1 / 256).alias("p_good"), F.lit(1 / 256).alias("p_bad"))
    for k in range(order + 1):
        tail = F.substring("gram", order + 1 - k, k + 1)
        own = counts.groupBy(tail.alias("tail")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        context = F.substring("tail", 1, k) if k else F.lit("")
        every = own.groupBy(context.alias("context")).agg(
            *[F.sum(c).alias(f"n_{c}") for c in ("good", "bad")], *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in ("good", "bad")]
        )
        known = own.withColumn("context", context).join(every, "context").drop("context")
        table = table.withColumn("tail", tail).join(known, "tail")
        for c in ("good", "bad"):
            mixed = (F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}"))
            table = table.withColumn(f"p_{c}", F.when(F.col(f"n_{c}") > 0, mixed).otherwise(F.col(f"p_{c}")))
        table = table.select("gram", "p_good", "p_bad")
    return table.select("gram", (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def best_threshold(scored: DataFrame) -> float:
    """The score, of ``BINS`` steps between -4 and 4, that best balances both errors on (score, verdict). An action."""
    step = F.least(F.greatest(F.floor((F.col("score") + 4) * BINS / 8), F.lit(0)), F.lit(BINS)).cast("int").alias("step")
    good = F.col("verdict") == "allow"
    bins = scored.groupBy(step).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    share = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0)) / F.greatest(F.sum(c).over(every), F.lit(1))
    ranked = bins.select("step", (share("bad", below) - share("good", below)).alias("gain"), F.sum("good").over(every).alias("g"), F.sum("bad").over(every).alias("b"))
    best = ranked.orderBy(F.desc("gain"), F.abs(F.col("step") - BINS / 2), "step").first()
    return 0.0 if best is None or not best["g"] or not best["b"] else best["step"] * 8 / BINS - 4


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, order: int = 4, fold: int = 5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page. Actions.

    The longest fitting rule decides. The urls that rules accept and reject train two character models of
    variable order; a url without a rule is allowed if its log-likelihood difference per character reaches
    a threshold calibrated on every ``fold``-th url (by hash) that a rule decides, which stay out of the
    training. Equal urls count as often as they occur. A NULL or empty url has the one character that
    ends it; without any decided urls all scores are 0 and the threshold too, which allows. Other columns
    are ignored.
    """
    rule, verdict = fitting(rules)
    parts = with_parts(pages.select("page_id", "url")).withColumns({"rule": rule, "verdict": verdict})
    held = F.crc32(F.coalesce("url", F.lit(""))) % fold == 0
    rows = saved(parts.withColumns({"held": held, "row": F.monotonically_increasing_id()}), "url-rows")
    spread = rows.select("row", "verdict", "held", F.explode(grams(F.col("url"), order)).alias("gram"))
    trains = ~F.col("held")
    counts = spread.groupBy("gram").agg(
        F.count_if(trains & (F.col("verdict") == "allow")).alias("good"), F.count_if(trains & (F.col("verdict") == "block")).alias("bad")
    )
    ratios = saved(log_ratios(saved(counts, "url-counts"), order), "url-ratios")
    # Equal grams gather on one key; the table of ratios is sent instead, while it is small.
    judged = spread.where(F.col("verdict").isNull() | F.col("held"))
    judged = judged.join(broadcast_if(is_small(ratios, MODEL_ROWS), ratios), "gram")
    scores = saved(judged.groupBy("row").agg(F.avg("ratio").alias("score")), "url-scores")
    scored = rows.join(scores, "row", "left")
    threshold = best_threshold(scored.where(F.col("held") & F.col("verdict").isNotNull()))
    own = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score")
