"""URL filter: host and path rules first, a character language-model ratio for the rest.

Urls that a rule accepts or rejects train two variable-order Markov models over the
characters of host and path, smoothed by Witten-Bell interpolation down to order 0 and a
uniform floor.  A url without a rule is judged by the difference of the two log-likelihoods
per character against a threshold calibrated on labelled urls held out of training.

Everything works on *distinct* strings: distinct host+path strings give windows of ORDER+1
characters, distinct windows give the counts of all lower orders, and probabilities are
computed once per distinct n-gram, order by order.  In these joins at most one row per
character of the alphabet meets on a key.  Only the last lookup, from strings to their
windows, has frequent keys; the window table is broadcast when it is small and the join
is otherwise split by Spark where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import maybe_broadcast, stored, unit_hash

#: (action, host and path); the path starts at the first slash.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 4
ALPHABET = 256.0
HELD_OUT = 0.2
SEED = "url-1"
BINS = 100  # threshold steps per unit of score
CLIP = 20
BROADCAST_WINDOWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of rule and action; the longest that fits wins, then the first listed."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def _windows(strings: DataFrame, order: int) -> DataFrame:
    """``string`` and each of its windows ``gram``: every character, and the end, with the
    ``order`` characters before it."""
    padded = F.concat(F.lit("\x02" * order), F.col("string"), F.lit("\x03"))
    starts = F.sequence(F.lit(1), F.length("string") + 1)
    return strings.withColumn("_padded", padded).withColumn("_at", F.explode(starts)).withColumn(
        "gram", F.col("_padded").substr(F.col("_at"), F.lit(order + 1))
    ).drop("_padded", "_at")


def _probabilities(windows: DataFrame, order: int, alphabet: float) -> DataFrame:
    """``gram, ratio``: log-probability of the window's last character given those before,
    accepted less rejected, for each distinct window (``gram, accepted, rejected``)."""
    below = None
    for k in range(order + 1):
        counts = windows.groupBy(F.expr(f"right(gram, {k + 1})").alias("gram")).agg(
            F.sum("accepted").alias("a"), F.sum("rejected").alias("r")
        )
        context = F.expr(f"left(gram, {k})")
        seen = counts.groupBy(context.alias("context")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"),
            F.sum((F.col("a") > 0).cast("int")).alias("ta"), F.sum((F.col("r") > 0).cast("int")).alias("tr"),
        )
        level = counts.join(seen, context == F.col("context"))
        if below is None:
            level = level.withColumns({"qa": F.lit(1.0 / alphabet), "qr": F.lit(1.0 / alphabet)})
        else:
            level = level.join(
                below.select(F.col("gram").alias("_shorter"), F.col("pa").alias("qa"), F.col("pr").alias("qr")),
                F.expr(f"right(gram, {k})") == F.col("_shorter"),
            )
        smooth = lambda n, total, kinds, lower: F.when(
            F.col(total) > 0, (F.col(n) + F.col(kinds) * F.col(lower)) / (F.col(total) + F.col(kinds))
        ).otherwise(F.col(lower))
        below = level.select("gram", smooth("a", "na", "ta", "qa").alias("pa"), smooth("r", "nr", "tr", "qr").alias("pr"))
    return below.select("gram", (F.ln("pa") - F.ln("pr")).alias("ratio"))


def _threshold(scored: DataFrame) -> DataFrame:
    """One row ``threshold``: half-way from the step with the best balanced accuracy over the
    held-out labelled urls (the lowest of equal ones) down to the score below it; 0 where
    either kind is missing.  Scores are counted by step first, so the window runs over a
    fixed number of rows at most."""
    step = F.floor(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.col("score"))) * BINS)
    bins = scored.groupBy(step.alias("step")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    balanced = (F.sum("a").over(whole) - F.coalesce(F.sum("a").over(below), F.lit(0))) / F.sum("a").over(whole) + F.coalesce(
        F.sum("r").over(below), F.lit(0)
    ) / F.sum("r").over(whole)
    both = (F.sum("a").over(whole) > 0) & (F.sum("r").over(whole) > 0)
    under = F.coalesce(F.lag("step").over(Window.orderBy("step")), F.col("step"))
    judged = bins.select("step", ((F.col("step") + under) / (2.0 * BINS)).alias("middle"), F.when(both, F.round(balanced, 9)).alias("quality"))
    best = judged.filter("quality is not null").agg(
        F.min(F.struct((-F.col("quality")).alias("q"), F.col("step").alias("s"), "middle")).alias("best")
    )
    return best.select(F.coalesce("best.middle", F.lit(0.0)).alias("threshold"))


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER,
    held_out: float = HELD_OUT, seed: str = SEED,
) -> DataFrame:
    """One row per page: ``<id>, host, path, rule, verdict, score``.

    ``score`` is the accepted-less-rejected log-likelihood per character of the url's host
    and path, rounded to 6 digits.

    * A null url, or one without ``://``, has empty host and path; it fits no rule and is
      scored as the empty string (its end character alone).
    * Repeated urls and ids give one row each; null ids stay.
    * Without labelled urls both models are uniform: every score is 0, the threshold 0,
      and urls without a rule are allowed.
    * An empty table gives an empty result; other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).select(
        "_id", "host", "path", F.concat("host", "path").alias("string"), "_rule"
    )
    strings = stored(
        rows.groupBy("string").agg(
            F.count(F.when(F.col("_rule.action") == "allow", 1)).alias("accepted"),
            F.count(F.when(F.col("_rule.action") == "block", 1)).alias("rejected"),
        ),
        "url-strings",
    )
    test = unit_hash(F.lit(seed), F.col("string")) < held_out
    training = lambda name: F.when(test, 0).otherwise(F.col(name)).alias(name)
    windows = (
        _windows(strings.select("string", training("accepted"), training("rejected")), order)
        .groupBy("gram")
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    )
    ratios = stored(_probabilities(stored(windows, "url-windows"), order, ALPHABET), "url-ratios")
    scores = stored(
        _windows(strings.select("string"), order)
        .join(maybe_broadcast(ratios, BROADCAST_WINDOWS), "gram")
        .groupBy("string")
        .agg(F.round(F.sum("ratio") / F.count(F.lit(1)), 6).alias("score")),
        "url-scores",
    )
    labelled = strings.filter(test & (F.col("accepted") + F.col("rejected") > 0))
    threshold = _threshold(scores.join(labelled, "string"))
    out = rows.join(scores, "string").crossJoin(F.broadcast(threshold))
    by_model = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    return out.select(
        F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.action"), by_model).alias("verdict"), "score",
    )
