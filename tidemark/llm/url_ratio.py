"""URL filter: host rules first, then a ratio of two character language models.

Urls that a rule allows or blocks are the training text of two variable-order Markov models. A
character's probability after a context of k characters interpolates its share there with its
probability after the context's last k - 1 characters:

    p_k(c | x) = (n(x c) + S * p_(k-1)(c | x')) / (n(x) + S),    p_(-1) uniform over the characters

so rare contexts lean on shorter ones. A url's score is the mean over its characters of
log p_allow - log p_block. The cut is calibrated on the training urls: it lies between the mean
scores of both classes, as many deviations from one as from the other.

All counts are one table of distinct character windows with partial sums, so its size follows
the variety of the urls, not their number. Scores are made once per distinct url.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, materialise, query, table

RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ORDER = 4
SMOOTHING = 2.0
PAD = "\x02"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A to Z, and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), empty), F.coalesce(path, empty)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, both null if none does.

    A rule fits its host and all subdomains when the path starts with the rule's.
    """
    found = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(
            fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _mark(string: Column) -> Column:
    """128 bits that stand for a string where its characters are on their own."""
    return F.unhex(F.md5(string.cast("binary")))


def _windows(strings: DataFrame, order: int) -> DataFrame:
    """Each character of ``_string`` with the ``order`` before it, in ``gram``; starts are padded.

    The string itself stays behind: with it beside each character a long one would cost its square.
    """
    padded = F.concat(F.lit(PAD * order), F.col("_string"))
    # An array of one, so that the string is cut into characters once.
    grams = F.transform(
        F.array(F.split(padded, "")),
        lambda chars: F.transform(
            F.sequence(F.lit(1), F.size(chars) - order), lambda i: F.array_join(F.slice(chars, i, F.lit(order + 1)), "")
        ),
    )[0]
    kept = [c for c in strings.columns if c != "_string"]
    return strings.where(F.col("_string") != "").select(*kept, F.explode(grams).alias("gram"))


def gram_ratios(grams: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING) -> DataFrame:
    """``(gram, ratio)`` for each distinct ``gram`` of ``order + 1`` characters with counts ``n_allow`` and ``n_block``."""
    sums = [F.sum(c).alias(c) for c in ("n_allow", "n_block")]
    below = None
    for k in range(order + 1):
        level = grams.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(*sums)
        context = level.groupBy(F.left("gram", F.lit(k)).alias("_context")).agg(
            F.sum("n_allow").alias("_all_allow"), F.sum("n_block").alias("_all_block"), F.count("*").alias("_kinds")
        )
        level = level.withColumn("_context", F.left("gram", F.lit(k))).join(context, "_context")
        if below is None:
            level = level.withColumns({c: 1.0 / (F.col("_kinds") + 1) for c in ("_low_allow", "_low_block")})
        else:
            level = level.withColumn("_suffix", F.right("gram", F.lit(k))).join(below, "_suffix")
        p = {
            c: (F.col(f"n_{c}") + smoothing * F.col(f"_low_{c}")) / (F.col(f"_all_{c}") + smoothing)
            for c in ("allow", "block")
        }
        if k == order:
            return level.select("gram", (F.ln(p["allow"]) - F.ln(p["block"])).alias("ratio"))
        below = level.select(
            F.col("gram").alias("_suffix"), p["allow"].alias("_low_allow"), p["block"].alias("_low_block")
        )
    raise AssertionError("order is not negative")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    order: int = ORDER,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """The rows of ``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``score`` and ``cut``.

    Other columns pass through, but for columns of those names, which are replaced. A url without
    host and path has no characters to judge and no score: it is blocked, as nothing speaks for
    it. Where no url of a class is known the cut is 0. A score equal to the cut allows.
    """
    made = ("host", "path", "rule", "verdict", "score", "cut")
    host, path = host_path(F.col("url").cast("string"))
    rows = (
        pages.select(*[c for c in pages.columns if c not in made])
        .withColumns({"host": host, "path": path})
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .withColumn("_string", F.concat("host", "path"))
    )
    strings = rows.groupBy("_string").agg(
        F.count("*").alias("_n"), F.first(F.col("_rule.verdict")).alias("_label"), _mark(F.col("_string")).alias("_mark")
    )
    # The label follows from the string, as host and path do: the path starts at the first slash.
    counts = lambda label: F.sum(F.when(F.col("_label") == label, F.col("_n")).otherwise(0))
    grams = materialise(
        _windows(strings, order).groupBy("gram").agg(counts("allow").alias("n_allow"), counts("block").alias("n_block")),
        "url-grams",
    )
    scores = materialise(
        _windows(strings, order)
        .join(gram_ratios(grams, order, smoothing), "gram")
        .groupBy("_mark")
        .agg(F.avg("ratio").alias("score"), F.first("_n").alias("_n"), F.first("_label").alias("_label")),
        "url-scores",
    )
    known = {
        r["_label"]: (r["mean"], r["spread"])
        for r in scores.where(F.col("_label").isNotNull())
        .groupBy("_label")
        .agg(
            (F.sum(F.col("score") * F.col("_n")) / F.sum("_n")).alias("mean"), F.stddev_pop("score").alias("spread")
        )
        .collect()
    }
    return (
        rows.withColumn("_mark", _mark(F.col("_string")))
        .join(scores.select("_mark", "score"), "_mark", "left")
        .withColumn("cut", F.lit(calibrated_cut(known)))
        .withColumns(
            {
                "rule": F.col("_rule.rule"),
                "verdict": F.coalesce(
                    F.col("_rule.verdict"), F.when(F.col("score") >= F.col("cut"), "allow").otherwise("block")
                ),
            }
        )
        .drop("_rule", "_string", "_mark")
    )


def calibrated_cut(known: dict[str, tuple[float, float]]) -> float:
    """The score as many deviations above the mean of blocked urls as below that of allowed ones."""
    if not {"allow", "block"} <= set(known):
        return 0.0
    (high, wide), (low, narrow) = known["allow"], known["block"]
    return (high * narrow + low * wide) / (wide + narrow) if wide + narrow > 0 else (high + low) / 2


@query("op5_url_ratio")
def op5_url_ratio(spark, sf_dir):
    """Host, path, rule and verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))
