"""Regression tree with one candidate split per node and feature: the upper median of its distinct values.

The tree grows one level per round. Values are numbered once, and rows carry the numbers. Each round
finds which numbers every node has, takes the medians by radix descent over counted digits, and then sums
both sides of all thresholds in one aggregate per node. Rows never leave the executors.

Labels are summed as whole numbers with as many places as the largest label leaves room for, fifteen
digits in all. Sums are then independent of row order, and two features that split a node alike tie
exactly, which the lowest-feature rule needs. Rows with a null, NaN or infinite feature or label are left out
of a fit, as the trip tables leave them out.
"""

from __future__ import annotations

from functools import reduce
from math import floor, log10

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.ranks import DICTIONARY_ROWS, number_values, to_ranks, to_values
from tidemark.operators.tree_nodes import DEEPEST, ROOT, NodeTree, child_of, sized
from tidemark.session import ensure_checkpoint_dir, written

PLACES = 9
DIGITS = 15
# Rows of one group that a single sort may hold before its value range is narrowed further.
SORT_ROWS = 200_000
RANGE_BINS = 1024


def label_places(rows: DataFrame) -> int:
    """Decimal places that keep fifteen digits of the largest label."""
    largest = rows.agg(F.max(F.abs("label"))).first()[0] or 0.0
    return min(max(DIGITS - 1 - floor(log10(largest)), 0), 30) if largest > 0 else PLACES


def finite_rows(rows: DataFrame) -> DataFrame:
    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return rows.filter(finite(F.col("label")) & F.forall("features", finite))


def value_sums(rows: DataFrame, places: int = PLACES) -> DataFrame:
    """Label count and sum per (node, feature, value); repeated values collapse before the shuffle."""
    return (
        rows.select(
            "node",
            F.col("label").cast(f"decimal(38,{places})").alias("y"),
            F.posexplode("features").alias("feature", "value"),
        )
        .groupBy("node", "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    )


def median_splits(sums: DataFrame, groups_at_most: int, sort_rows: int = SORT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Split of every (node, feature) at the upper median of its distinct values, and node totals.

    The median is element ``count div 2`` (from 0) of the sorted values; single values give no
    split. Running sums along the same order give the left side at no further cost.

    A large group is never sorted whole. Its range is cut into equal bins, the bin that holds the
    wanted rank becomes the new range, the bins below it are added up, and this repeats until what
    is left fits one sort. Binning keeps order, so the result is exact. The end bins are for
    infinities and NaN alone, and a range is measured by its finite values, so every round cuts it.
    """
    key = ["node", "feature"]
    sum_type = sums.schema["s"].dataType
    number = F.when(F.abs("value") < float("inf"), F.col("value"))
    ensure_checkpoint_dir(sums.sparkSession)
    whole = (
        sums.groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.min(number).alias("finite_low"),
            F.max(number).alias("finite_high"),
            F.sum("n").alias("n_all"),
            F.sum("s").cast(sum_type).alias("s_all"),
        )
        .withColumn("rank", F.floor(F.col("size") / 2))
        .checkpoint()
    )
    totals = whole.filter(F.col("feature") == 0).select("node", F.col("n_all").alias("n_rows"), "s_all")
    ranges = whole.filter(F.col("size") >= 2).withColumns(
        {"n_below": F.lit(0).cast("long"), "s_below": F.lit(0).cast(sum_type)}
    )

    def inside() -> DataFrame:
        return sums.join(sized(ranges.drop("size"), groups_at_most), key).filter(
            F.col("value").between(F.col("low"), F.col("high"))
        )

    carried = [*key, "rank", "n_all", "s_all", "n_below", "s_below"]
    while (ranges.agg(F.max("size")).first()[0] or 0) > sort_rows:
        # Halves, as the width of a range may be beyond the largest number.
        inner = RANGE_BINS - 2
        low, high = (F.col(c).cast("double") / 2 for c in ("finite_low", "finite_high"))
        place = F.try_divide(F.col("value").cast("double") / 2 - low, high - low) * inner
        position = (
            F.when(F.col("value") == float("-inf"), 0)
            .when(F.col("value") >= float("inf"), RANGE_BINS - 1)
            .otherwise(1 + F.least(F.floor(F.coalesce(place, F.lit(0.0))), F.lit(inner - 1)))
        )
        ahead = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)

        def below(column: str) -> Column:
            return F.coalesce(F.sum(column).over(ahead), F.lit(0))

        bins = (
            inside()
            .withColumn("bin", position)
            .groupBy(*carried, "bin")
            .agg(
                F.count(F.lit(1)).alias("size"),
                F.min("value").alias("low"),
                F.max("value").alias("high"),
                F.min(number).alias("finite_low"),
                F.max(number).alias("finite_high"),
                F.sum("n").alias("n_bin"),
                F.sum("s").alias("s_bin"),
            )
            # At most RANGE_BINS rows per group.
            .withColumns({"before": below("size"), "n_before": below("n_bin"), "s_before": below("s_bin")})
        )
        ranges = (
            bins.filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("size")))
            .select(
                *key,
                "size",
                "low",
                "high",
                "finite_low",
                "finite_high",
                (F.col("rank") - F.col("before")).alias("rank"),
                "n_all",
                "s_all",
                (F.col("n_below") + F.col("n_before")).alias("n_below"),
                (F.col("s_below") + F.col("s_before")).cast(sum_type).alias("s_below"),
            )
            .checkpoint()
        )
    ordered = Window.partitionBy(*key).orderBy("value")
    up_to = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    splits = (
        inside()
        .withColumns(
            {
                "place": F.row_number().over(ordered),
                "n_left": F.col("n_below") + F.sum("n").over(up_to),
                "s_left": (F.col("s_below") + F.sum("s").over(up_to)).cast(sum_type),
            }
        )
        .filter(F.col("place") == F.col("rank") + 1)
        .select(*key, F.col("value").alias("threshold"), "n_all", "s_all", "n_left", "s_left")
    )
    return splits, totals


def split_gains(splits: DataFrame, allow_empty_child: bool = False) -> DataFrame:
    """Variance reduction of each (node, feature) split; ``<=`` goes left.

    By default a split must leave rows on both sides. ``allow_empty_child`` also keeps splits at
    the largest value, whose right child is empty and whose gain is 0.
    """
    sides = splits.withColumn("n_right", F.col("n_all") - F.col("n_left"))
    if not allow_empty_child:
        sides = sides.filter(F.col("n_right") > 0)
    gap = F.col("s_left").cast("double") / F.col("n_left") - F.try_divide(
        (F.col("s_all") - F.col("s_left")).cast("double"), F.col("n_right")
    )
    # Between-side variance: what the split removes from the label variance.
    share = F.col("n_left").cast("double") * F.col("n_right") / F.pow(F.col("n_all").cast("double"), 2)
    gain = F.when(F.col("n_right") == 0, 0.0).otherwise(share * gap * gap)
    return sides.select("node", "feature", "threshold", "n_left", "n_right", gain.alias("gain"))


def best_splits(gains: DataFrame) -> DataFrame:
    """Winner per node: largest gain, then lowest feature."""
    best = F.max_by(F.struct("feature", "threshold", "gain"), F.struct("gain", -F.col("feature"))).alias("best")
    return gains.groupBy("node").agg(best).select("node", "best.*")


def rank_words(rows: DataFrame) -> DataFrame:
    """``(node, feature, word, bits)``: which ranks a node's rows have, 64 to a word."""
    cells = rows.selectExpr("node", "posexplode(ranks) as (feature, rank)")
    cells = cells.selectExpr("node", "feature", "rank >> 6 as word", "1L << cast(rank & 63 as int) as bit")
    return cells.groupBy("node", "feature", "word").agg(F.expr("bit_or(bit) as bits"))


def median_ranks(words: DataFrame, last_word: int, digit_bits: int) -> DataFrame:
    """``(node, feature, threshold)``: the upper median of each group's distinct ranks; single ranks give none.

    Radix descent: the words of a group are counted by their leading digit, the digit that holds the wanted place
    becomes the prefix, and the next digit is counted inside it, down to one word and a bit in it. No window
    sees more rows of a group than a digit has values, however many values a feature has.
    """
    key = ["node", "feature"]
    group = "partition by node, feature"
    shift = 0
    while last_word >> shift >> digit_bits:
        shift += digit_bits
    words = words.selectExpr("*", "bit_count(bits) as n")
    found: DataFrame | None = None
    while True:
        near, kept = words, key
        if found is not None:
            near = words.join(found, key).filter(f"word >> {shift + digit_bits} = prefix")
            kept = [*key, "place"]
        counts = near.selectExpr(*kept, f"word >> {shift} as digit", "n", "bits")
        if shift:
            counts = counts.groupBy(*kept, "digit").agg(F.sum("n").alias("n"))
        counts = counts.selectExpr("*", f"sum(n) over ({group} order by digit rows unbounded preceding) as up_to")
        if found is None:
            counts = counts.selectExpr("*", f"sum(n) over ({group}) div 2 as place").filter("place >= 1")
        here = counts.filter("up_to - n <= place and place < up_to").withColumn("left", F.expr("place - up_to + n"))
        if not shift:
            # The set bit of the word that has so many set bits below it.
            bit = "get(filter(sequence(0, 63), i -> shiftright(bits, i) & 1L = 1L), cast(left as int))"
            return here.selectExpr(*key, f"cast(digit as bigint) * 64 + {bit} as threshold")
        found = here.selectExpr(*key, "digit as prefix", "left as place")
        shift -= digit_bits


def node_thresholds(medians: DataFrame, n_features: int) -> DataFrame:
    """One row per node with the thresholds of all features, null where a feature has none."""
    each = ", ".join(f"max(if(feature = {f}, threshold, null))" for f in range(n_features))
    return medians.groupBy("node").agg(F.expr(f"array({each}) as thresholds"))


# A label in whole units, in two parts whose sums stay exact in 64 bits.
_LOW_BITS = 25


def exact_labels(places: int) -> list[Column]:
    """``high`` and ``low``: the label in units of its last place, split so that both can be summed as they are."""
    units = F.round(F.col("label") * 10.0**places).cast("long")
    return [F.shiftright(units, _LOW_BITS).alias("high"), units.bitwiseAND((1 << _LOW_BITS) - 1).alias("low")]


def exact_sum() -> str:
    """Both sums of a group put together again."""
    return f"cast(high as decimal(28,0)) * {1 << _LOW_BITS} + low"


def side_sums(rows: DataFrame, thresholds: DataFrame | None, nodes_at_most: int, n_features: int) -> DataFrame:
    """``(node, feature, threshold, n, s)``: rows and label sum left of each threshold, and of the node itself as
    feature -1. Sums of a task are one row per node and feature."""
    cells = ["-1L"]
    if thresholds is not None:
        rows = rows.join(sized(thresholds, nodes_at_most), "node", "left")
        cells += [f"if(ranks[{f}] <= thresholds[{f}], thresholds[{f}], null)" for f in range(n_features)]
    return (
        rows.selectExpr("node", "high", "low", f"posexplode(array({', '.join(cells)})) as (at, threshold)")
        .filter("threshold is not null")
        .groupBy("node", "at", "threshold")
        .agg(F.expr("count(1) as n"), F.expr("sum(high) as high"), F.expr("sum(low) as low"))
        .selectExpr("node", "at - 1 as feature", "threshold", "n", f"{exact_sum()} as s")
    )


def _level(sums: DataFrame, depth: int, places: int, allow_empty: bool) -> DataFrame:
    """The nodes of a level ``(node, depth, n_rows, prediction, feature, threshold)``, thresholds as ranks."""
    nodes = sums.groupBy("node").agg(
        F.expr("max(if(feature < 0, n, null)) as n_rows"),
        F.expr("max(if(feature < 0, s, null)) as s_all"),
        F.expr("collect_list(if(feature >= 0, struct(feature, threshold, n, s), null)) as sides"),
    )
    # Between-side variance: what the split removes from the label variance. One side may be empty on request.
    gap = "cast(x.s as double) / x.n - cast(s_all - x.s as double) / (n_rows - x.n)"
    share = "cast(x.n as double) * (n_rows - x.n) / power(cast(n_rows as double), 2)"
    gain = f"if(x.n = n_rows, 0.0D, {share} * power({gap}, 2))"
    # Largest gain, then lowest feature.
    best = f"""array_max(transform(filter(sides, x -> {str(allow_empty).lower()} or x.n < n_rows),
        x -> struct({gain} as gain, -x.feature as place, x.threshold as threshold)))"""
    return nodes.selectExpr("*", f"{best} as best").selectExpr(
        "node",
        f"{depth} as depth",
        "n_rows",
        f"cast(s_all as double) / n_rows / {10.0**places!r}D as prediction",
        "-best.place as feature",
        "best.threshold as threshold",
    )


def fit_median_tree(
    rows: DataFrame,
    feature_names: list[str],
    max_depth: int,
    allow_empty_child: bool = False,
    sort_rows: int = SORT_ROWS,
    dictionary_rows: int = DICTIONARY_ROWS,
) -> NodeTree:
    """Grow a tree on ``(features array<double>, label)``, which should be persisted by the caller.

    Values are numbered once, and rows carry ranks from then on. A level shuffles two small tables: which
    ranks each node has, 64 to a word, and one row per node and task with the sums left of its thresholds.
    """
    if max_depth > DEEPEST:
        raise ValueError(f"trees go down to depth {DEEPEST}")
    ensure_checkpoint_dir(rows.sparkSession)
    rows, n_features = finite_rows(rows), len(feature_names)
    places = label_places(rows)
    dictionary = number_values(rows, n_features)
    if not any(dictionary.sizes):
        raise ValueError("no training rows")
    # Ranks of one group that a window may hold, as a power of two.
    digit_bits = max(1, min(sort_rows, 1 << 16).bit_length() - 1)
    last_word = (max(dictionary.sizes) - 1) >> 6
    current = to_ranks(rows.select("features", *exact_labels(places)), dictionary, dictionary_rows)
    current = current.withColumn("node", F.lit(ROOT).cast("long"))
    current = written(current, "ranked")
    levels, sizes = [], []
    for depth in range(max_depth + 1):
        thresholds = None
        if depth < max_depth:
            words = rank_words(current)
            medians = median_ranks(words.persist() if last_word >> digit_bits else words, last_word, digit_bits)
            thresholds = node_thresholds(medians, n_features)
        level = _level(side_sums(current, thresholds, 1 << depth, n_features), depth, places, allow_empty_child)
        levels.append(written(level, "level"))
        nodes, splits = levels[-1].agg(F.count(F.lit(1)), F.count("feature")).first()
        if depth < max_depth and last_word >> digit_bits:
            words.unpersist()
        sizes.append(nodes)
        if not splits:
            break
        chosen = levels[-1].filter(F.col("feature").isNotNull()).select("node", "feature", "threshold")
        child = child_of(F.col("node"), F.col("ranks")[F.col("feature")], F.col("threshold"))
        # Written, not kept: a plan never reaches back beyond one level.
        moved = current.join(sized(chosen, 1 << depth), "node").select("high", "low", "ranks", child.alias("node"))
        current = written(moved, "moved")
    nodes = written(to_values(reduce(DataFrame.unionByName, levels), dictionary, sum(sizes)), "tree")
    return NodeTree(list(feature_names), [nodes.filter(F.col("depth") == d) for d in range(len(levels))], sizes)
