"""Systematic sampling of sources to target weights.

Every document of a source has the same expected number of copies, its source's target over its
source's size. Summed up along the source, in order of document size, those expectations form a
line; one random offset per source is added, and a document is taken once for every whole number
its piece of the line crosses. Neighbours on the line are alike in size, so the words taken from a
source miss its target by about one large document at most.

The prefix sum is a rank times a constant. Ranks come from counts per (source, size), then per
bucket of equal sizes, then from a row number inside a bucket, so that no task orders a source: a
hot source spreads over its sizes, and copies of one text over the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table, text_of, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"


def _digest(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def _fraction(digest: Column) -> Column:
    """The first 32 bits of a hex digest as a number from 0 up to 1."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source ``(source, source_size)`` its ``target``: shares by weight, none above the cap.

    Weights go to sources in code point order, null last, and repeat. With the sources in order of
    cap per weight, those before some point are at their cap and the others share the rest by
    weight; the first source that this share leaves below its cap is that point. One row per
    source is ordered in one task, never documents.
    """
    ranked = sizes.withColumn(
        "_n", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    ).withColumns(
        {
            "_weight": F.element_at(
                F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int")
            ),
            "_cap": (F.col("source_size") * max_copies).cast("double"),
        }
    )
    in_order = Window.orderBy(F.col("_cap") / F.col("_weight"), "_n")
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(everything)
    before = F.coalesce(
        F.sum("_cap").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    from_here = F.sum("_weight").over(in_order.rowsBetween(0, Window.unboundedFollowing))
    shared = ranked.withColumns({"_total": total, "_before": before, "_rest": from_here}).withColumns(
        {
            "_share": (F.col("_total") - F.col("_before")) / F.col("_rest"),
            "_order": F.row_number().over(in_order),
        }
    )
    fits = F.col("_share") * F.col("_weight") <= F.col("_cap")
    share = F.min_by(F.when(fits, F.col("_share")), F.when(fits, F.col("_order"))).over(everything)
    return shared.select(
        "source", "source_size", F.least("_cap", share * F.col("_weight")).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    Needs ``doc_id``, ``text`` and ``source``; other columns pass through, but for columns of the
    four names above, which are replaced. A null text has size 0. Null is a source of its own.
    Rows that share a doc_id count as separate documents. A source of size 0 has target 0 and no
    copies. The same rows give the same copies on every run.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    names = {"key": "_mix_key", "size": "_mix_size", "digest": "_mix_digest", "bucket": "_mix_bucket"}
    rows = docs.select(
        *own,
        F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source"))).alias(names["key"]),
        word_count(text_of("text")).alias(names["size"]),
        _digest(F.col("doc_id")).alias(names["digest"]),
    ).withColumn(names["bucket"], F.substring(names["digest"], 1, 3))
    key, size, bucket = names["key"], names["size"], names["bucket"]

    cells = rows.groupBy(key, size, bucket).agg(F.count("*").alias("_cell"), F.first("source").alias("_source"))
    of_size = cells.groupBy(key, size).agg(F.sum("_cell").alias("_of_size"), F.first("_source").alias("_source"))
    sources = of_size.groupBy(key).agg(
        F.sum(F.col(size) * F.col("_of_size")).alias("source_size"), F.first("_source").alias("source")
    )
    targets = source_targets(sources.select("source", "source_size"), weights, max_copies).select(
        F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source"))).alias(key),
        "source_size",
        "target",
    )
    before_size = F.sum("_of_size").over(
        Window.partitionBy(key).orderBy(size).rowsBetween(Window.unboundedPreceding, -1)
    )
    before_cell = F.sum("_cell").over(
        Window.partitionBy(key, size).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cells.select(key, size, bucket, F.coalesce(before_cell, F.lit(0)).alias("_before_cell"))
        .join(of_size.select(key, size, F.coalesce(before_size, F.lit(0)).alias("_before_size")), [key, size])
        .join(targets, key)
        .select(
            key, size, bucket, (F.col("_before_cell") + F.col("_before_size")).alias("_before"), "source_size", "target"
        )
    )
    rank = F.col("_before") + F.row_number().over(
        Window.partitionBy(key, size, bucket).orderBy(names["digest"], "doc_id")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _fraction(_digest(F.concat(F.lit(seed), F.col(key))))
    up_to = F.floor(F.col("_rank") * F.col("_rate") + F.col("_offset"))
    up_to_last = F.floor((F.col("_rank") - 1) * F.col("_rate") + F.col("_offset"))
    return (
        rows.join(starts, [key, size, bucket])
        .withColumns({"_rank": rank, "_rate": rate, "_offset": offset})
        .select(
            *own,
            F.col(size).alias("size"),
            "source_size",
            "target",
            F.least(up_to - up_to_last, F.ceil(F.col("_rate"))).cast("long").alias("copies"),
        )
    )


def take_copies(mixed: DataFrame) -> DataFrame:
    """One row per copy, numbered from 1 in ``copy``; documents without copies are gone."""
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))).where(
        F.col("copies") > 0
    )


SQL = r"""
with d as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5(coalesce(cast(doc_id as varchar), '')) as digest
  from documents),
s as (select source, sum(size) as source_size from d group by source),
w as (
  select source, source_size, (source_size * 3)::double as cap, n,
         case n % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight
  from (select *, row_number() over (order by source is null, source) - 1 as n from s)),
o as (
  select *, row_number() over (order by cap / weight, n) as place,
         sum(source_size::double) over () as total,
         coalesce(sum(cap) over (order by cap / weight, n rows between unbounded preceding and 1 preceding), 0) as used,
         sum(weight) over (order by cap / weight, n rows between current row and unbounded following) as rest
  from w),
h as (select *, (total - used) / rest as share from o),
f as (select share from h where share * weight <= cap order by place limit 1),
t as (
  select h.source, h.source_size, least(h.cap, f.share * h.weight) as target,
         ('0x' || substr(md5('mix' || coalesce('1' || h.source, '0')), 1, 8))::bigint / 4294967296.0::double as shift
  from h, f),
r as (
  select d.doc_id, d.size, t.source_size, t.target, t.shift,
         case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
         row_number() over (partition by d.source order by d.size, d.digest, d.doc_id) as place
  from d join t on d.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size::bigint as source_size, round(target, 6) as target,
       (least(floor(place * rate + shift) - floor((place - 1) * rate + shift), ceil(rate)) * size)::bigint as taken
from r
"""


@query("op8_systematic_mix", SQL)
def op8_systematic_mix(spark, sf_dir):
    """The mix of all documents: what each document's source should give and what is taken of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )
