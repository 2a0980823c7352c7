"""Five stages from raw documents to a training mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns documents, which are written and read again
before the next one. ``doc_id`` names a document; a row without one is kept and judged like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, fertility, mixing, near_dedup, weak_pii
from tidemark.llm.common import materialise, table, text_of

# The tokenizer's verdicts and the mix's digests of ids cannot be written in SQL.
ORACLE_SQL = None


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The documents with all further columns in one, whose name no operator uses, and the way back."""
    usual = [c for c in docs.columns if c in COLUMNS]
    others = [c for c in docs.columns if c not in COLUMNS]
    packed = docs.select(*usual, F.struct(F.lit(0).alias("_0"), *[F.col(f"`{c}`") for c in others]).alias("_aside"))

    def back(df: DataFrame, *more: Column) -> DataFrame:
        return df.select(*[c if c in usual else F.col(f"_aside.`{c}`").alias(c) for c in docs.columns], *more)

    return packed, back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the fertility bands reject."""
    docs, back = _set_aside(docs)
    return back(fertility.judge_quality(docs, with_text=True).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Rows without an id are told apart by their texts. A row that repeats another, id and text, goes.
    """
    docs, back = _set_aside(docs)
    mark = F.xxhash64(text_of("text"), F.char_length(text_of("text")))
    named = docs.withColumn("_mark", mark).withColumn("_id", F.coalesce("doc_id", -F.abs(F.shiftright("_mark", 1)) - 1))
    decided = near_dedup.near_duplicates(named.select(F.col("_id").alias("doc_id"), "text"))
    kept = decided.where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return back(named.join(kept, "_id", "left_semi").dropDuplicates(["_id", "_mark"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies inside benchmark windows."""
    docs, back = _set_aside(docs)
    found, _ = decontam.hit_words(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return back(found.where(~decontam.contaminated()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; ``n_chars`` follows the text."""
    docs, back = _set_aside(docs)
    found = weak_pii.with_spans(docs, weak_pii.fit(docs))
    clean = found.withColumn("text", weak_pii.redact(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size("spans") > 0, count).otherwise(F.col("n_chars")))
    return back(clean)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy of a document that the mix takes, numbered in ``mix_copy``."""
    docs, back = _set_aside(docs)
    return back(mixing.take_copies(mixing.mix_sources(docs)), F.col("copy").alias("mix_copy"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("source_mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
