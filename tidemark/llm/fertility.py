"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback cuts every word into pieces. Three figures per document:
characters per token, the share of tokens that are single fallback bytes, and the entropy of the
document's tokens in bits. Text in a language that the vocabulary
covers has figures in a known band; garbled encodings, symbol runs, random strings and loops fall outside.
Bands are given per language, else per the script most of the letters belong to, else a wide one.
Inside them the corpus sets narrower ones: characters per token may lie only so far from the median of
the documents of the same language or script and size, and entropy only so far below it.

Words are tokenised one by one, and the pieces of frequent words are remembered, so the cost is that
of the distinct words. Documents are measured once, row by row, and written; their figures alone are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, query, table, text_of
from tidemark.llm.shingles import WordHashes, window_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CACHE = 150_000
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Band:
    """What a document may measure: characters per token, byte share at most, bits of entropy at least."""

    low: float
    high: float
    byte_share: float = 0.15
    entropy: float = 3.0


# Latin-script languages take 1.5 to 8 characters a token in common vocabularies, others fewer.
LANGUAGE_BANDS = {
    "en": Band(1.4, 9.0),
    "de": Band(1.3, 9.0),
    "fr": Band(1.2, 9.0),
    "es": Band(1.2, 9.0),
}
SCRIPT_BANDS = {
    "latin": Band(1.1, 9.0),
    "cyrillic": Band(0.9, 6.0),
    "greek": Band(0.6, 5.0, byte_share=0.3),
    "other": Band(0.2, 9.0, byte_share=0.95),
}
# Below so many tokens the figures say little, and the bands are not applied.
LEAST_TOKENS = 30
# Distances from the median that the corpus allows, in those between the median and the quartile of that side.
# Chosen on the labels of sf0.1; the README has the rates. All sizes together vary in size too, so they take twice as many.
SPREAD, ALL_SIZES_SPREAD = 5.0, 10.0
# That distance at least, as a share of the median and in bits: copies of one text must not shut out others.
LEAST_STEP, LEAST_BITS = 0.01, 0.05
# Fewer different documents say nothing of their size, then of their language or script.
LEAST_DOCS = 30

_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, n_bytes long, entropy double"


class Pieces(dict):
    """Token ids of words, as bytes of 32-bit numbers. Emptied when it is full."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = self.model.encode(word.decode("utf-8"), num_threads=1)
        value = self[word] = np.array(ids, np.int32).tobytes()
        return value


def repeated_words(hashes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words inside runs of ``window`` words that are found twice or more, the first time included."""
    runs = window_hashes(hashes, window)
    if len(runs) < 2:
        return 0
    _, which, n = np.unique(runs, return_inverse=True, return_counts=True)
    again = n[which] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[: len(runs)] += again
    edge[window : window + len(runs)] -= again
    return int(np.count_nonzero(np.cumsum(edge)))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(text: bytes, hashes: WordHashes, pieces: Pieces) -> tuple:
    words = text.split()
    ids = np.frombuffer(b"".join(map(pieces.__getitem__, words)), np.int32)
    n_tokens = len(ids)
    entropy = 0.0
    n_bytes = 0
    if n_tokens:
        n = np.unique(ids, return_counts=True)[1]
        entropy = max(0.0, float(np.log2(n_tokens) - (n * np.log2(n)).sum() / n_tokens))
        n_bytes = int(pieces.is_byte[ids].sum())
    characters = len(text.decode("utf-8"))
    return (
        len(words),
        characters - (len(text) - len(text.translate(None, SPACES))),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicate_lines(text),
        repeated_words(hashes.of(words)) if len(words) > REPEAT_WINDOW else 0,
        n_tokens,
        n_bytes,
        entropy,
    )


def measured(docs: DataFrame, vocabulary: str = VOCABULARY, with_text: bool = False) -> DataFrame:
    """The rows of ``docs``, without ``text`` unless asked for, with the measures of each document."""
    names = [m.split()[0] for m in _MEASURES.split(", ")]
    own = [c for c in docs.columns if c not in names and (with_text or c != "text")]
    rows = docs.select(*own, text_of("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, pieces = WordHashes(), None
        for batch in batches:
            pieces = pieces or Pieces(vocabulary)
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            columns = list(zip(*[measure(t, hashes, pieces) for t in texts])) or [()] * len(names)
            kinds = [pa.int64()] * (len(names) - 1) + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(own))), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                [*own, *names],
            )

    schema = rows.drop("_text").schema
    for part in _MEASURES.split(", "):
        schema = schema.add(*part.split())
    return rows.mapInArrow(run, schema)


def script_of(text: Column) -> Column:
    """The script of most letters of the text."""
    n = {
        "latin": F.regexp_count(text, F.lit(r"[A-Za-zÀ-ɏ]")),
        "cyrillic": F.regexp_count(text, F.lit(r"[Ѐ-ӿ]")),
        "greek": F.regexp_count(text, F.lit(r"[Ͱ-Ͽ]")),
        "other": F.regexp_count(text, F.lit(r"[֐-퟿]")),
    }
    best = F.greatest(*n.values())
    out = F.lit("other")
    for name in ("greek", "cyrillic", "latin"):
        out = F.when((n[name] == best) & (best > 0), name).otherwise(out)
    return out


def _per_token() -> Column:
    return F.col("word_chars") / F.col("n_tokens")


def _in_band(band: Band) -> Column:
    share = F.col("n_bytes") / F.col("n_tokens")
    return _per_token().between(band.low, band.high) & (share <= band.byte_share) & (F.col("entropy") >= band.entropy)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def usual_figures(measures: DataFrame) -> DataFrame:
    """``(_band, _size, low, high, floor)``: what documents of a language or script may measure.

    ``_size`` is the power of two below the number of tokens, -1 for all sizes together. Documents that
    pass the base rules count, those with the same figures once. Figures are rounded before
    their quartiles are taken, so a group keeps a bounded number of them.
    """
    figures = ("_band", "_size", "n_words", "word_chars", "n_tokens", "entropy")
    quartiles = lambda c, digits: F.percentile(F.round(c, digits), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    found = (
        measures.where(~base_failed() & (F.col("n_tokens") >= LEAST_TOKENS))
        .select(*figures)
        .distinct()
        .withColumn("_size", F.explode(F.array("_size", F.lit(-1))))
        .groupBy("_band", "_size")
        .agg(F.count("*").alias("n"), quartiles(_per_token(), 3).alias("t"), quartiles(F.col("entropy"), 2).alias("e"))
        .where(F.col("n") >= LEAST_DOCS)
    )
    t, e = F.col("t"), F.col("e")
    spread = F.when(F.col("_size") < 0, ALL_SIZES_SPREAD).otherwise(SPREAD)
    return found.select(
        "_band",
        "_size",
        (t[1] - spread * F.greatest(t[1] - t[0], LEAST_STEP * t[1])).alias("low"),
        (t[1] + spread * F.greatest(t[2] - t[1], LEAST_STEP * t[1])).alias("high"),
        (e[1] - spread * F.greatest(e[1] - e[0], F.lit(LEAST_BITS))).alias("floor"),
    )


def _with_usual(measures: DataFrame) -> DataFrame:
    """The rows with ``_usual``: the figures of their size, else of their language or script, else null."""
    usual = usual_figures(measures)
    limits = F.struct("low", "high", "floor")
    own = usual.where("_size >= 0").select("_band", "_size", limits.alias("_own"))
    every = usual.where("_size < 0").select("_band", limits.alias("_every"))
    return (
        measures.join(F.broadcast(own), ["_band", "_size"], "left")
        .join(F.broadcast(every), "_band", "left")
        .withColumn("_usual", F.coalesce("_own", "_every"))
        .drop("_own", "_every")
    )


def judge_quality(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    languages: Mapping[str, Band] = LANGUAGE_BANDS,
    scripts: Mapping[str, Band] = SCRIPT_BANDS,
    with_text: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with the measures, ``base_failed`` and ``kept``; ``text`` only ``with_text``.

    A null text has no words; it fails, as any of fewer than 20 words. A null or unknown
    ``lang``, or a table without that column, takes the band of the text's script. Columns with
    the names of measures are replaced, others pass through. The measured rows are written at once.
    """
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.drop("base_failed", "kept").withColumn(
        "_band", F.when(language.isin(*languages), language).otherwise(script_of(text_of("text")))
    )
    fits = F.lit(True)
    for name, band in {**scripts, **languages}.items():
        fits = F.when(F.col("_band") == name, _in_band(band)).otherwise(fits)
    usual = _per_token().between(F.col("_usual.low"), F.col("_usual.high")) & (F.col("entropy") >= F.col("_usual.floor"))
    fits = fits & (F.col("_usual").isNull() | usual)
    fits = F.when(F.col("n_tokens") < LEAST_TOKENS, F.lit(True)).otherwise(fits)
    size = F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")
    measures = materialise(measured(rows, vocabulary, with_text).withColumn("_size", size), "fertility")
    order = [c for c in measures.columns if c not in ("_band", "_size")]
    return (
        _with_usual(measures)
        .select(*[F.col(f"`{c}`") for c in order], "_band", "_usual")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(False)))
        .drop("_band", "_usual")
    )


@query("op3_token_fertility")
def op3_token_fertility(spark, sf_dir):
    """Measures and verdict of every document."""
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_tokens",
        "n_bytes",
        F.round("entropy", 6).alias("entropy"),
    )
