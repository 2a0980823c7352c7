"""Benchmark decontamination by a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item, or all words of a shorter item. The
shingles of a window are its word pairs (its word, where it has one). A document that contains a
window contains each of its shingles, so one necessary prefix shingle, the rarest over all
documents, is enough to find every document that can. Shingles of the benchmark are counted in
the documents first; a window with a shingle that never occurs is gone. An occurrence of a
window's rarest shingle fixes where the window would start; it must start and end inside the
document. What is left is compared word by word.

Documents are never joined with windows but by rare shingles, and their texts are shuffled once, at
most, to meet their candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, materialise, query, table, text_of

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
BROADCAST_WINDOWS = 500_000


def alnum_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters and digits and of all characters beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(text), BREAK), "")


def _windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct ``(item, words)``: the windows of each item with a word; a null item id is ``''``."""
    n = F.size("_words")
    pieces = F.when(n > window, F.transform(
        F.sequence(F.lit(1), n - window + 1), lambda i: F.slice("_words", i, F.lit(window))
    )).otherwise(F.array("_words"))
    return (
        items.select(text_of("item_id").alias("item"), alnum_words(text_of("text")).alias("_words"))
        .where(n > 0)
        .select("item", F.explode(F.array_distinct(pieces)).alias("words"))
        .distinct()
    )


def _pair(words: Column, word: Column, i: Column) -> Column:
    return F.xxhash64(word, F.coalesce(F.get(words, i + 1), F.lit("")))


def hit_words(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, keep: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with ``n_words``, ``n_hit`` and ``_found``, the windows that occur; and ``(item, window)``.

    ``keep`` names the columns of ``docs`` to return, by default all. See :func:`find_windows`.
    """
    made = ("n_words", "n_hit", "n_items", "items", "_found")
    own = [c for c in docs.columns if c not in made and (keep is None or c in keep)]
    windows = materialise(
        _windows(items, window).withColumn("window", F.array_join("words", " ")), "bench-windows"
    )
    # Windows come from the benchmark alone. As many as this fit any task; more are joined by shuffles.
    small = windows.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    held = F.broadcast if small else (lambda df: df)
    distinct = windows.select("window", "words").distinct()
    single = windows.where(F.size("words") == 1).limit(1).count() > 0
    shingles = distinct.select(
        "window",
        F.size("words").alias("length"),
        F.posexplode(
            F.when(
                F.size("words") > 1,
                F.transform(F.slice("words", F.lit(1), F.size("words") - 1), lambda w, i: _pair(F.col("words"), w, i)),
            ).otherwise(F.transform("words", lambda w: F.xxhash64(w, F.lit(""))))
        ).alias("offset", "shingle"),
    )

    words = F.col("_words")
    of_doc = F.transform(words, lambda w, i: _pair(words, w, i))
    if single:
        # Words by themselves, at the same places behind the pairs.
        of_doc = F.concat(of_doc, F.transform(words, lambda w: F.xxhash64(w, F.lit(""))))
    occurring = materialise(
        docs.select("doc_id", alnum_words(text_of("text")).alias("_words"))
        .select("doc_id", F.size("_words").alias("n"), F.posexplode(of_doc).alias("at", "shingle"))
        .join(held(shingles.select("shingle").distinct()), "shingle"),
        "bench-shingles",
    )
    counts = occurring.groupBy("shingle").agg(F.count("*").alias("n"))
    prefix = (
        shingles.join(counts, "shingle", "left")
        .groupBy("window", "length")
        .agg(
            F.min(F.coalesce("n", F.lit(0))).alias("least"),
            F.min(F.struct("n", "offset", "shingle")).alias("rarest"),
        )
        .where(F.col("least") > 0)
        .select("window", "length", F.col("rarest.offset").alias("offset"), F.col("rarest.shingle").alias("shingle"))
    )
    start = F.col("at") % F.col("n") - F.col("offset")
    candidates = materialise(
        occurring.join(held(prefix), "shingle")
        .select("doc_id", start.alias("start"), "window", "length", "n")
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n")))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("start", "length", "window")).alias("_candidates")),
        "bench-candidates",
    ).withColumnRenamed("doc_id", "_candidate_id")

    true = F.filter(
        "_candidates",
        lambda c: F.array_join(F.slice("_words", c["start"] + 1, c["length"]), " ") == c["window"],
    )
    verified = (
        docs.select(*dict.fromkeys([*own, "doc_id", "text"]))
        .join(candidates.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_candidate_id")), "left")
        .withColumn("_words", alnum_words(text_of("text")))
        .withColumn("_true", F.coalesce(true, F.array().cast("array<struct<start:int,length:int,window:string>>")))
        .select(
            *own,
            F.size("_words").cast("long").alias("n_words"),
            _covered(F.col("_true")).alias("n_hit"),
            F.array_distinct(F.transform("_true", lambda c: c["window"])).alias("_found"),
        )
    )
    return verified, windows.select("item", "window")


def find_windows(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, keep: list[str] | None = None
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_hit``, ``n_items`` and ``items``.

    ``keep`` names the columns of ``docs`` to return, by default all. ``n_hit`` counts words
    inside any occurrence of any window, ``items`` has the ids, as sorted strings, of the items
    whose windows occur. Needs ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the items;
    columns of ``docs`` with the four names are replaced. Null and empty texts have no words.
    Repeated item ids count once, a null one as the empty string. Rows with one doc_id are
    searched each by itself.
    """
    return _with_items(*hit_words(docs, items, window, keep))


def _covered(spans: Column) -> Column:
    """Words inside the union of ``start``, ``length`` spans."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (s["start"] + s["length"]).alias("b"))))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reached"))
    return F.aggregate(
        ordered,
        none,
        lambda so_far, s: F.struct(
            (so_far["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], so_far["reached"]))).alias("n"),
            F.greatest(so_far["reached"], s["b"]).alias("reached"),
        ),
        lambda so_far: so_far["n"],
    )


def _with_items(verified: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows found replaced by the items they belong to; rows without any skip the join."""
    rows = materialise(verified.withColumn("_row", F.monotonically_increasing_id()), "bench-found")
    items = (
        rows.where(F.size("_found") > 0)
        .select("_row", F.explode("_found").alias("window"))
        .join(windows, "window")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return (
        rows.join(items, "_row", "left")
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("long"))
        .drop("_row", "_found")
    )


def contaminated() -> Column:
    """At least one word hit, and one word in twenty."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


SQL = r"""
with i as (
  select coalesce(cast(item_id as varchar), '') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
k as (
  select item, least(len(w), 13) as size, unnest(generate_series(1, greatest(len(w) - 12, 1))) as p, w from i where len(w) > 0),
win as (select distinct item, size, array_to_string(w[p:p + size - 1], ' ') as words from k),
d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
lens as (select distinct size from win),
dw as (
  select r, size, p, array_to_string(w[p:p + size - 1], ' ') as words
  from (select r, w, size, unnest(generate_series(1, len(w) - size + 1)) as p from d, lens where len(w) >= size)),
hit as (select dw.r, dw.size, dw.p, win.item from dw join win on dw.size = win.size and dw.words = win.words),
covered as (
  select r, count(distinct q) as n_hit
  from (select r, unnest(generate_series(p, p + size - 1)) as q from (select distinct r, size, p from hit)) group by r),
found as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from hit) group by r)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join covered using (r) left join found using (r)
"""


@query("op7_prefix_decontam", SQL)
def op7_prefix_decontam(spark, sf_dir):
    """Every document's words inside benchmark windows, and which items they come from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return find_windows(docs, items, keep=["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
