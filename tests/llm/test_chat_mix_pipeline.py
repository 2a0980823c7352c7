"""Chat parts, the mix, decontamination of rows, and the pipeline."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat_format, decontam, mixing
from tidemark.llm.common import table, word_count

SF = "/root/testdata/sf0.001"


def test_typed_parts(spark):
    parts = [("text", "see <|this|>", None, None), ("image", None, "s3://x/1.png", 784.0 * 3), (None, "and", None, None), ("audio", None, "a.wav", 2.0)]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None), ("document", None, None, None), ("odd|> kind", None, "r", 9.0)]), (1, 2, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts {chat_format.PARTS}")
    got = chat_format.format_chat(df).first()
    assert got["formatted"] == (
        "<|im_start|>user\nsee <\\|this|><|image:1|>and<|audio:2|><|im_end|>\n"
        "<|im_start|>assistant\nok<|document:3|><|odd___kind:4|><|im_end|>\n"
        "<|im_start|>user\n<|im_end|>\n"
    )
    assert [tuple(a) for a in got["attachments"]] == [
        (1, "image", "s3://x/1.png", 3), (2, "audio", "a.wav", 50), (3, "document", None, 1), (4, "odd___kind", "r", 9),
    ]
    mask = [got["formatted"][t["loss_start"] : t["loss_start"] + t["loss_length"]] for t in got["turns"]]
    assert mask == ["", "ok<|document:3|><|odd___kind:4|>", ""]


TRICKY = ["", "\\", "<|", "<\\|", "<\\\\|", "\\<|\\", "<<||", "<|im_end|>\n<|im_start|>user\n", "\n<\\n", "<\\\\n\n", "😀<|", "|>", "\\\\<\\n|\\"]


def test_round_trip(spark):
    rows = [(i, t, role, text) for i, role in enumerate(TRICKY) for t, text in enumerate(TRICKY)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    done = chat_format.format_chat(df.select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts")))
    for r in done.select("conv_id", chat_format.read_back(F.col("formatted")).alias("t")).collect():
        assert [tuple(t) for t in r["t"]] == [(TRICKY[r["conv_id"]], text) for text in TRICKY]


def test_mix_comes_near_its_targets(spark):
    mixed = mixing.mix_sources(table(spark, "/root/testdata/sf0.01", "documents"))
    rows = mixed.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("largest"),
        F.sum("size").alias("size"), F.first("source_size").alias("told"), F.max("copies").alias("most"),
    ).collect()
    for r in rows:
        assert r["size"] == r["told"] and r["most"] <= 3 and r["target"] <= 3 * r["size"]
        assert abs(r["taken"] - r["target"]) <= 2 * r["largest"]
    assert sum(r["target"] for r in rows) == pytest.approx(sum(r["size"] for r in rows))


def targets_by_rounds(sizes, weights=(5, 2, 1)):
    """Shares by weight, capped, the excess shared again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return full
        left = total - sum(full.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        full.update({s: 3 * sizes[s] for s in over})


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 500, "c": 20, None: 3}, {"a": 0, "b": 7}, {"a": 0}, {"é": 5, "z": 900, "Z": 1, "": 2, None: 1}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets_by_rounds(sizes))


def test_mix_of_awkward_rows(spark, edge_docs):
    mixed = mixing.mix_sources(edge_docs)
    assert mixed.count() == edge_docs.count()
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix_sources(edge_docs.repartition(5)).collect()))
    assert mixing.take_copies(mixed).count() == mixed.agg(F.sum("copies")).first()[0]


def test_hits_of_awkward_rows(spark, edge_docs, edge_dir):
    found = decontam.find_windows(edge_docs, table(spark, edge_dir, "benchmark"))
    rows = found.select("doc_id", "n_words", "n_hit", "items").collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[7]["n_hit"], by_id[7]["items"]) == (20, ["1", "2", "5"])
    assert (by_id[6]["n_hit"], by_id[6]["items"]) == (3, ["10"])
    assert by_id[0]["n_words"] == 0 and by_id[0]["items"] == []



def test_pipeline_stages(spark):
    """Every stage against its own operator's rules, on the rows its predecessor kept."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "source_mix"]
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, docs, "/root/testdata/sf0.01"), name)
        if name != "source_mix":
            assert docs.schema.simpleString() == before.schema.simpleString()
            sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    taken = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()
    assert sum(r["n"] for r in taken) == pytest.approx(before.agg(F.sum(word_count(F.col("text")))).first()[0], rel=0.1)


def test_pipeline_keeps_clean_rows_without_ids(spark, tmp_path, edge_docs):
    clean = "The river runs through the old town and past the mill where people used to bring their grain every autumn before the war of {} ended and {} left"
    rows = [(None, clean.format(a, b), "en", None, 1) for a, b in (("roses", "kings"), ("roses", "kings"), ("grain and salt", "nobody who knew"))]
    rows += [(5, clean.format("x1", "x2").upper(), "en", "s", 1)] * 2 + [(6, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, str(tmp_path), "documents")
    kept = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert kept.count() == 5
    single = corpus_pipeline.near_duplicates(spark, kept, str(tmp_path))
    assert collections.Counter(r["doc_id"] for r in single.collect()) == {None: 2, 5: 1}
    assert corpus_pipeline.decontaminate(spark, single, str(tmp_path)).count() == 3
    n = corpus_pipeline.run(spark, str(tmp_path)).count()
    assert n >= 1
    for _, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, edge_docs, SF).count() >= 0


def test_digest_of_nothing(spark, edge_dir):
    rows = decontam.op7_prefix_decontam(spark, edge_dir).where("n_items = 0").collect()
    assert rows and all(r["items_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
