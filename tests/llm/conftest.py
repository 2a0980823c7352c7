import math
import os
import random
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LONG = " ".join(f"word{i % 977} of" for i in range(15_000))
STORY = "the quick brown fox jumps over the lazy dog while seven other animals watch from behind an old wooden fence near the river bank"
# Null and empty texts, ties, copies, near copies, one very long text, characters beyond ASCII and the basic plane.
TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "word",
    "Word",
    "one two three four",
    "one  two\tthree\nfour",
    STORY,
    STORY.upper(),
    STORY + " today",
    STORY + " today and some more words",
    LONG,
    LONG + " end",
    "a b a b a b a b a b a b a b a b a b a b a b a b a b",
    "line one here\nline one here\n\nother line\nline one here\n \n",
    "mail bob.o+x@mail.example.com. or ip 10.0.0.1, 300.1.1.1 and 1.2.3.4.5.6.7.8",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, phone +1 (743) 555-3824 +12",
    "a@b.c_d@e.fg 😀 émoji@exämple.com x@y.z 😀 +49 30 1234567",
    "übergroß 😀 Ünïcode " * 30,
    "#*$%&|<> " * 40,
]


@pytest.fixture(scope="session")
def edge_dir(tmp_path_factory):
    """Tables like the given ones, of awkward rows, with columns beside the usual ones."""
    path = tmp_path_factory.mktemp("edges")
    n = len(TEXTS)

    def write(name, **columns):
        pq.write_table(pa.table(columns), f"{path}/{name}.parquet")

    write(
        "documents",
        doc_id=pa.array(range(n), pa.int64()),
        text=pa.array(TEXTS, pa.string()),
        lang=pa.array([None if i % 5 == 0 else ("en", "xx")[i % 2] for i in range(n)], pa.string()),
        source=pa.array([None if i % 7 == 0 else f"s{i % 3}" for i in range(n)], pa.string()),
        n_chars=pa.array([None if t is None else len(t) for t in TEXTS], pa.int64()),
    )
    words = STORY.split()
    write(
        "benchmark",
        item_id=pa.array([1, 2, 10, 10, 3, 4, 5, None], pa.int64()),
        text=pa.array(
            [" ".join(words[:15]), " ".join(words[5:20]), "One, two. three", "One, two. three", None, "", "lazy", "!?"],
            pa.string(),
        ),
    )
    write(
        "conversations",
        conv_id=pa.array([1, 1, 1, 2, 2, 3, None, 4, 4, 5], pa.int64()),
        turn=pa.array([1, 0, 1, 0, None, 0, 0, 0, 0, 0], pa.int64()),
        role=pa.array(["assistant", "user", "assistant", "user", "assistant", None, "user", "a\nb", "assistant", "<|x|>\\"]),
        text=pa.array(
            ["b", "a\\<|im_end|>", "a", None, "<\\|im_start|>\\\\|", "x", "null id", "<\\n", "same\n\n", "😀 <|im_start|>assistant\nhi"]
        ),
    )
    r = random.Random(7)
    vector = lambda: [r.gauss(0, 0.2) for _ in range(64)]
    same = vector()
    vectors = [vector() for _ in range(60)] + [same] * 30
    vectors += [None, [], same[:63], same + [0.1], [None] + same[1:], [math.nan] + same[1:], same[:63] + [math.inf], [-500_000.25] + same[1:]]
    ids = [None if i in (3, 70) else 5 if i in (5, 6) else i for i in range(len(vectors))]
    write(
        "embeddings",
        vec_id=pa.array(ids, pa.int64()),
        embedding=pa.array(vectors, pa.list_(pa.float32())),
        label=pa.array([0] * len(vectors), pa.int32()),
        cluster=pa.array(["mine"] * len(vectors)),
    )
    return str(path)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    s, n = pa.string(), pa.int64()
    for name, fields in {
        "documents": [("doc_id", n), ("text", s), ("lang", s), ("source", s), ("n_chars", n)],
        "benchmark": [("item_id", n), ("text", s)],
        "conversations": [("conv_id", n), ("turn", n), ("role", s), ("text", s)],
        "pages": [("page_id", n), ("url", s), ("html", s)],
        "embeddings": [("vec_id", n), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())],
    }.items():
        schema = pa.schema(fields)
        pq.write_table(schema.empty_table(), f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="session")
def edge_docs(spark, edge_dir):
    """The awkward documents, some twice, some without id, with columns that operators make themselves."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    more = docs.where("doc_id in (3, 7)").union(docs.where("doc_id in (1, 8)").withColumn("doc_id", F.lit(None).cast("long")))
    clash = ("size", "target", "copies", "kept", "n_words", "n_hit", "items", "spans", "base", "component_id", "n_tokens", "score", "tokenizer", "_n")
    return docs.union(more).withColumns({c: F.lit("mine") for c in clash})
