"""All registered queries of the corpus operators, with their SQL where there is any."""

import corpus_pipeline
from tidemark.llm import (  # noqa: F401
    chat_format,
    decontam,
    fertility,
    html_main,
    manifest,
    mixing,
    near_dedup,
    packing,
    pivot_clusters,
    recurrent_lm,
    rollups,
    url_ratio,
    weak_pii,
)
from tidemark.llm.common import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
