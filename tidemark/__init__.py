"""tidemark: price-stream statistics, trip regression and rare-event classification on Spark."""
