"""Scoring and searching over arriving requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from textlake.operators.estimators import score
from textlake.operators.search import SearchIndex, search_many

MAX_TOP_K = 100


def score_stream(requests: DataFrame, model: PipelineModel, dataset: str) -> DataFrame:
    """Texts -> label, sentiment, confidence. No state is kept; empty texts are rejected."""
    scored = score(requests.where(F.length("text") >= 1), model, "label")
    return scored.drop("score").withColumn("dataset", F.lit(dataset))


def search_stream(
    requests: DataFrame, index: SearchIndex, out_path: str, checkpoint: str, top_k: int = 10
) -> DataStreamWriter:
    """Search for (query_id, text[, top_k, sentiment]) rows as they arrive.

    A micro-batch is one batch search. Its hits go to a folder named after the
    batch, so a repeated batch replaces its own output.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        valid = batch.where(F.length("text") >= 1)
        if "top_k" in batch.columns:
            valid = valid.where(F.col("top_k").isNull() | F.col("top_k").between(1, MAX_TOP_K))
        search_many(valid, index, top_k).write.mode("overwrite").parquet(
            f"{out_path}/batch={batch_id}"
        )

    if not 1 <= top_k <= MAX_TOP_K:
        raise ValueError(f"top_k must be between 1 and {MAX_TOP_K}")
    return requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
