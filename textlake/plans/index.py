"""Prepared splits -> search index on disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from textlake.operators.estimators import label_corpus
from textlake.operators.prepare import limit_docs, union_splits
from textlake.operators.search import build_search_index
from textlake.session import materialize
from textlake.sources.index import write_index
from textlake.sources.splits import SPLITS, read_split
from textlake.specs import get_dataset


def index_corpus(
    parts: list[DataFrame],
    model: PipelineModel | None = None,
    true_labels: bool = False,
    max_docs: int | None = None,
) -> DataFrame:
    """Splits -> unique documents with a sentiment."""
    corpus = union_splits([part.select("doc_id", "text", "label") for part in parts])
    if max_docs:
        corpus = limit_docs(materialize(corpus, "corpus"), max_docs)
    return label_corpus(corpus, model, true_labels)


def build_index(
    spark: SparkSession,
    dataset: str,
    splits_path: str,
    index_path: str,
    model: PipelineModel | None = None,
    true_labels: bool = False,
    max_docs: int | None = None,
    lexicon: DataFrame | None = None,
    **cleaning,
) -> None:
    cfg = get_dataset(dataset).clean_config(**cleaning)
    parts = [read_split(spark, splits_path, name) for name in SPLITS]
    corpus = materialize(index_corpus(parts, model, true_labels, max_docs), "corpus")
    write_index(build_search_index(corpus, cfg, lexicon), index_path)
