"""Raw table -> written train / val / test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlake.operators.prepare import dedup_text, require_min_rows, sample_frac, usable_rows
from textlake.operators.split import stratified_split
from textlake.session import materialize
from textlake.sources.raw_csv import read_raw
from textlake.sources.splits import write_splits
from textlake.specs import DatasetSpec, get_dataset


def prepare(
    raw: DataFrame,
    spec: DatasetSpec,
    fraction: float | None = None,
    test: float = 0.1,
    val: float = 0.1,
    seed: int = 42,
    mode: str = "exact",
) -> DataFrame:
    """Raw rows with doc_id -> (doc_id, text, label, split).

    Unique rows are written once; sampling and splitting then count on narrow
    columns of that table instead of repeating the deduplication.
    """
    unique = materialize(dedup_text(usable_rows(raw, spec)), "unique")
    rows = require_min_rows(sample_frac(unique, fraction, seed))
    return stratified_split(rows, test, val, seed, mode)


def prepare_dataset(
    spark: SparkSession, dataset: str, raw_path: str, out_path: str, **options
) -> None:
    """CSV of a named dataset -> splits on disk."""
    spec = get_dataset(dataset)
    raw = materialize(
        read_raw(spark, raw_path, spec).select("doc_id", spec.text_col, spec.label_col), "raw"
    )
    write_splits(prepare(raw, spec, **options), out_path)
