"""Raw CSV readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textlake.specs import AMAZON, SENTIMENT140, DatasetSpec

# Texts that a pandas reader takes for a missing value.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_marker_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_MARKERS), c)


def number_rows(df: DataFrame) -> DataFrame:
    """Add ``doc_id``: the place of each row of a file scan, by file name and then by position.

    A task reads a block of a file from front to back, so a row's place in its
    block is known on the spot. One pass counts the rows of each block; what comes
    before a block is then a running total over the blocks. So ids are the same
    however the files are cut and dealt to tasks.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # One row per block of a file: a block is some megabytes of input.
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("_file", "_block")
        .agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return (
        placed.join(blocks, ["_file", "_block"])
        .withColumn("doc_id", F.col("_before") + F.col("_row") - F.col("_first"))
        .select(*df.columns, "doc_id")
    )


def read_raw(
    spark: SparkSession, path: str, spec: DatasetSpec, pandas_na: bool = True
) -> DataFrame:
    """Rows of a raw CSV with a ``doc_id`` in reading order, files by name.

    Quoted fields may hold line breaks, so a file with a header is read unsplit;
    headerless files hold one record per line and split freely. Numbering reads the
    files twice; write the result to parquet before using it more than once.
    """
    # Both passes must parse alike, so neither leaves columns out.
    options = {"quote": '"', "escape": '"', "encoding": spec.encoding, "columnPruning": False}
    reader = spark.read.options(**options)
    if spec.columns:
        schema = ", ".join(f"`{name}` string" for name in spec.columns)
        df = reader.schema(schema).csv(path)
    else:
        df = reader.csv(path, header=spec.header, multiLine=True)
    df = number_rows(df)
    if pandas_na:
        df = df.withColumns(
            {name: missing_marker_to_null(F.col(name)) for name in (spec.text_col, spec.label_col)}
        )
    return df


def read_reviews(spark: SparkSession, path: str, pandas_na: bool = True) -> DataFrame:
    return read_raw(spark, path, AMAZON, pandas_na)


def read_tweets(spark: SparkSession, path: str, pandas_na: bool = True) -> DataFrame:
    return read_raw(spark, path, SENTIMENT140, pandas_na)
