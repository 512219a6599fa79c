"""Classification metrics over a table of (label, predicted, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlake.operators.ranking import running_totals


def accuracy_of() -> Column:
    return F.avg((F.col("predicted") == F.col("label")).cast("double"))


def f1_of() -> Column:
    """F1 of class 1; 0 when it has neither members nor predictions."""
    tp = F.count_if((F.col("predicted") == 1) & (F.col("label") == 1))
    wrong = F.count_if(F.col("predicted") != F.col("label"))
    return F.when(2 * tp + wrong == 0, 0.0).otherwise(2.0 * tp / (2 * tp + wrong))


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(accuracy_of().alias("accuracy"))


def f1(df: DataFrame) -> DataFrame:
    return df.agg(f1_of().alias("f1"))


def roc_auc(df: DataFrame) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows collapse to one per distinct score first; negatives below a score are a
    running total over ranges of scores.
    """
    per_score = df.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positive"),
        F.count_if(F.col("label") == 0).alias("negative"),
    )
    below = running_totals(per_score, "score", {"below": "negative"})
    won = F.sum(F.col("positive") * (F.col("below") + F.col("negative") / 2.0))
    return below.agg(
        F.try_divide(won, F.sum("positive").cast("double") * F.sum("negative")).alias("roc_auc")
    )


def evaluate(df: DataFrame) -> DataFrame:
    """accuracy, f1 and roc_auc in one row."""
    return df.agg(accuracy_of().alias("accuracy"), f1_of().alias("f1")).select(
        "accuracy", "f1", roc_auc(df).scalar().alias("roc_auc")
    )


def best_run(runs: DataFrame) -> DataFrame:
    """The vectorizer with the highest validation F1 of each dataset.

    ``runs`` has (dataset, vectorizer, method_order, split, metric, value); the
    earlier method wins a tie.
    """
    order = Window.partitionBy("dataset").orderBy(F.col("value").desc(), "method_order")
    return (
        runs.where((F.col("split") == "val") & (F.col("metric") == "f1"))
        .withColumn("place", F.row_number().over(order))
        .where("place = 1")
        .select("dataset", F.col("vectorizer").alias("best_method"), F.col("value").alias("best_val_f1"))
    )


def comparison_table(runs: DataFrame, split: str = "val") -> DataFrame:
    """dataset, vectorizer, f1, roc_auc, rounded to 4 places."""
    wide = (
        runs.where(F.col("split") == split)
        .groupBy("dataset", "vectorizer")
        .pivot("metric", ["f1", "roc_auc"])
        .agg(F.first("value"))
    )
    return wide.select(
        "dataset", "vectorizer", *[F.bround(F.col(m), 4).alias(m) for m in ("f1", "roc_auc")]
    )
