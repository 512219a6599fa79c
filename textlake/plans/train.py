"""Training: one classifier over several feature methods, best one kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlake.operators import features
from textlake.operators.estimators import (
    BalancedLogisticRegression,
    TextCleaner,
    TextVectorizerModel,
    score,
    vectorize,
)
from textlake.operators.lexical import corpus_terms, noun_lemmas
from textlake.operators.metrics import best_run, evaluate
from textlake.session import materialize
from textlake.sources.models import save_model
from textlake.sources.runs import RUNS_SCHEMA, append_runs
from textlake.sources.splits import read_split
from textlake.specs import CleanConfig, get_dataset


class CleanOnce(Pipeline):
    """A pipeline whose first stage cleans texts; its tokens are written once for the later stages to learn from."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        cleaner, *learners = self.getStages()
        made = cleaner.transform(dataset)
        used = {p for s in learners for p in (s.getInputCol(), s.hasParam("labelCol") and s.getLabelCol())}
        tokens = materialize(made.select([c for c in made.columns if c in used]), "tokens")
        return PipelineModel([cleaner, *Pipeline(stages=learners).fit(tokens).stages])


def text_classifier(cfg: CleanConfig, method: str, lemma_path: str = "", **vectorizer) -> Pipeline:
    """Unfitted chain: clean, vectorize, classify."""
    return CleanOnce(
        stages=[
            TextCleaner.of(cfg, lemmaPath=lemma_path),
            vectorize(method, **vectorizer),
            BalancedLogisticRegression(),
        ]
    )


def write_lemmas(docs: DataFrame, cfg: CleanConfig, path: str, lexicon: DataFrame | None = None):
    """Write the (term, lemma) table a lemmatizing cleaner needs."""
    surface = TextCleaner.of(CleanConfig(**{**cfg.__dict__, "lemmatize": False, "stem": False}))
    terms = materialize(corpus_terms(surface.transform(docs)), "terms")
    words = terms.select(F.col("term").alias("lemma")) if lexicon is None else lexicon
    noun_lemmas(terms, words).write.mode("overwrite").parquet(path)


def sweep(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    cfg: CleanConfig,
    dataset: str = "dataset",
    methods: Sequence[str] = features.METHODS,
    max_features: int = features.MAX_FEATURES,
    min_df: int = 2,
    lemma_path: str = "",
    run_id: str = "run",
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Runs table and fitted chains, one per method.

    Texts are cleaned once. All methods share vocabulary, corpus size and mean
    length, so these are learned once too; only the weighting differs.
    """
    cleaner = TextCleaner.of(cfg, lemmaPath=lemma_path)
    clean = {
        name: materialize(cleaner.transform(part).select("doc_id", "label", "tokens"), name)
        for name, part in (("train", train), ("val", val), ("test", test))
    }
    fitted = vectorize(methods[0], maxFeatures=max_features, minDf=min_df).fit(clean["train"])
    rows, models = [], {}
    for order, method in enumerate(methods):
        vectorizer = TextVectorizerModel(fitted.vocab, fitted.n_docs, fitted.avgdl)
        fitted._copyValues(vectorizer)
        vectorizer.set(vectorizer.method, method)
        classifier = BalancedLogisticRegression().fit(vectorizer.transform(clean["train"]))
        chain = PipelineModel([vectorizer, classifier])
        for split in ("val", "test"):
            found = evaluate(score(clean[split].select("label", "tokens"), chain)).first()
            rows += [
                (run_id, dataset, method, order, fitted.n_docs, max_features, split, name, found[name])
                for name in ("accuracy", "f1", "roc_auc")
            ]
        models[method] = PipelineModel([cleaner, vectorizer, classifier])
    return train.sparkSession.createDataFrame(rows, RUNS_SCHEMA), models


def train_dataset(
    spark: SparkSession,
    dataset: str,
    splits_path: str,
    model_path: str,
    runs_path: str,
    methods: Sequence[str] = features.METHODS,
    max_features: int = features.MAX_FEATURES,
    lexicon: DataFrame | None = None,
    run_id: str = "run",
    **cleaning,
) -> DataFrame:
    """Sweep over prepared splits, save the best chain, append the runs."""
    cfg = get_dataset(dataset).clean_config(**cleaning)
    parts = [read_split(spark, splits_path, name) for name in ("train", "val", "test")]
    lemma_path = ""
    if cfg.reduction == "lemma":
        lemma_path = f"{model_path}-lemmas"
        write_lemmas(parts[0], cfg, lemma_path, lexicon)
    runs, models = sweep(
        *parts, cfg, dataset, methods, max_features, lemma_path=lemma_path, run_id=run_id
    )
    best = best_run(runs)
    save_model(models[best.first().best_method], model_path)
    append_runs(runs, runs_path)
    return best
