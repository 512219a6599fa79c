"""The steps of a text classifier as pyspark.ml stages.

All fitted stages work row by row, so a fitted chain scores batches and streams
alike and keeps every other column of its input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, functions as F

from textlake.functions.grams import Vocabulary, by_slices, list_array, row_lengths
from textlake.operators import features
from textlake.operators.joins import dimension_join
from textlake.operators.lexical import with_tokens
from textlake.session import materialize
from textlake.specs import CleanConfig


class TextCleaner(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Text -> array of clean tokens, following a cleaning config.

    Lemmas come from a (term, lemma) table at ``lemmaPath``, written beforehand;
    without it the config must not ask for lemmas.
    """

    configJson = Param(Params._dummy(), "configJson", "cleaning switches", TypeConverters.toString)
    lemmaPath = Param(Params._dummy(), "lemmaPath", "lemma table", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="tokens", configJson=None, lemmaPath=""):
        super().__init__()
        self._setDefault(
            inputCol="text", outputCol="tokens", lemmaPath="",
            configJson=CleanConfig(lemmatize=False).to_json(),
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, cfg: CleanConfig, **params) -> TextCleaner:
        return cls(configJson=cfg.to_json(), **params)

    @property
    def config(self) -> CleanConfig:
        return CleanConfig.from_json(self.getOrDefault(self.configJson))

    def _transform(self, df: DataFrame) -> DataFrame:
        path, cfg = self.getOrDefault(self.lemmaPath), self.config
        if cfg.reduction == "lemma" and not path:
            raise ValueError("lemmatize needs lemmaPath")
        lemmas = df.sparkSession.read.parquet(path) if path else None
        made = with_tokens(df, cfg, self.getInputCol(), lemmas)
        return made.withColumnRenamed("tokens", self.getOutputCol())


class _VectorizerParams(HasInputCol, HasOutputCol):
    method = Param(Params._dummy(), "method", "bow, tfidf or bm25", TypeConverters.toString)
    minDf = Param(Params._dummy(), "minDf", "least documents per term", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "terms kept, 0 = all", TypeConverters.toInt)
    ngramLo = Param(Params._dummy(), "ngramLo", "shortest n-gram", TypeConverters.toInt)
    ngramHi = Param(Params._dummy(), "ngramHi", "longest n-gram", TypeConverters.toInt)
    k1 = Param(Params._dummy(), "k1", "BM25 saturation", TypeConverters.toFloat)
    b = Param(Params._dummy(), "b", "BM25 length share", TypeConverters.toFloat)

    def _defaults(self):
        self._setDefault(
            inputCol="tokens", outputCol="features", method="tfidf", minDf=2,
            maxFeatures=features.MAX_FEATURES, ngramLo=1, ngramHi=2, k1=1.5, b=0.75,
        )

    def _feature_tokens(self, df: DataFrame) -> DataFrame:
        column = self.getInputCol()
        return df.withColumn("_feature_tokens", features.feature_tokens(F.col(column), False))


class TextVectorizer(Estimator, _VectorizerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Token arrays -> sparse feature vectors; ``fit`` learns the vocabulary."""

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, method=None, minDf=None, maxFeatures=None,
        ngramLo=None, ngramHi=None, k1=None, b=None,
    ):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> TextVectorizerModel:
        rows = self._feature_tokens(df.select(self.getInputCol()))
        found = features.learn_vocabulary(
            rows, self.getOrDefault("ngramLo"), self.getOrDefault("ngramHi"), self.getOrDefault("minDf"),
            self.getOrDefault("maxFeatures") or None, "_feature_tokens",
        )
        vocab = materialize(found, "vocab")
        size, cf = vocab.agg(F.count("*"), F.sum("cf")).first()
        if not size:
            raise ValueError("no terms remain; lower minDf or supply more documents")
        n_docs = df.count()
        model = TextVectorizerModel(vocab, n_docs, cf / n_docs)
        return self._copyValues(model)


class TextVectorizerModel(Model, _VectorizerParams, MLWritable, MLReadable):
    """A vocabulary with the corpus size and mean document length."""

    def __init__(self, vocab: DataFrame | None = None, n_docs: int = 0, avgdl: float = 0.0):
        super().__init__()
        self._defaults()
        self.vocab, self.n_docs, self.avgdl = vocab, n_docs, avgdl
        self._terms = None

    def weights(self, df: DataFrame) -> DataFrame:
        """Long form (doc_id, term, term_idx, weight) for a table with doc_id."""
        rows = features.by_document(
            self._feature_tokens(df.select("doc_id", self.getInputCol())), "_feature_tokens"
        )
        counts = rows.select("doc_id", self._counts(df)("_feature_tokens").alias("c")).select("doc_id", "c.*")
        method, lists = self.getOrDefault("method"), F.arrays_zip("term_idx", "weight")
        if method == "bow":
            weighted = counts.select("doc_id", F.inline(F.arrays_zip("term_idx", F.col("tf").alias("weight"))))
        else:
            # Rows of one document share length and norm, as in the long form.
            counts = counts.withColumn("dl", features.per_document(F.col("total")))
            raw = counts.select("doc_id", "term_idx", self._raw(df)("term_idx", "tf", "dl").alias("r"))
            normed = raw.select(
                "doc_id", "term_idx", "r.raw", F.sqrt(features.per_document(F.col("r.square"))).alias("norm")
            )
            unit = F.transform("raw", lambda w: F.when(F.col("norm") > 0, w / F.col("norm")).otherwise(w))
            weighted = normed.withColumn("weight", unit).select("doc_id", F.inline(lists))
        terms = self.vocab.select("term", "term_idx")
        bound = self.getOrDefault("maxFeatures") or None
        return dimension_join(weighted, terms, "term_idx", "doc_id", max_rows=bound).select(
            "doc_id", "term", "term_idx", F.col("weight").cast("double").alias("weight")
        )

    def _loaded(self) -> tuple[Vocabulary, np.ndarray]:
        """Terms by index and their idf; at most maxFeatures rows."""
        if self._terms is None:
            rows = self.vocab.select("term", "df").orderBy("term_idx").toArrow()
            df = rows["df"].to_numpy().astype(float)
            if self.getOrDefault("method") == "tfidf":
                idf = np.log((1.0 + self.n_docs) / (1.0 + df)) + 1.0
            else:
                idf = np.log(1.0 + (self.n_docs - df + 0.5) / (df + 0.5))
            self._terms = Vocabulary(rows["term"].to_pylist()), idf
        return self._terms

    def _transform(self, df: DataFrame) -> DataFrame:
        vector = self._vectors(df)(features.feature_tokens(F.col(self.getInputCol()), False))
        return df.withColumn(self.getOutputCol(), vector).select(*df.columns, self.getOutputCol())

    def _rule(self):
        """(idf of the terms, their counts, length of their document) -> raw weights."""
        method, avgdl = self.getOrDefault("method"), self.avgdl
        k1, b = self.getOrDefault("k1"), self.getOrDefault("b")

        def raw(idf: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> np.ndarray:
            if method == "tfidf":
                return idf * (1.0 + np.log(tf))
            pull = k1 * (1.0 - b + b * (dl / (avgdl + 1e-9)))
            return idf * (tf * (k1 + 1.0) / (tf + pull))

        return raw

    def _counts(self, df: DataFrame):
        """Arrow function tokens -> (term_idx, tf, total)."""
        shared = df.sparkSession.sparkContext.broadcast(self._loaded())
        lo, hi = self.getOrDefault("ngramLo"), self.getOrDefault("ngramHi")

        def count(lists: pa.Array) -> pa.Array:
            n = len(lists)
            row, index, tf = shared.value[0].counts(lists, lo, hi)
            total = np.bincount(row, tf, n).astype(np.int64)
            columns = [list_array(row, n, pa.array(x, pa.int32())) for x in (index, tf)]
            return pa.StructArray.from_arrays([*columns, pa.array(total)], names=["term_idx", "tf", "total"])

        @F.arrow_udf("term_idx array<int>, tf array<int>, total long")
        def counts(lists: pa.Array) -> pa.Array:
            return by_slices(count, lists)

        return counts

    def _raw(self, df: DataFrame):
        """Arrow function (term_idx, tf, document length) -> (raw weights, sum of their squares)."""
        shared, rule = df.sparkSession.sparkContext.broadcast(self._loaded()), self._rule()

        @F.arrow_udf("raw array<double>, square double")
        def weigh(index: pa.Array, tf: pa.Array, dl: pa.Array) -> pa.Array:
            row = np.repeat(np.arange(len(index)), row_lengths(index))
            length = dl.to_numpy(zero_copy_only=False).astype(float)[row]
            raw = rule(shared.value[1][index.flatten().to_numpy()], tf.flatten().to_numpy().astype(float), length)
            square = np.bincount(row, raw * raw, len(index))
            return pa.StructArray.from_arrays(
                [list_array(row, len(index), pa.array(raw)), pa.array(square)], names=["raw", "square"]
            )

        return weigh

    def _vectors(self, df: DataFrame):
        """Arrow function tokens -> sparse vector, row by row."""
        shared = df.sparkSession.sparkContext.broadcast(self._loaded())
        plain, rule = self.getOrDefault("method") == "bow", self._rule()
        lo, hi = self.getOrDefault("ngramLo"), self.getOrDefault("ngramHi")

        def weigh(lists: pa.Array) -> pa.Array:
            vocabulary, idf = shared.value
            n = len(lists)
            row, index, tf = vocabulary.counts(lists, lo, hi)
            values = tf.astype(float)
            if not plain:
                raw = rule(idf[index], values, np.bincount(row, values, n)[row])
                norm = np.sqrt(np.bincount(row, raw * raw, n))
                values = raw / np.where(norm == 0, 1.0, norm)[row]
            return pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, vocabulary.size, np.int32)),
                    list_array(row, n, pa.array(index, pa.int32())), list_array(row, n, pa.array(values)),
                ],
                names=["type", "size", "indices", "values"],
            )

        @F.arrow_udf(VectorUDT())
        def vectors(lists: pa.Array) -> pa.Array:
            return by_slices(weigh, lists)

        return vectors

    def write(self) -> MLWriter:
        return _VectorizerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _VectorizerReader()


class _VectorizerWriter(MLWriter):
    def __init__(self, model: TextVectorizerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        state = {"nDocs": self.model.n_docs, "avgdl": self.model.avgdl}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"state": state})
        self.model.vocab.write.parquet(f"{path}/vocab")


class _VectorizerReader(MLReader):
    def load(self, path: str) -> TextVectorizerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        vocab = self.sparkSession.read.parquet(f"{path}/vocab")
        model = TextVectorizerModel(vocab, metadata["state"]["nDocs"], metadata["state"]["avgdl"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def vectorize(method: str, **params) -> TextVectorizer:
    """An unfitted vectorizer by name, case-insensitive."""
    if method.lower() not in features.METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {', '.join(features.METHODS)}")
    return TextVectorizer(method=method.lower(), **params)


def balanced_weight(df: DataFrame, label: str = "label") -> Column:
    """n / (2 * rows of the class), from one pass over the labels."""
    counts = df.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("positive")).alias("c")
    ).scalar()
    of_class = F.when(F.col(label) == 1, counts["positive"]).otherwise(counts["n"] - counts["positive"])
    return counts["n"] / (2.0 * of_class)


class BalancedLogisticRegression(
    Estimator, HasInputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable
):
    """L2 logistic regression with classes weighted to equal influence.

    ``C`` is the inverse penalty against the summed loss; MLlib penalises the mean
    loss, hence regParam = 1 / (C * sum of weights), and balanced weights sum to n.
    """

    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative improvement to stop at", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, labelCol=None, C=None, maxIter=None, tol=None):
        super().__init__()
        self._setDefault(inputCol="features", labelCol="label", C=1.0, maxIter=1000, tol=1e-6)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> LogisticRegressionModel:
        label, features_col = self.getLabelCol(), self.getInputCol()
        # Written once in even pieces: every iteration runs one task per piece, and a
        # lost executor re-reads vectors instead of cleaning texts again.
        rows = materialize(df.select(features_col, label).hint("rebalance"), "training")
        trainer = LogisticRegression(
            featuresCol=features_col, labelCol=label, weightCol="_weight",
            maxIter=self.getOrDefault("maxIter"), tol=self.getOrDefault("tol"),
            elasticNetParam=0.0, standardization=False,
            regParam=1.0 / (self.getOrDefault("C") * rows.count()),
        )
        return trainer.fit(rows.withColumn("_weight", balanced_weight(rows, label)))


# Class names.
SENTIMENTS = {0: "negative", 1: "positive"}


def decide(p: Column) -> tuple[Column, Column, Column]:
    """Probability of class 1 -> label, sentiment, confidence."""
    label = (p >= 0.5).cast("int")
    sentiment = F.when(p >= 0.5, SENTIMENTS[1]).otherwise(SENTIMENTS[0])
    return label, sentiment, F.when(p >= 0.5, p).otherwise(1.0 - p)


def score(df: DataFrame, model: Model, label_col: str = "predicted") -> DataFrame:
    """Add ``score``, the predicted label, sentiment and confidence."""
    made = model.transform(df).withColumn(
        "score", vector_to_array("probability")[1]
    )
    label, sentiment, confidence = decide(F.col("score"))
    return made.withColumns(
        {label_col: label, "sentiment": sentiment, "confidence": confidence}
    ).select(*df.columns, "score", label_col, "sentiment", "confidence")


def label_corpus(df: DataFrame, model: Model | None = None, true_labels: bool = False) -> DataFrame:
    """Add ``sentiment`` 0/1: predicted, or the true label without a model."""
    if model is None or true_labels:
        return df.withColumn("sentiment", F.col("label").cast("tinyint"))
    p = vector_to_array("probability")[1]
    return (
        model.transform(df).withColumn("sentiment", (p > 0.5).cast("tinyint"))
        .select(*df.columns, "sentiment")
    )
