"""A classifier of toxic texts, fitted on all labelled rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from passagecraft.functions.sizing import broadcast_if, stage
from passagecraft.functions.text import hash28, tokens

FEATURES, PENALTY, SPARSE, ROUNDS, FOLDS = 1 << 16, 1e-3, 0.5, 100, 4


def held_out(key: Column | str, folds: int = FOLDS) -> Column:
    """Whether a row is kept from fitting: one fold of ``folds``, by hash of its key."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.pmod(hash28(text), F.lit(folds)) == 0


def _cut(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_tokens", tokens(F.coalesce("text", F.lit(""))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", features: int = FEATURES, penalty: float = PENALTY, rounds: int = ROUNDS) -> PipelineModel:
    """Logistic regression on which hashed words a text holds, over every labelled row that is not held out.

    Half of the penalty is on absolute weights: few words tell, and most weights become 0.

    Each round sums gradients within tasks and then in a tree, so the driver sees one vector
    of ``features`` weights, and rows stay where they are; labelled rows are staged once, as
    features, for all rounds. Words are hashed by a fixed function and weights start at zero, so the
    model is the same on any partitioning but for rounding. Null labels are left out; a
    document labelled twice counts twice. Raises if no label is left or all are the same.
    """
    marks = labels.select("doc_id", F.col(label).cast("double").alias("label")).filter("label is not null")
    known = docs.select("doc_id", "text").filter(~held_out("doc_id")).join(broadcast_if(marks), "doc_id")
    hashing = HashingTF(inputCol="_tokens", outputCol="_features", numFeatures=features, binary=True)
    rows = stage(hashing.transform(_cut(known)).select("label", "_features"), "labelled")
    if rows.select("label").distinct().count() < 2:
        raise ValueError("labels of both kinds are needed")
    fitted = LogisticRegression(
        featuresCol="_features", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
        regParam=penalty, elasticNetParam=SPARSE, maxIter=rounds, tol=1e-8, standardization=False).fit(rows)
    return PipelineModel([hashing, fitted])


def score_toxicity(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """``doc_id, held_out, score``: how likely each text is toxic, in one narrow pass. A null text counts as an empty one."""
    told = model.transform(_cut(docs.select("doc_id", "text")))
    return told.select("doc_id", held_out("doc_id").alias("held_out"), vector_to_array("_probability").getItem(1).alias("score"))
