"""A linear classifier of texts over hashed TF-IDF features, fitted and applied by Spark's own library.

Words are hashed into a fixed number of places, so the model's size does not
grow with the vocabulary. Weights come from gradients that are summed over all
labelled rows in a bounded number of rounds, and the penalty makes them unique.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES, ROUNDS, PENALTY = 10_000, 100, 0.01


def fit(labelled: DataFrame, words: Column, label: Column, places: int = PLACES, rounds: int = ROUNDS, penalty: float = PENALTY) -> PipelineModel:
    """The model of rows with a ``label`` of 0 or 1; rows without one are left out. Fails where no row has one."""
    rows = labelled.select(words.alias("words"), label.cast("double").alias("label")).where("label is not null").persist()
    try:
        return Pipeline(stages=[HashingTF(numFeatures=places, inputCol="words", outputCol="counts"), IDF(inputCol="counts", outputCol="features"), LogisticRegression(maxIter=rounds, regParam=penalty, tol=1e-10, standardization=False)]).fit(rows)
    finally:
        rows.unpersist()


def probabilities(model: PipelineModel, df: DataFrame, id_col: str, words: Column) -> DataFrame:
    """Rows (id, probability, predicted) of all of ``df``: the probability of label 1."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(words, F.expr("cast(array() as array<string>)")).alias("words"))
    p = vector_to_array(F.col("probability"))[1]
    return model.transform(rows).select("id", p.alias("probability"), (p > 0.5).cast("int").alias("predicted"))
