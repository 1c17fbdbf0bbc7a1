"""Softmax regression through MLlib, which trains on the executors."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def softmax_fit(df: DataFrame, vec: str, label: str, steps: int = 50, reg: float = 0.0, tol: float = 1e-6):
    data = df.select(array_to_vector(vec).alias("features"), F.col(label).cast("double").alias("label"))
    return LogisticRegression(family="multinomial", maxIter=steps, regParam=reg, tol=tol).fit(data)


def softmax_predict(model, df: DataFrame, vec: str) -> DataFrame:
    scored = model.transform(df.withColumn("features", array_to_vector(vec)))
    return scored.withColumn("prediction", F.col("prediction").cast("int")).drop("features", "rawPrediction", "probability")


def softmax_report(model, df: DataFrame, vec: str, label: str) -> DataFrame:
    """Accuracy of the fit next to the share of the most common label."""
    hits = softmax_predict(model, df, vec).groupBy(label).agg(
        F.count("*").alias("n"), F.sum((F.col("prediction") == F.col(label)).cast("int")).alias("ok")
    )
    return hits.agg((F.sum("ok") / F.sum("n")).alias("accuracy"), (F.max("n") / F.sum("n")).alias("majority"))


def softmax_balance(model, df: DataFrame, vec: str, label: str) -> DataFrame:
    """(label, n, expected): rows of each class next to the sum of its predicted probabilities."""
    scored = model.transform(df.withColumn("features", array_to_vector(vec)))
    sums = scored.select(F.posexplode(vector_to_array("probability")).alias("label", "p")).groupBy("label").agg(F.sum("p").alias("expected"))
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).join(sums, "label")
