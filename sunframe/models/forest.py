"""Random forests, one a step of the horizon. MLlib bins its inputs, so trees differ from those of other libraries."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunframe.sources.scratch import materialised


class ForestForecaster:
    """``predict`` adds ``forecast array<double>`` to framed samples."""

    def __init__(self, inputs: Sequence[str], models: Sequence[RandomForestRegressionModel]) -> None:
        self.inputs, self.models = list(inputs), list(models)

    @classmethod
    def fit(cls, train: DataFrame, inputs: Sequence[str], outputs: Sequence[str], settings: dict[str, Any]) -> ForestForecaster:
        """All steps are fitted at once from one assembled table, which a lost executor does not take along."""
        vectors = materialised(VectorAssembler(inputCols=list(inputs), outputCol="_x").transform(train).select("_x", *outputs), "forest")

        def one(y: str) -> RandomForestRegressionModel:
            rf = RandomForestRegressor(featuresCol="_x", labelCol=y, numTrees=settings["n_trees"], seed=settings["random_state"], maxDepth=settings["max_depth"], featureSubsetStrategy="all", bootstrap=settings["bootstrap"], predictionCol=f"_{y}")
            return rf.fit(vectors)

        with ThreadPoolExecutor(4) as pool:
            models = list(pool.map(one, outputs))
        return cls(inputs, models)

    def predict(self, df: DataFrame) -> DataFrame:
        out = VectorAssembler(inputCols=self.inputs, outputCol="_x").transform(df)
        for m in self.models:
            out = m.transform(out)
        made = [m.getPredictionCol() for m in self.models]
        return out.withColumn("forecast", F.array(*made)).drop("_x", *made)

    def save(self, path: str) -> None:
        for i, m in enumerate(self.models):
            m.write().overwrite().save(f"{path}/step-{i}")

    @classmethod
    def load(cls, path: str, inputs: Sequence[str], horizon: int) -> ForestForecaster:
        return cls(inputs, [RandomForestRegressionModel.load(f"{path}/step-{i}") for i in range(horizon)])
