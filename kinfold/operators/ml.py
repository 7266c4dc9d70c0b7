"""Estimators in the manner of pyspark.ml over the case-based operators."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .knn import metric_of
from .react import class_probabilities, neighbours, predict_continuous, predict_nominal
from .stats import score


class CaseModel(Model):
    """Cases, a metric and parameters. `transform` adds `prediction`, and `probability` (map by class) for nominals."""

    def __init__(self, cases: DataFrame, features: list[str], label: str, kind: str, k: int, dt: float, id_column: str):
        super().__init__()
        self.cases, self.features, self.label, self.kind = cases, features, label, kind
        self.k, self.dt, self.id_column = k, dt, id_column

    def _near(self, df: DataFrame) -> DataFrame:
        asked = df.select((-1 - F.col(self.id_column)).alias("id"), *self.features)
        cases = self.cases.select(F.col(self.id_column).alias("id"), *self.features, self.label)
        return neighbours(asked, cases, metric_of(cases, self.features), self.k, self.dt, carry=[self.label])

    def _transform(self, df: DataFrame) -> DataFrame:
        near = self._near(df)
        back = (-1 - F.col("query_id")).alias(self.id_column)
        if self.kind == "continuous":
            return df.join(predict_continuous(near, self.label, name="prediction").select(back, "prediction"), self.id_column, "left")
        got = predict_nominal(near, self.label, name="prediction").select(back, "prediction")
        return df.join(got, self.id_column, "left").join(self.predict_proba(df), self.id_column, "left")

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """(id, probability: map by class)."""
        p = class_probabilities(self._near(df), self.label)
        return p.groupBy((-1 - F.col("query_id")).alias(self.id_column)).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class", "probability")))).alias("probability"))

    def score(self, df: DataFrame) -> DataFrame:
        """(score): accuracy, or R2."""
        got = self._transform(df).select(F.col(self.label).alias("actual"), F.col("prediction").alias("predicted"))
        return score(got, self.kind)

    def partial_fit(self, df: DataFrame) -> CaseModel:
        return self._with(self.cases.unionByName(df, allowMissingColumns=True))

    def partial_unfit(self, ids: DataFrame) -> CaseModel:
        return self._with(self.cases.join(ids, self.id_column, "left_anti"))

    def feature_add(self, name: str, expression: str) -> CaseModel:
        return CaseModel(self.cases.withColumn(name, F.expr(expression)), [*self.features, name], self.label, self.kind, self.k, self.dt, self.id_column)

    def feature_remove(self, name: str) -> CaseModel:
        return CaseModel(self.cases.drop(name), [f for f in self.features if f != name], self.label, self.kind, self.k, self.dt, self.id_column)

    def _with(self, cases: DataFrame) -> CaseModel:
        return CaseModel(cases, self.features, self.label, self.kind, self.k, self.dt, self.id_column)


class _CaseEstimator(Estimator):
    kind = "continuous"

    def __init__(self, features: list[str], label: str, k: int = 10, dt: float = -1.0, id_column: str = "id"):
        super().__init__()
        self.features, self.label, self.k, self.dt, self.id_column = features, label, k, dt, id_column

    def _fit(self, df: DataFrame) -> CaseModel:
        return CaseModel(df, self.features, self.label, self.kind, self.k, self.dt, self.id_column)


class CaseRegressor(_CaseEstimator):
    kind = "continuous"


class CaseClassifier(_CaseEstimator):
    kind = "nominal"
