"""Stage 3: the linear quality model - its training, file, score and filter - and its evaluation."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.vectors import linear, sigmoid
from ..session import stored
from .sampling import cumulated, hash_order


@dataclass
class QualityModel:
    coef: list[float] = field(default_factory=list)
    intercept: float = 0.0
    embed_dim: int = 0
    threshold: float = DEFAULT.quality_threshold

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps(asdict(self)))

    @staticmethod
    def load(path: str) -> QualityModel | None:
        """None without a file: the stage is left out."""
        p = Path(path)
        return QualityModel(**json.loads(p.read_text())) if p.exists() else None


def score(emb: Column | str, model: QualityModel) -> Column:
    """The probability of quality, in doubles."""
    return sigmoid(linear(emb, model.coef, model.intercept))


def with_quality(df: DataFrame, emb: str, model: QualityModel | None) -> DataFrame:
    """df with quality_score, and low_quality iff it is under the threshold; null and false without a model."""
    q = F.lit(None).cast("double") if model is None else score(emb, model)
    x = df.withColumn("quality_score", q)
    return x.withColumn("low_quality", F.coalesce(F.col("quality_score") < (model.threshold if model else 0.0), F.lit(False)))


def binarised(labels: DataFrame, score_col: str = "edu_score") -> DataFrame:
    """labels with y: 1 for a score of 4 or 5, 0 for 1 or 2; 3, null and out of range drop out."""
    s = F.col(score_col)
    return labels.withColumn("y", F.when(s.between(4, 5), 1).when(s.between(1, 2), 0)).where("y is not null")


def train(df: DataFrame, emb: str, label: str = "y", max_iter: int = 1000) -> QualityModel:
    """Balanced, L2-regularised (C = 1) logistic regression. Raises ValueError for a single class."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    n = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}  # two rows
    if len(n) < 2:
        raise ValueError(f"training needs both classes, got {n}")
    total = sum(n.values())
    weight = F.when(F.col(label) == 1, total / (2 * n[1])).otherwise(total / (2 * n[0]))
    x = df.select(array_to_vector(F.transform(emb, lambda v: v.cast("double"))).alias("features"), F.col(label).cast("double").alias("label"), weight.alias("w"))
    lr = LogisticRegression(weightCol="w", regParam=1.0 / total, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-7)
    m = lr.fit(x)
    coef = [float(c) for c in m.coefficients]
    return QualityModel(coef, float(m.intercept), len(coef))


def auc(df: DataFrame, score_col: str, label: str = "y") -> DataFrame:
    """auc: the exact area under the ROC curve by rank sums, ties averaged; null with a single class.

    The classes are counted per distinct score first, so the cumulative sum runs over the scores."""
    by = df.groupBy(F.col(score_col).alias("s")).agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("p"), F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("n"))
    x = cumulated(by, "s", "n", "below")
    return x.agg(F.try_divide(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)), F.sum("p").cast("double") * F.sum("n")).alias("auc"))


def cross_validated(df: DataFrame, emb: str, key: str, folds: int = 5, label: str = "y") -> dict[str, float | list[float]]:
    """accuracy and auc of each fold, and their mean and standard deviation; the folds are by the hash of the
    key. A fold with a single class has no auc and is left out of its mean."""
    f = F.pmod(F.conv(F.substring(hash_order(key), 1, 8), 16, 10).cast("long"), F.lit(folds))
    x = stored(df.select(F.col(emb).alias("emb"), F.col(label).alias("y"), f.alias("_fold")), "folds")
    out: dict = {"accuracy": [], "auc": []}
    for k in range(folds):
        m = train(x.where(F.col("_fold") != k), "emb")
        held = x.where(F.col("_fold") == k).withColumn("_s", score("emb", m))
        out["accuracy"].append(held.agg(F.avg(((F.col("_s") >= m.threshold).cast("int") == F.col("y")).cast("double")).alias("a")).first()["a"])
        out["auc"].append(auc(held, "_s").first()["auc"])
    for name in ("accuracy", "auc"):
        have = [v for v in out[name] if v is not None]
        mean = sum(have) / len(have) if have else None
        out |= {f"{name}_mean": mean, f"{name}_std": (sum((v - mean) ** 2 for v in have) / len(have)) ** 0.5 if have else None}
    return out
