"""Vector columns: binary codec, normalisation, dot products, the logistic function."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType

from .text import col


@F.pandas_udf(ArrayType(FloatType()))
def decode_f32(s: pd.Series) -> pd.Series:
    """Little-endian 32-bit floats of a binary; null for null or a broken length."""
    return s.map(lambda x: None if x is None or len(x) % 4 else np.frombuffer(x, "<f4"))


@F.pandas_udf(BinaryType())
def encode_f32(s: pd.Series) -> pd.Series:
    """The binary of an array of floats."""
    return s.map(lambda x: None if x is None else np.asarray(x, "<f4").tobytes())


def dot(x: Column | str, y: Column | str) -> Column:
    """Sum of products in doubles; null if either is null or the lengths differ."""
    x, y = col(x), col(y)
    total = F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(x) == F.size(y), total)


def norm(x: Column | str) -> Column:
    return F.sqrt(dot(x, x))


def cosine(x: Column | str, y: Column | str) -> Column:
    """Null if a vector is null or all zero."""
    return F.try_divide(dot(x, y), norm(x) * norm(y))


def is_vector(x: Column | str, dim: int) -> Column:
    """Exactly dim finite numbers that are not all zero."""
    x = col(x)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce((F.size(x) == dim) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def sigmoid(z: Column | str) -> Column:
    return 1 / (1 + F.exp(-col(z)))


def linear(x: Column | str, coef: list[float], intercept: float) -> Column:
    """coef . x + intercept."""
    return dot(x, F.array(*map(F.lit, coef))) + F.lit(intercept)
