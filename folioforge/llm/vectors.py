"""What the two operators on embeddings share: valid vectors, and cells of bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def marked(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v, ok): v as floats if they were, else as doubles; ok where the id and the vector are whole, finite and not zero."""
    kind = vectors.schema[vec_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col(vec_col).cast("array<float>" if single else "array<double>")
    whole = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col(id_col).isNotNull() & F.coalesce(whole, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), ok.alias("ok"))


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the rows that marked() finds ok."""
    return marked(vectors, id_col, vec_col).where("ok").select("vec_id", "v")


def stack(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def blocks(size: Column, most: int) -> Column:
    """In how many blocks of about `most` rows a group of `size` is dealt."""
    return F.ceil(size / F.lit(float(most))).cast("int")
