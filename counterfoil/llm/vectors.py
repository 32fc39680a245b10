"""Integer vectors: selection in Spark, exact distances in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import named

# Components beyond this count as this: with it, exact distances fit 64 bits.
LARGEST = 1 << 26
# Up to this, sums of squares of 64 components are exact in doubles.
EXACT = 1 << 20


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    odd = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, within +-LARGEST."""
    return F.transform(
        vector,
        lambda x: F.greatest(
            F.least(F.floor(x.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)
        ).cast("long"),
    )


def integer_vectors(
    rows: DataFrame, scale: int, size: int | None, id_col: str, vector_col: str, *others: str
) -> DataFrame:
    """Usable rows as vec_id, v (array of long) and the other columns.

    With `size`, only vectors with so many components are usable.
    """
    vector = named(vector_col).cast("array<double>")
    usable = finite(vector) if size is None else finite(vector) & (F.size(vector) == size)
    return rows.where(usable).select(
        named(id_col).cast("long").alias("vec_id"),
        integers(vector, scale).alias("v"),
        *(named(c).alias(c) for c in others),
    )


def matrix(column: pa.ListArray) -> np.ndarray:
    """A column of lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a from all rows of b, exact, as int64."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= EXACT:
        x, y = a.astype("f8"), b.astype("f8")
        whole = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
        return whole.astype("i8")
    out = np.zeros((len(a), len(b)), "i8")
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        out += gap * gap
    return out


def squared_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a from the same rows of b, exact, as int64."""
    gap = a.astype("i8") - b.astype("i8")
    return (gap * gap).sum(1)
