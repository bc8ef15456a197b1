"""A labelled sample of bounded size, and a linear SVM by dual coordinate descent."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(text, label)`` of at most ``per_class`` label rows of each class that
    satisfy ``learn`` (a condition on the labels' id), chosen by a hash of the
    id.  The chosen labels are broadcast: their number is the bound."""
    rows = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"), learn.alias("ok"))
    picked = [rows.where(F.col("ok") & (F.col("label") == y)).select("__id", "label")
              .orderBy(F.xxhash64("__id"), "__id").limit(per_class) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    texts = docs.select(F.col(id_col).alias("__d"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("__d") == F.col("__id")).select("text", "label")


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                            c: np.ndarray, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of the L2-regularised hinge loss.  ``rows`` are (indices,
    values), ``y`` is -1 or 1 and ``c`` the upper bound of each dual variable."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norm = np.array([float(v @ v) for _, v in rows])
    active, rng = np.flatnonzero(norm > 0), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(active):
            idx, val = rows[i]
            grad = y[i] * float(w[idx] @ val) - 1.0
            a = alpha[i]
            new = min(max(a - grad / norm[i], 0.0), c[i])
            if new != a:
                w[idx] += (new - a) * y[i] * val
                alpha[i] = new
                moved = max(moved, abs(new - a))
        if moved < 1e-3:
            break
    return w
