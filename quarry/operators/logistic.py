"""Logistic regression for a few columns by Newton steps.

One step is one aggregation: the gradient and the upper half of the Hessian are sums over the rows, computed by Spark
in partial sums. The driver gets ``(d + 1) * (d + 4) / 2`` numbers for d columns and solves the system.
For wide vectors ``LogisticRegression`` (which never builds a Hessian) stays the operator to use.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_COLUMNS = 64


def _sum(terms: Sequence[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def score(cols: Sequence[str], weights: Sequence[float]) -> Column:
    """The linear score; ``weights`` starts with the intercept."""
    return _sum([F.lit(float(weights[0]))] + [F.col(c) * F.lit(float(w)) for c, w in zip(cols, weights[1:])])


def probability(cols: Sequence[str], weights: Sequence[float]) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score(cols, weights)))


def newton(rows: DataFrame, label: str, cols: Sequence[str], steps: int, penalty: float = 0.0) -> np.ndarray:
    """Intercept and weights after ``steps`` Newton steps from 0 on the summed log loss plus ``penalty / 2`` times the squared weights
    (not the intercept). ``rows`` should be a written table; rows with a null take no part. Without rows all weights are 0."""
    if len(cols) > MAX_COLUMNS:
        raise ValueError(f"{len(cols)} columns: more than {MAX_COLUMNS}")
    d = len(cols) + 1
    x = [F.lit(1.0), *[F.col(c) for c in cols]]
    whole = rows.select(label, *cols).dropna()
    ridge = np.diag([0.0] + [penalty] * len(cols))
    w = np.zeros(d)
    for _ in range(steps):
        p = probability(cols, w.tolist())
        bend = p * (F.lit(1.0) - p)
        sums = [F.sum((F.col(label) - p) * x[i]) for i in range(d)]
        sums += [F.sum(bend * x[i] * x[j]) for i in range(d) for j in range(i, d)]
        got = whole.agg(*[s.alias(f"s{n}") for n, s in enumerate(sums)]).first()
        if got[0] is None:
            break
        hessian, upper = np.zeros((d, d)), np.triu_indices(d)
        hessian[upper] = got[d:]
        hessian = hessian + np.triu(hessian, 1).T + ridge
        w = w + np.linalg.solve(hessian, np.array(got[:d]) - ridge @ w)
    return w
