"""Score bands and the model-free rule score, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import RISK_BAND_EDGES, RISK_BAND_LABELS_EN


def risk_level(p: Column, labels=RISK_BAND_LABELS_EN, edges=RISK_BAND_EDGES) -> Column:
    """p < 0.1 → labels[0], < 0.2 → [1], < 0.4 → [2], < 0.6 → [3], else [4].
    Pass ``schema.RISK_BAND_LABELS_RU`` for the source's Russian labels."""
    expr = F.when(p < F.lit(edges[0]), F.lit(labels[0]))
    for e, lab in zip(edges[1:], labels[1:-1]):
        expr = expr.when(p < F.lit(e), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def rule_score(pay0: Column, limit_bal: Column) -> Column:
    """Model-free default probability from PAY_0 and LIMIT_BAL."""
    return (F.when((pay0 <= 0) & (limit_bal > 100000), F.lit(0.05))
            .when((pay0 <= 1) & (limit_bal > 50000), F.lit(0.15))
            .when((pay0 >= 2) | (limit_bal < 20000), F.lit(0.75))
            .otherwise(F.lit(0.3)))
