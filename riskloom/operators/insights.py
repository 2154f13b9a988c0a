"""Rule-based insight lines of the profile report (§2.4 insight_rows): the
one-row summaries (imbalance, correlation bands, issues, significant
features) are cross-joined — each side is exactly one row — and turned into
text rows with ``when``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: insight texts and thresholds
IMBALANCE_HIGH = 0.3
IMBALANCE_MEDIUM = 0.5
TEXT_IMBALANCE_HIGH = "HIGH CLASS IMBALANCE - use class_weight='balanced' or oversampling"
TEXT_IMBALANCE_MEDIUM = "MEDIUM CLASS IMBALANCE - standard methods can be used"
TEXT_IMBALANCE_LOW = "LOW CLASS IMBALANCE - the data is balanced"
TEXT_HIGH_CORR = "{n} features with HIGH correlation with the target"
TEXT_MEDIUM_CORR = "{n} features with MEDIUM correlation with the target"
TEXT_NO_CORR = "No feature with a substantial correlation - more feature engineering may be needed"
TEXT_ISSUES = "DATA ISSUES FOUND - preprocessing is required"
TEXT_NO_ISSUES = "The data is in good condition"
TEXT_SIGNIFICANT = "{n} features differ significantly between the classes"


def insight_rows(imbalance: DataFrame, bands: DataFrame, issues: DataFrame, significance: DataFrame) -> DataFrame:
    """(idx, insight) rows. Inputs: imbalance_ratio row, corr_bands rows,
    data_issues rows, feature_significance rows (with ``significant``)."""
    s = (imbalance.select("imbalance_ratio")
         .crossJoin(bands.agg(F.count_if(F.col("band") == "high").alias("n_high"),
                              F.count_if(F.col("band") == "medium").alias("n_medium")))
         .crossJoin(issues.agg(F.count(F.lit(1)).alias("n_issues")))
         .crossJoin(significance.agg(F.count_if(F.col("significant")).alias("n_significant"))))
    r = F.col("imbalance_ratio")
    hi, me = F.col("n_high"), F.col("n_medium")
    lines = [
        F.when(r < IMBALANCE_HIGH, F.lit(TEXT_IMBALANCE_HIGH)).when(r < IMBALANCE_MEDIUM, F.lit(TEXT_IMBALANCE_MEDIUM))
        .otherwise(F.lit(TEXT_IMBALANCE_LOW)),
        F.when(hi > 0, F.replace(F.lit(TEXT_HIGH_CORR), F.lit("{n}"), hi.cast("string"))),
        F.when(me > 0, F.replace(F.lit(TEXT_MEDIUM_CORR), F.lit("{n}"), me.cast("string"))),
        F.when((hi == 0) & (me == 0), F.lit(TEXT_NO_CORR)),
        F.when(F.col("n_issues") > 0, F.lit(TEXT_ISSUES)).otherwise(F.lit(TEXT_NO_ISSUES)),
        F.replace(F.lit(TEXT_SIGNIFICANT), F.lit("{n}"), F.col("n_significant").cast("string")),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("idx"), x.alias("insight")) for i, x in enumerate(lines)])
    return (s.select(F.explode(arr).alias("r")).select("r.*").filter(F.col("insight").isNotNull()))
