"""Column groups, table schemas and fixed values of the credit data model.

The values under "fixed values" must equal the source behaviour for results to
match; they are stated plainly and together.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# fixed values (column names, rule sets, thresholds, labels)
# ---------------------------------------------------------------------------
PAY = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL = ["BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6"]
PAMT = ["PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6"]

RAW_LABEL = "default.payment.next.month"
LABEL = "is_default"
TARGET_CANDIDATES = ["default.payment.next.month", "default", "target", "y", "Default"]

PROCESSED_COLUMNS = (["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
                     + PAY + BILL + PAMT + [LABEL])

CREATED_NUMERIC = [
    "PAYMENT_MEAN", "PAYMENT_MAX_DELAY", "PAYMENT_MIN_DELAY", "PAYMENT_STD",
    "PAYMENT_DELAY_COUNT", "PAYMENT_SEVERITY",
    "BILL_AMT_MEAN", "BILL_AMT_STD", "BILL_AMT_MAX", "BILL_AMT_MIN",
    "BILL_AMT_TO_LIMIT_RATIO", "BILL_AMT_UTILIZATION",
    "PAY_AMT_MEAN", "PAY_AMT_SUM", "PAY_AMT_STD", "PAY_AMT_MAX",
    "PAYMENT_TO_BILL_RATIO", "PAYMENT_TO_LIMIT_RATIO",
    "LIMIT_BAL_PER_AGE", "LIMIT_BAL_LOG",
    "RISK_SCORE_1", "CRITICAL_DEBT",
]
CREATED_CATEGORICAL = ["AGE_GROUP"]
INT_FEATURES = {"PAYMENT_MAX_DELAY", "PAYMENT_MIN_DELAY", "PAYMENT_DELAY_COUNT",
                "PAYMENT_SEVERITY", "CRITICAL_DEBT"}

# features needed at scoring time (the serving subset)
SERVING_FEATURES = [
    "PAYMENT_MEAN", "PAYMENT_MAX_DELAY", "PAYMENT_DELAY_COUNT", "PAYMENT_SEVERITY",
    "BILL_AMT_MEAN", "BILL_AMT_MAX", "BILL_AMT_TO_LIMIT_RATIO", "BILL_AMT_UTILIZATION",
    "LIMIT_BAL_PER_AGE", "LIMIT_BAL_LOG", "RISK_SCORE_1", "CRITICAL_DEBT",
]

# model input
MODEL_NUMERIC = (["LIMIT_BAL", "AGE"] + BILL + PAMT + PAY
                 + ["PAYMENT_MEAN", "PAYMENT_MAX_DELAY", "PAYMENT_DELAY_COUNT", "PAYMENT_SEVERITY",
                    "BILL_AMT_TO_LIMIT_RATIO", "BILL_AMT_UTILIZATION",
                    "RISK_SCORE_1", "CRITICAL_DEBT",
                    "LIMIT_BAL_LOG", "LIMIT_BAL_PER_AGE"])
MODEL_CATEGORICAL = ["SEX", "EDUCATION", "MARRIAGE"]

# validation rule sets
ALLOWED_CODES = {"SEX": [1, 2], "EDUCATION": [1, 2, 3, 4], "MARRIAGE": [1, 2, 3]}
IN_SET_RULES = [("SEX", [1, 2]), ("EDUCATION", [1, 2, 3, 4]),
                ("MARRIAGE", [1, 2, 3]), (LABEL, [0, 1])]
NOT_NULL_RULES = ["LIMIT_BAL", LABEL]
BETWEEN_RULES = [("AGE", 18, 100), ("LIMIT_BAL", 0, 1000000)]

# age bins: right-closed (0,25], (25,35], (35,45], (45,55], (55,100]
AGE_BIN_EDGES = [0, 25, 35, 45, 55, 100]
AGE_BIN_LABELS = ["18-25", "26-35", "36-45", "46-55", "55+"]

# risk bands: p<0.1, <0.2, <0.4, <0.6, else
RISK_BAND_EDGES = [0.1, 0.2, 0.4, 0.6]
RISK_BAND_LABELS_EN = ["very low", "low", "medium", "high", "very high"]
RISK_BAND_LABELS_RU = ["очень низкий", "низкий", "средний", "высокий", "очень высокий"]

# ratio guard and drift thresholds
RATIO_EPS = 1e-6
PSI_FLOOR = 0.0001
PSI_SMOOTH = 0.0001
KL_EPS = 1e-10
PSI_HIGH = 0.2
PSI_MEDIUM = 0.1
DRIFT_THRESHOLD = 0.1
KEY_DRIFT_FEATURES = ["LIMIT_BAL", "AGE", "PAY_0", "PAYMENT_MEAN", "BILL_AMT_TO_LIMIT_RATIO"]
TTEST_FEATURES = ["LIMIT_BAL", "AGE"]
DRIFT_ADVICE_HIGH = "High data drift detected. Retraining the model is recommended."
DRIFT_ADVICE_MEDIUM = "Medium data drift detected. Monitoring is recommended."

# ---------------------------------------------------------------------------
# schemas (declared, never inferred)
# ---------------------------------------------------------------------------
_INT = {"SEX", "EDUCATION", "MARRIAGE", "AGE", *PAY}


def raw_schema(label: str = RAW_LABEL) -> T.StructType:
    fields = [T.StructField("ID", T.LongType())]
    for c in PROCESSED_COLUMNS[:-1]:
        fields.append(T.StructField(c, T.IntegerType() if c in _INT else T.DoubleType()))
    fields.append(T.StructField(label, T.IntegerType()))
    return T.StructType(fields)


def processed_schema(with_id: bool = True) -> T.StructType:
    fields = [T.StructField("ID", T.LongType())] if with_id else []
    for c in PROCESSED_COLUMNS:
        fields.append(T.StructField(c, T.IntegerType() if c in _INT or c == LABEL else T.DoubleType()))
    return T.StructType(fields)


def request_schema() -> T.StructType:
    """A scoring request: the 23 borrower fields (plus optional ID)."""
    fields = [T.StructField("ID", T.LongType())]
    for c in PROCESSED_COLUMNS[:-1]:
        fields.append(T.StructField(c, T.IntegerType() if c in _INT else T.DoubleType()))
    return T.StructType(fields)
