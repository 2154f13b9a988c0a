"""DuckDB SQL building blocks for the oracle: the derived credit view,
cleaning and feature formulas written independently of the Spark code, so the
oracle checks it rather than restating it."""

from __future__ import annotations

PAY = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL = [f"BILL_AMT{i}" for i in range(1, 7)]
PAMT = [f"PAY_AMT{i}" for i in range(1, 7)]


def _pivot_cols() -> str:
    parts = []
    for i in range(6):
        k = i + 1
        parts.append(f"max(CASE WHEN k = {k} THEN pay END) AS {PAY[i]}")
        parts.append(f"max(CASE WHEN k = {k} THEN bill END) AS {BILL[i]}")
        parts.append(f"max(CASE WHEN k = {k} THEN amt END) AS {PAMT[i]}")
    return ",\n    ".join(parts)


CREDIT_CTES = f"""
paid AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2))) AS paid
  FROM lineitem GROUP BY l_orderkey),
ranked AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k
  FROM orders),
latest AS (
  SELECT r.o_custkey, r.k,
         CASE r.o_orderstatus WHEN 'F' THEN -1 WHEN 'O' THEN 0
              ELSE CAST(substr(r.o_orderpriority, 1, 1) AS INTEGER) END AS pay,
         r.o_totalprice AS bill,
         CAST(round(coalesce(p.paid, 0), 2) AS DOUBLE) AS amt
  FROM ranked r LEFT JOIN paid p ON r.o_orderkey = p.l_orderkey
  WHERE r.k <= 6),
piv AS (
  SELECT o_custkey,
    {_pivot_cols()}
  FROM latest GROUP BY o_custkey),
credit AS (
  SELECT c.c_custkey AS ID,
         CAST(10000 + floor(greatest(c.c_acctbal, 0) * 50) AS DOUBLE) AS LIMIT_BAL,
         CAST(1 + c.c_custkey % 2 AS INTEGER) AS SEX,
         CAST(c.c_custkey % 7 AS INTEGER) AS EDUCATION,
         CAST(floor(c.c_custkey / 7) % 4 AS INTEGER) AS MARRIAGE,
         CAST(21 + (c.c_custkey * 7) % 55 AS INTEGER) AS AGE,
         {", ".join("p." + c for c in PAY)},
         {", ".join("p." + c for c in BILL)},
         {", ".join("p." + c for c in PAMT)},
         CASE WHEN (p.PAY_0 >= 2 AND c.c_custkey % 3 <> 0) OR c.c_custkey % 11 = 0 THEN 1 ELSE 0 END AS is_default,
         substr(md5(CAST(c.c_custkey AS VARCHAR)), 1, 8) < '33333333' AS is_test
  FROM customer c LEFT JOIN piv p ON c.c_custkey = p.o_custkey)"""


def _sum0(cols):
    return " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols)


def _cnt(cols):
    return " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)


def _mean(cols):
    return f"(CASE WHEN ({_cnt(cols)}) = 0 THEN NULL ELSE ({_sum0(cols)}) / CAST({_cnt(cols)} AS DOUBLE) END)"


def _std(cols):
    m = _mean(cols)
    ss = " + ".join(f"coalesce((CAST({c} AS DOUBLE) - {m}) * (CAST({c} AS DOUBLE) - {m}), 0.0)" for c in cols)
    return f"(CASE WHEN ({_cnt(cols)}) >= 2 THEN sqrt(({ss}) / CAST(({_cnt(cols)}) - 1 AS DOUBLE)) END)"


def _above(cols, t):
    return " + ".join(f"(CASE WHEN {c} > {t} THEN 1 ELSE 0 END)" for c in cols)


def _ratio(num, den):
    return f"(CAST({num} AS DOUBLE) / (CAST({den} AS DOUBLE) + CAST(1e-6 AS DOUBLE)))"


CLEAN_CTE = """
clean AS (
  SELECT * REPLACE (
    CASE WHEN EDUCATION IS NULL THEN NULL
         ELSE least(greatest(CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END, 1), 4) END AS EDUCATION,
    CASE WHEN MARRIAGE IS NULL THEN NULL
         ELSE least(greatest(CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END, 1), 3) END AS MARRIAGE)
  FROM credit)"""


def _feature_exprs() -> list[tuple[str, str]]:
    pm, bm, am = _mean(PAY), _mean(BILL), _mean(PAMT)
    f = []
    f.append(("PAYMENT_MEAN", pm))
    f.append(("PAYMENT_MAX_DELAY", f"CAST(greatest({', '.join(PAY)}) AS INTEGER)"))
    f.append(("PAYMENT_MIN_DELAY", f"CAST(least({', '.join(PAY)}) AS INTEGER)"))
    f.append(("PAYMENT_STD", _std(PAY)))
    f.append(("PAYMENT_DELAY_COUNT", f"CAST({_above(PAY, 0)} AS INTEGER)"))
    f.append(("PAYMENT_SEVERITY", f"CAST({_above(PAY, 1)} AS INTEGER)"))
    f.append(("BILL_AMT_MEAN", bm))
    f.append(("BILL_AMT_STD", _std(BILL)))
    f.append(("BILL_AMT_MAX", f"CAST(greatest({', '.join(BILL)}) AS DOUBLE)"))
    f.append(("BILL_AMT_MIN", f"CAST(least({', '.join(BILL)}) AS DOUBLE)"))
    f.append(("BILL_AMT_TO_LIMIT_RATIO", _ratio(bm, "LIMIT_BAL")))
    f.append(("BILL_AMT_UTILIZATION", _ratio(f"greatest({', '.join(BILL)})", "LIMIT_BAL")))
    f.append(("PAY_AMT_MEAN", am))
    f.append(("PAY_AMT_SUM", f"({_sum0(PAMT)})"))
    f.append(("PAY_AMT_STD", _std(PAMT)))
    f.append(("PAY_AMT_MAX", f"CAST(greatest({', '.join(PAMT)}) AS DOUBLE)"))
    f.append(("PAYMENT_TO_BILL_RATIO", _ratio(am, bm)))
    f.append(("PAYMENT_TO_LIMIT_RATIO", _ratio(am, "LIMIT_BAL")))
    f.append(("AGE_GROUP", "CASE WHEN AGE > 0 AND AGE <= 25 THEN '18-25' WHEN AGE > 25 AND AGE <= 35 THEN '26-35' "
                           "WHEN AGE > 35 AND AGE <= 45 THEN '36-45' WHEN AGE > 45 AND AGE <= 55 THEN '46-55' "
                           "WHEN AGE > 55 AND AGE <= 100 THEN '55+' END"))
    f.append(("LIMIT_BAL_PER_AGE", _ratio("LIMIT_BAL", "AGE")))
    f.append(("LIMIT_BAL_LOG", "(CASE WHEN LIMIT_BAL > -1 THEN ln(1 + LIMIT_BAL) END)"))
    dc = f"({_above(PAY, 0)})"
    br = _ratio(bm, "LIMIT_BAL")
    f.append(("RISK_SCORE_1",
              f"(CAST(PAY_0 AS DOUBLE) * CAST(0.3 AS DOUBLE) + CAST({dc} AS DOUBLE) * CAST(0.2 AS DOUBLE)"
              f" + {br} * CAST(0.2 AS DOUBLE)"
              f" + (CASE WHEN AGE < 30 THEN 1 ELSE 0 END) * CAST(0.1 AS DOUBLE)"
              f" + (CASE WHEN EDUCATION = 4 THEN 1 ELSE 0 END) * CAST(0.1 AS DOUBLE)"
              f" + (CASE WHEN LIMIT_BAL < 50000 THEN 1 ELSE 0 END) * CAST(0.1 AS DOUBLE))"))
    f.append(("CRITICAL_DEBT", f"(CASE WHEN greatest({', '.join(PAY)}) > 2 AND {br} > 0.8 THEN 1 ELSE 0 END)"))
    return f


FEATURE_EXPRS = _feature_exprs()
FEATURE_NAMES = [n for n, _ in FEATURE_EXPRS]

FEAT_CTE = ("\nfeat AS (\n  SELECT *,\n    "
            + ",\n    ".join(f"{e} AS {n}" for n, e in FEATURE_EXPRS)
            + "\n  FROM clean)")

BASE = "WITH " + CREDIT_CTES + "," + CLEAN_CTE + "," + FEAT_CTE


def with_base(*ctes: str) -> str:
    """WITH credit, clean, feat[, extra CTEs] — prefix for oracle statements."""
    extra = "".join("," + c for c in ctes)
    return BASE + extra + "\n"
