"""Skew and degenerate inputs: a customer holding a third of all orders, a
constant column, an all-NULL feature."""
import datetime

import numpy as np
import pandas as pd
import pytest

from riskloom.operators.ranks import exact_quantiles
from riskloom.sources.credit_view import credit_view_from


def test_hot_customer_latest_orders(spark):
    rng = np.random.default_rng(3)
    n_orders = 900
    cust = np.where(np.arange(n_orders) % 3 == 0, 0, rng.integers(1, 40, n_orders))   # customer 0: a third
    day0 = datetime.datetime(1995, 1, 1)
    orders = pd.DataFrame({
        "o_orderkey": np.arange(n_orders, dtype="int64"), "o_custkey": cust.astype("int64"),
        "o_orderstatus": rng.choice(["F", "O", "P"], n_orders),
        "o_totalprice": np.round(rng.uniform(100, 1000, n_orders), 2),
        "o_orderdate": [day0 + datetime.timedelta(days=int(d)) for d in rng.integers(0, 50, n_orders)],
        "o_orderpriority": rng.choice(["1-URGENT", "2-HIGH", "5-LOW"], n_orders)})
    li = pd.DataFrame({"l_orderkey": rng.integers(0, n_orders, 3000).astype("int64"),
                       "l_extendedprice": np.round(rng.uniform(1, 100, 3000), 2),
                       "l_discount": np.round(rng.uniform(0, 0.1, 3000), 2)})
    customer = pd.DataFrame({"c_custkey": np.arange(45, dtype="int64"),
                             "c_acctbal": np.round(rng.uniform(-100, 5000, 45), 2)})
    view = credit_view_from(spark.createDataFrame(customer), spark.createDataFrame(orders),
                            spark.createDataFrame(li)).toPandas().set_index("ID")
    latest = orders.sort_values(["o_orderdate", "o_orderkey"], ascending=False).groupby("o_custkey").head(6)
    for c, g in latest.groupby("o_custkey"):
        bills = g["o_totalprice"].tolist()
        got = [view.loc[c, f"BILL_AMT{i}"] for i in range(1, len(bills) + 1)]
        assert got == bills
    assert pd.isna(view.loc[44, "PAY_0"])          # a customer without orders keeps its row


def test_constant_and_all_null(spark):
    rows = [("const", 7.0)] * 100 + [("nulls", None)] * 20 + [("x", float(v)) for v in range(11)]
    df = spark.createDataFrame(rows, "feature string, value double")
    q = exact_quantiles(df, ["feature"], [0.0, 0.5, 1.0], buckets=4).toPandas()
    assert set(q[q.feature == "const"]["quantile"]) == {7.0}
    assert q[q.feature == "x"].sort_values("q")["quantile"].tolist() == [0.0, 5.0, 10.0]
    assert q[q.feature == "nulls"].empty            # no values, no quantiles (NULL report row upstream)
