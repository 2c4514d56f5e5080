from decimal import Decimal

import pytest

from tillwright.operators import returns as R

# five buyers, ten days; product 501 and 502 share a category, 504 has no return
ORDERS = [(71, "2024-03-01 08:00", 11), (72, "2024-03-02 08:00", 12), (73, "2024-03-02 09:00", 13),
          (74, "2024-03-03 08:00", 14), (75, "2024-03-04 08:00", 15), (76, "2024-02-01 08:00", 15)]
ITEMS = [(71, 501, 2), (72, 501, 2), (72, 502, 1), (73, 502, 3), (74, 503, 4), (75, 504, 5), (76, 503, 9)]
RETURNS = [(1, "2024-03-04 10:00", 501, 11, "DEFECT"), (2, "2024-03-05 10:00", 501, 12, "COMPLEX_UI"),
           (3, "2024-03-06 10:00", 502, 13, "DAMAGED_IN_TRANSIT"), (4, "2024-03-07 10:00", 503, 14, "CHANGED_MIND")]
CATEGORY = {501: 1, 502: 1, 503: 2, 504: 3}
# derived by hand: the first category has 3 returns of 8 units; the third takes its shares from all 4 returns
GOLDEN = """501,1,4,2,0.500,1,1,0,0,0.375,0.300,0.333,0.333,0.333,HIGH_RETURN_RATE; UX_SURGE; DEFECT_SURGE
502,1,4,1,0.250,0,0,1,0,0.375,0.300,0.333,0.333,0.333,
503,2,4,1,0.250,0,0,0,1,0.250,0.100,0.000,0.000,0.000,
504,3,5,0,0,0,0,0,0,0.000,0.000,0.250,0.250,0.250,"""
WINDOW = ("2024-03-01", "2024-03-10")


@pytest.fixture(scope="module")
def tables(spark):
    orders = spark.createDataFrame(ORDERS, "id long, t string, user_id long")
    items = spark.createDataFrame(ITEMS, "order_id long, product_id long, quantity int")
    returns = spark.createDataFrame(RETURNS, "id long, t string, product_id long, user_id long, reason string")
    products = spark.createDataFrame(
        [(p, f"b{p}", c, f"n{p}") for p, c in CATEGORY.items()], "id long, brand string, category_id long, name string")
    stamp = "cast(t as timestamp) as created_at"
    return orders.selectExpr("*", stamp), items, returns.selectExpr("*", stamp), products


def test_report_matches_golden(tables):
    got = {r["product_id"]: r for r in R.return_anomaly_report(*tables, *WINDOW).collect()}
    golden = [line.split(",") for line in GOLDEN.splitlines()]
    assert sorted(got) == [int(g[0]) for g in golden]
    names = ["category_id", "units_sold_total", "returns_total", "eventual_return_rate", "ux_returns", "defect_returns",
             "logistics_returns", "other_returns", "base_return_rate", "base_returns_per_day", "base_ux_share",
             "base_defect_share", "base_logistics_share"]
    for g in golden:
        row = got[int(g[0])]
        for name, want in zip(names, g[1:14]):
            assert Decimal(str(row[name])) == Decimal(want), (g[0], name)
        assert row["anomaly_flags"] == g[14].replace(";", ",")
        assert row["flag_high_return_rate"] == (g[0] == "501") and row["flag_volume_spike"] == 0


def test_category_sums_are_product_sums(tables):
    orders, items, returns, products = tables
    totals = R.product_totals(orders, items, returns, *WINDOW)
    by_category = R.category_baseline(totals, products, *WINDOW).agg({"units": "sum", "returns": "sum"}).first()
    whole = R.portfolio_baseline(totals, *WINDOW).first()
    assert (by_category["sum(units)"], by_category["sum(returns)"]) == (whole["units"], whole["returns"]) == (17, 4)


def test_share_threshold_is_met_exactly(spark):
    """0.5 - 0.4 is a little below 0.1 in doubles, yet meets the limit."""
    df = spark.createDataFrame([(10, 0.4, 0.3), (10, 0.39, 0.3)], "returns long, ux_share double, base_ux_share double")
    assert [r[0] for r in df.select(R.reason_surge("ux")).collect()] == [True, False]


def test_volume_spike_with_other_baseline(spark):
    df = spark.createDataFrame([(40, 2.0, 0.9), (40, 2.0, 1.1), (1, 5.0, 1.0)],
                               "returns long, per_day double, base_per_day double")
    assert [r[0] for r in df.select(R.volume_spike()).collect()] == [True, False, False]


def test_reasons(spark):
    df = spark.createDataFrame([("minor defect seen",), ("HEAVY",), (None,), ("complex_ui",)], "reason string")
    assert [r["bucket"] for r in R.reason_buckets(df).collect()] == ["defect", "other", None, "ux"]
