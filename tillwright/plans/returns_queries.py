"""Return-anomaly queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import returns as R
from tillwright.plans.registry import query
from tillwright.plans.shop import FIRST, LAST, Shop, with_ctes

UX, DEFECT, LOGISTICS = (f"regexp_matches(reason, '(?i){R.REASONS[b]}')" for b in ("ux", "defect", "logistics"))

JOINED = f"""joined AS (
  SELECT oi.product_id, o.user_id, oi.quantity, r.id AS return_id, r.reason
  FROM shop_orders o JOIN order_items oi ON oi.order_id = o.id
  LEFT JOIN shop_returns r ON r.product_id = oi.product_id AND r.user_id = o.user_id
       AND CAST(r.created_at AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
  WHERE CAST(o.created_at AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}')"""

BASE = with_ctes("products", "shop_orders", "order_items", "shop_returns") + ",\n" + JOINED

SUMS = f"""CAST(sum(quantity) AS BIGINT) AS units,
  CAST(sum(CASE WHEN return_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS returns,
  CAST(sum(CASE WHEN {UX} THEN 1 ELSE 0 END) AS BIGINT) AS ux,
  CAST(sum(CASE WHEN {DEFECT} THEN 1 ELSE 0 END) AS BIGINT) AS defect,
  CAST(sum(CASE WHEN {LOGISTICS} THEN 1 ELSE 0 END) AS BIGINT) AS logistics,
  CAST(sum(CASE WHEN return_id IS NOT NULL AND NOT {UX} AND NOT {DEFECT} AND NOT {LOGISTICS} THEN 1 ELSE 0 END) AS BIGINT) AS other"""

DAYS = f"(date_diff('day', DATE '{FIRST}', DATE '{LAST}') + 1)"
RATIOS = f"""CAST(returns AS DOUBLE) / nullif(units, 0) AS rate,
  CAST(returns AS DOUBLE) / {DAYS} AS per_day,
  CAST(ux AS DOUBLE) / nullif(returns, 0) AS ux_share,
  CAST(defect AS DOUBLE) / nullif(returns, 0) AS defect_share,
  CAST(logistics AS DOUBLE) / nullif(returns, 0) AS logistics_share"""

BASED = f"""{BASE},
totals AS (SELECT product_id, {SUMS} FROM joined GROUP BY product_id),
cat AS (SELECT category_id, {RATIOS} FROM (
  SELECT category_id, {SUMS} FROM joined JOIN products p ON p.id = product_id GROUP BY category_id)),
port AS (SELECT {RATIOS} FROM (SELECT {SUMS} FROM joined)),
based AS (
  SELECT t.product_id, p.category_id, p.brand, p.name, t.* EXCLUDE (product_id),
    coalesce(cat.rate, port.rate, 0) AS base_rate, coalesce(cat.per_day, port.per_day, 0) AS base_per_day,
    coalesce(cat.ux_share, port.ux_share, 0) AS base_ux_share,
    coalesce(cat.defect_share, port.defect_share, 0) AS base_defect_share,
    coalesce(cat.logistics_share, port.logistics_share, 0) AS base_logistics_share
  FROM (SELECT *, {RATIOS} FROM totals) t JOIN products p ON p.id = t.product_id
  LEFT JOIN cat ON cat.category_id = p.category_id CROSS JOIN port)"""


def flag_sql(name: str, day_ratio: float = 2.0, day_diff: float = 1.0) -> str:
    test = {
        "high_return_rate": "units >= 3 AND round(rate - base_rate * 1.30, 9) >= 0 AND round(rate - base_rate - 0.02, 9) >= 0",
        "volume_spike": f"returns >= 2 AND round(per_day - base_per_day * {day_ratio}, 9) >= 0"
                        f" AND round(per_day - base_per_day - ({day_diff}), 9) >= 0",
        **{f"{b}_surge": f"returns >= 2 AND (round({b}_share - base_{b}_share - 0.10, 9) >= 0 OR round({b}_share - 0.50, 9) >= 0)"
           for b in ("ux", "defect", "logistics")},
    }[name]
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


FLAG_NAMES = ["high_return_rate", "volume_spike", "ux_surge", "defect_surge", "logistics_surge"]
FLAG_COLUMNS = ", ".join(f"{flag_sql(n)} AS flag_{n}" for n in FLAG_NAMES)
FLAG_TEXT = "concat_ws(', ', " + ", ".join(f"CASE WHEN {flag_sql(n)} = 1 THEN '{n.upper()}' END" for n in FLAG_NAMES) + ")"


def _args(s: Shop):
    return s.orders(), s.order_items(), s.returns()


def _totals(s: Shop):
    return R.product_totals(*_args(s), FIRST, LAST)


def _based(s: Shop):
    return R.with_baselines(_totals(s), s.products(), FIRST, LAST)


@query("ret_reason_bucket", with_ctes("shop_returns") + f"""
SELECT id, product_id, user_id, reason, CASE WHEN {UX} THEN 'ux' WHEN {DEFECT} THEN 'defect'
  WHEN {LOGISTICS} THEN 'logistics' WHEN reason IS NOT NULL THEN 'other' END AS bucket
FROM shop_returns""")
def ret_reason_bucket(s):
    return R.reason_buckets(s.returns()).select("id", "product_id", "user_id", "reason", "bucket")


@query("join_orders_items_returns", f"""{BASE}
SELECT product_id, user_id, count(*) AS joined_rows, {SUMS} FROM joined GROUP BY product_id, user_id""")
def join_orders_items_returns(s):
    return R.join_orders_items_returns(*_args(s), FIRST, LAST)


@query("ret_product_totals", f"{BASE} SELECT product_id, {SUMS} FROM joined GROUP BY product_id")
def ret_product_totals(s):
    return _totals(s)


ROUNDED = ", ".join(f"round({b}, 6) AS {b}" for b in R.BASES)
ROUNDED_BASES = ", ".join(f"round(base_{b}, 6) AS base_{b}" for b in R.BASES)


def _round6(names):
    return [F.round(n, 6).alias(n) for n in names]


@query("ret_category_baseline", f"""{BASE}
SELECT category_id, units, returns, ux, defect, logistics, other, {ROUNDED} FROM (SELECT *, {RATIOS} FROM (
  SELECT category_id, {SUMS} FROM joined JOIN products p ON p.id = product_id GROUP BY category_id))""")
def ret_category_baseline(s):
    df = R.category_baseline(_totals(s), s.products(), FIRST, LAST)
    return df.select("category_id", *R.MEASURES, *_round6(R.BASES))


@query("ret_portfolio_baseline", f"""{BASE}
SELECT units, returns, ux, defect, logistics, other, {ROUNDED} FROM (SELECT *, {RATIOS} FROM (SELECT {SUMS} FROM joined))""")
def ret_portfolio_baseline(s):
    return R.portfolio_baseline(_totals(s), FIRST, LAST).select(*R.MEASURES, *_round6(R.BASES))


@query("join_cross_baseline", f"{BASED} SELECT product_id, category_id, {ROUNDED_BASES} FROM based")
def join_cross_baseline(s):
    return _based(s).select("product_id", "category_id", *_round6(["base_" + b for b in R.BASES]))


R3 = ", ".join(f"round({n}, 3) AS {n}" for n in [*R.BASES, *("base_" + b for b in R.BASES)] if n != "per_day")


@query("ret_rates_shares", f"{BASED} SELECT product_id, category_id, {R3} FROM based")
def ret_rates_shares(s):
    return R.rates_and_shares(_based(s))


def _flag_query(name: str):
    @query("flag_" + name, f"{BASED} SELECT product_id, units, returns, {flag_sql(name)} AS flag_{name} FROM based")
    def flag(s):
        return R.with_flags(_based(s)).select("product_id", "units", "returns", "flag_" + name)

    return flag


for _name in FLAG_NAMES:
    if _name != "volume_spike":
        _flag_query(_name)


# With the default limits no product can raise this flag, since its returns are part of its
# category's.  The relaxed limits compare a product's daily returns with a fraction of the category's.
@query("flag_volume_spike", f"""{BASED}
SELECT product_id, returns, {flag_sql('volume_spike')} AS flag_volume_spike,
  {flag_sql('volume_spike', 0.01, -1.0)} AS flag_relaxed FROM based""")
def flag_volume_spike(s):
    relaxed = R.volume_spike(R.Thresholds(day_ratio=0.01, day_diff=-1.0))
    return R.with_flags(_based(s)).select(
        "product_id", "returns", "flag_volume_spike", F.when(relaxed, 1).otherwise(0).alias("flag_relaxed"))


@query("anomaly_flag_text", f"{BASED} SELECT product_id, {FLAG_TEXT} AS anomaly_flags FROM based")
def anomaly_flag_text(s):
    return R.with_flags(_based(s)).select("product_id", "anomaly_flags")


@query("return_anomaly_report", f"""{BASED}
SELECT product_id, category_id, brand, name, units AS units_sold_total, returns AS returns_total,
  round(rate, 3) AS eventual_return_rate, ux AS ux_returns, defect AS defect_returns,
  logistics AS logistics_returns, other AS other_returns, round(ux_share, 3) AS ux_share,
  round(defect_share, 3) AS defect_share, round(logistics_share, 3) AS logistics_share,
  round(base_rate, 3) AS base_return_rate, round(base_per_day, 3) AS base_returns_per_day,
  round(base_ux_share, 3) AS base_ux_share, round(base_defect_share, 3) AS base_defect_share,
  round(base_logistics_share, 3) AS base_logistics_share, {FLAG_COLUMNS}, {FLAG_TEXT} AS anomaly_flags
FROM based""")
def return_anomaly_report(s):
    return R.return_anomaly_report(*_args(s), s.products(), FIRST, LAST)
