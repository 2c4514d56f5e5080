"""Return anomalies: product totals, category and portfolio baselines, flags.

The base join (orders, items, returns of the same product by the same user) is
computed once, at product grain.  Category and portfolio figures are sums of the
product rows, since every measure is additive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.numbers import at_least, share
from tillwright.functions.time import in_days
from tillwright.session import stored

# fixed values: return reasons per bucket
REASONS = {
    "ux": "COMPLEX_UI|INCOMPATIBLE|DOCUMENTATION_CONFUSING|DID_NOT_MEET_EXPECTATIONS|SETUP_DIFFICULT",
    "defect": "DEFECT|DOA|OVERHEATING|SCREEN_ISSUE|SPEAKER_DISTORTION|FAN_NOISE|BATTERY_DRAIN",
    "logistics": "DAMAGED_IN_TRANSIT|UNDERPOWERED_SUPPLY",
}

MEASURES = ["units", "returns", "ux", "defect", "logistics", "other"]


@dataclass(frozen=True)
class Thresholds:
    """Limits of the five anomaly flags."""

    min_units: int = 3
    min_returns: int = 2
    rate_ratio: float = 1.30
    rate_diff: float = 0.02
    day_ratio: float = 2.0
    day_diff: float = 1.0
    share_diff: float = 0.10
    share_floor: float = 0.50


def in_bucket(reason: Column, bucket: str) -> Column:
    """True when the reason names the bucket; substring match, any case."""
    if bucket == "other":
        return ~reason.rlike("(?i)" + "|".join(REASONS.values()))
    return reason.rlike("(?i)" + REASONS[bucket])


def reason_buckets(returns: DataFrame, reason: str = "reason") -> DataFrame:
    """Add ``bucket``; a reason can match several, the first is named.  NULL reasons have none."""
    bucket = F.when(in_bucket(F.col(reason), "ux"), "ux")
    for name in ("defect", "logistics", "other"):
        bucket = bucket.when(in_bucket(F.col(reason), name), name)
    return returns.withColumn("bucket", bucket)


def join_orders_items_returns(orders: DataFrame, items: DataFrame, returns: DataFrame,
                              first: str, last: str) -> DataFrame:
    """Orders with items and matching returns, at (product, user) grain.

    An item row pairs with every return of the same product by the same user in
    the window.  Those pairs are counted, not emitted: both sides are first
    summed per (product, user), and the sums of the pairs are products of the
    two sides' counts.
    """
    bought = (
        orders.where(in_days(orders, "created_at", first, last))
        .select(F.col("id").alias("order_id"), "user_id")
        .join(items.select("order_id", "product_id", "quantity"), "order_id")
        .groupBy("product_id", "user_id")
        .agg(F.count("*").alias("item_rows"), F.sum("quantity").alias("quantity"))
    )
    known = F.col("id").isNotNull()
    returned = (
        returns.where(in_days(returns, "created_at", first, last))
        .groupBy("product_id", "user_id")
        .agg(
            F.count("*").alias("return_rows"),
            F.count("id").alias("n_returns"),
            *[F.count_if(in_bucket(F.col("reason"), b)).alias("n_" + b) for b in ("ux", "defect", "logistics")],
            F.count_if(known & in_bucket(F.col("reason"), "other")).alias("n_other"),
        )
    )
    matches = F.coalesce(F.col("return_rows"), F.lit(0))

    def pairs(name: str, out: str) -> Column:
        return (F.col("item_rows") * F.coalesce(F.col(name), F.lit(0))).alias(out)

    return bought.join(returned, ["product_id", "user_id"], "left").select(
        "product_id",
        "user_id",
        (F.col("item_rows") * F.greatest(matches, F.lit(1))).alias("joined_rows"),
        (F.col("quantity") * F.greatest(matches, F.lit(1))).cast("bigint").alias("units"),
        pairs("n_returns", "returns"),
        pairs("n_ux", "ux"),
        pairs("n_defect", "defect"),
        pairs("n_logistics", "logistics"),
        pairs("n_other", "other"),
    )


def _sums() -> list[Column]:
    return [F.sum(m).cast("bigint").alias(m) for m in MEASURES]


def product_totals(orders: DataFrame, items: DataFrame, returns: DataFrame, first: str, last: str) -> DataFrame:
    """Units, returns and returns per reason bucket for every product sold in the window."""
    return join_orders_items_returns(orders, items, returns, first, last).groupBy("product_id").agg(*_sums())


def _days(first: str, last: str) -> Column:
    return F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date")) + 1


def _ratios(first: str, last: str) -> list[Column]:
    return [
        share("returns", "units").alias("rate"),
        share(F.col("returns"), _days(first, last)).alias("per_day"),
        share("ux", "returns").alias("ux_share"),
        share("defect", "returns").alias("defect_share"),
        share("logistics", "returns").alias("logistics_share"),
    ]


def category_baseline(totals: DataFrame, products: DataFrame, first: str, last: str) -> DataFrame:
    """Rates and reason shares per category; products missing from the catalogue drop out."""
    return (
        totals.join(products.select(F.col("id").alias("product_id"), "category_id"), "product_id")
        .groupBy("category_id")
        .agg(*_sums())
        .select("category_id", *MEASURES, *_ratios(first, last))
    )


def portfolio_baseline(totals: DataFrame, first: str, last: str) -> DataFrame:
    """The same figures over everything sold, known to the catalogue or not; one row."""
    return totals.agg(*_sums()).select(*MEASURES, *_ratios(first, last))


BASES = ["rate", "per_day", "ux_share", "defect_share", "logistics_share"]


def with_baselines(totals: DataFrame, products: DataFrame, first: str, last: str) -> DataFrame:
    """Product rows with catalogue columns, own ratios and the baseline ratios ``base_*``.

    A baseline is the category's figure, else the portfolio's, else 0.  The totals
    feed three aggregates, so they are stored: orders, items and returns are read
    once.  The portfolio row is read as a scalar subquery, so no product row is
    shuffled or crossed for it.
    """
    totals = stored(totals, "totals")
    category = category_baseline(totals, products, first, last)
    portfolio = portfolio_baseline(totals, first, last)
    whole = portfolio.select(F.struct(*BASES).alias("whole")).scalar()
    listed = products.select(F.col("id").alias("product_id"), "category_id", "brand", "name")
    return (
        totals.join(listed, "product_id")
        .join(category.select("category_id", *[F.col(b).alias("cat_" + b) for b in BASES]), "category_id", "left")
        .withColumn("whole", whole)
        .select(
            "product_id", "category_id", "brand", "name", *MEASURES,
            *_ratios(first, last),
            *[F.coalesce("cat_" + b, F.col("whole")[b], F.lit(0.0)).alias("base_" + b) for b in BASES],
        )
    )


def rates_and_shares(based: DataFrame) -> DataFrame:
    """The ratios rounded to three decimals."""
    names = BASES + ["base_" + b for b in BASES]
    return based.select("product_id", "category_id", *[F.round(n, 3).alias(n) for n in names if n != "per_day"])


def high_return_rate(t: Thresholds = Thresholds()) -> Column:
    return (
        (F.col("units") >= t.min_units)
        & at_least(F.col("rate"), F.col("base_rate") * t.rate_ratio)
        & at_least(F.col("rate") - F.col("base_rate"), t.rate_diff)
    )


def volume_spike(t: Thresholds = Thresholds()) -> Column:
    return (
        (F.col("returns") >= t.min_returns)
        & at_least(F.col("per_day"), F.col("base_per_day") * t.day_ratio)
        & at_least(F.col("per_day") - F.col("base_per_day"), t.day_diff)
    )


def reason_surge(bucket: str, t: Thresholds = Thresholds()) -> Column:
    own, base = F.col(bucket + "_share"), F.col(f"base_{bucket}_share")
    return (F.col("returns") >= t.min_returns) & (
        at_least(own - base, t.share_diff) | at_least(own, t.share_floor)
    )


def flags(t: Thresholds = Thresholds()) -> dict[str, Column]:
    """Flag name to predicate, in report order."""
    return {
        "high_return_rate": high_return_rate(t),
        "volume_spike": volume_spike(t),
        "ux_surge": reason_surge("ux", t),
        "defect_surge": reason_surge("defect", t),
        "logistics_surge": reason_surge("logistics", t),
    }


def with_flags(based: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Add ``flag_*`` as 0/1 and ``anomaly_flags``, the comma list of raised flags."""
    preds = flags(t)
    flagged = based.withColumns({"flag_" + n: F.when(p, 1).otherwise(0) for n, p in preds.items()})
    return flagged.withColumn(
        "anomaly_flags",
        F.concat_ws(", ", *[F.when(F.col("flag_" + n) == 1, n.upper()) for n in preds]),
    )


def return_anomaly_report(orders: DataFrame, items: DataFrame, returns: DataFrame, products: DataFrame,
                          first: str, last: str, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The full 25-column report, one row per product sold in the window."""
    totals = product_totals(orders, items, returns, first, last)
    report = with_flags(with_baselines(totals, products, first, last), thresholds)

    def r3(column: str, out: str) -> Column:
        return F.round(column, 3).alias(out)

    return report.select(
        "product_id", "category_id", "brand", "name",
        F.col("units").alias("units_sold_total"),
        F.col("returns").alias("returns_total"),
        r3("rate", "eventual_return_rate"),
        *[F.col(b).alias(b + "_returns") for b in ("ux", "defect", "logistics", "other")],
        *[r3(b + "_share", b + "_share") for b in ("ux", "defect", "logistics")],
        r3("base_rate", "base_return_rate"),
        r3("base_per_day", "base_returns_per_day"),
        *[r3(f"base_{b}_share", f"base_{b}_share") for b in ("ux", "defect", "logistics")],
        *["flag_" + n for n in flags()],
        "anomaly_flags",
    )
