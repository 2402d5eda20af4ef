"""Business rules: customer segments, KPI bands, bins and stable pseudo-randomness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrina.functions.measures import col


@dataclass(frozen=True)
class SegmentRule:
    """Lower bounds are inclusive: ``vip_orders=6`` means more than five orders."""

    vip_orders: int
    regular_orders: int
    vip_amount: float = 10_000_000
    vip_days: int = 90
    regular_days: int = 180
    risk_days: int = 365

    def with_amount(self, vip_amount: float) -> "SegmentRule":
        return SegmentRule(
            self.vip_orders, self.regular_orders, vip_amount, self.vip_days, self.regular_days, self.risk_days
        )


# The two segment rules in use and the recency of a customer without orders.
DIMENSION_RULE = SegmentRule(vip_orders=6, regular_orders=4)
SNAPSHOT_RULE = SegmentRule(vip_orders=5, regular_orders=2)
NO_ORDER_RECENCY = 999
CHURN_DAYS = 180


def rfm_segment(recency: Column | str, orders: Column | str, amount: Column | str, rule: SegmentRule) -> Column:
    r, f, m = col(recency), col(orders), col(amount)
    return (
        F.when((r <= rule.vip_days) & (f >= rule.vip_orders) & (m > rule.vip_amount), "VIP")
        .when((r <= rule.regular_days) & (f >= rule.regular_orders), "Regular")
        .when(r <= rule.risk_days, "En riesgo")
        .otherwise("Perdido")
    )


def churned(recency: Column | str, days: int = CHURN_DAYS) -> Column:
    return (col(recency) > days).cast("int")


def growth_band(growth: Column | str, goal: float = 5.0) -> Column:
    """Sign of the growth plus whether it passes the goal or the alert line."""
    g = col(growth)
    return (
        F.when(g >= goal, "meta")
        .when(g > 0, "sube")
        .when(g <= -goal, "alerta")
        .when(g < 0, "baja")
        .otherwise("neutro")
    )


def margin_band(margin: Column | str, critical: float = 10.0, goal: float = 25.0) -> Column:
    m = col(margin)
    return F.when(m < critical, "critico").when(m < goal, "medio").otherwise("meta")


def right_closed_bins(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin ``(low, high]`` that holds the value; null outside all bins."""
    v = col(value)
    chain = None
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        hit = (v > low) & (v <= high)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def stable_hash(key: Column | str, seed: int) -> Column:
    """32-bit number fixed by key and seed, the same for every partitioning."""
    text = F.concat_ws("-", col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def stable_uniform(key: Column | str, seed: int) -> Column:
    """Pseudo-random number in [0, 1)."""
    return stable_hash(key, seed) / float(2**32)
