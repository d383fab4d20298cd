"""The comparison of a delivery, as each tier does it (FCT-3 to FCT-6, JN-12, JN-17)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrain.operators.compare import (
    comparison_set,
    delivery_counts,
    indexes,
    period_sides,
    period_status,
    repeated_facts,
    share_of_top,
    share_of_total,
)
from panelgrain.operators.periods import five_week_factor
from panelgrain.spec import PeriodPolicy

# Tier 1 brings the previous period to length as well, tier 2 scales the current side against year ago.
TIER_1 = PeriodPolicy(scale_previous=True, scale_year_ago=False)
TIER_2 = PeriodPolicy(scale_previous=False, scale_year_ago=True)


@dataclass(frozen=True)
class Comparison:
    """Facts with flags, shares, other sides and indexes, and the keys whose facts are repeated."""

    facts: DataFrame
    repeated: DataFrame


def period_factors(periods: DataFrame, associations: DataFrame, weekly_run: bool) -> DataFrame:
    """The five-week-month factor of each period and of the one before it; 1 where the weeks are not known.

    `periods` has period_id, prev_id and end_date. All of it is calendar metadata.
    """
    known = five_week_factor(associations, weekly_run).select("period_end", "time_factor")
    own = periods.join(known, periods["end_date"] == known["period_end"], "left").select("period_id", "prev_id", F.coalesce("time_factor", F.lit(1.0)).alias("time_factor"))
    before = own.select(F.col("period_id").alias("prev_id"), F.col("time_factor").alias("time_factor_pp"))
    return own.join(before, "prev_id", "left").select("period_id", "time_factor", F.coalesce("time_factor_pp", F.lit(1.0)).alias("time_factor_pp"))


def _compared(
    facts: DataFrame, stored: DataFrame, status: DataFrame, periods: DataFrame, factors: DataFrame, keys: Sequence[str], period_keys: Sequence[str],
    measures: Sequence[str], shares: Callable[[DataFrame], DataFrame], policy: PeriodPolicy,
) -> Comparison:
    """Flags and previous delivery, shares, other sides, factors, indexes; the steps both tiers have in common."""
    again = comparison_set(facts, status, stored, period_keys, [*keys, "period_id"], measures)
    carry = ["is_new", "is_redelivered", *[f"{m}_{s}" for m in measures for s in ("pd", "share")]]
    lined = period_sides(shares(again), periods, keys, measures, carry)
    # A fact without a known period has no other side, so its factor does not matter.
    scaled = lined.join(factors, "period_id", "left").na.fill(1.0, ["time_factor", "time_factor_pp"])
    return Comparison(indexes(scaled, measures, policy), repeated_facts(facts, keys))


def tier1_comparison(
    facts: DataFrame, stored: DataFrame, deliveries: DataFrame, periods: DataFrame, associations: DataFrame, *, run_id: int, weekly_run: bool,
    keys: Sequence[str], period_keys: Sequence[str], measures: Sequence[str], within: Sequence[str], path: str = "path", top_depth: int = 1,
) -> Comparison:
    """Tier 1: only periods last delivered by this run are new or redelivered; shares are of the top-level row of a path.

    `facts` has the products of all levels with `is_top`; `stored` the values before this delivery. `keys` name a fact
    without its period, `period_keys` a delivered period in `facts` and `deliveries`, `within` what a share is taken in. The index
    against the previous period scales both sides by their own month's factor, the one against year ago none.
    """
    status = period_status(delivery_counts(deliveries, period_keys), run_id)
    shares = lambda df: share_of_top(df, within, path, top_depth, measures)
    return _compared(facts, stored, status, periods, period_factors(periods, associations, weekly_run), keys, period_keys, measures, shares, TIER_1)


def tier2_comparison(
    facts: DataFrame, stored: DataFrame, deliveries: DataFrame, periods: DataFrame, associations: DataFrame, *, weekly_run: bool,
    keys: Sequence[str], period_keys: Sequence[str], measures: Sequence[str], within: Sequence[str],
) -> Comparison:
    """Tier 2: a period is redelivered whichever run delivered it last; shares are of all products of `within`.

    The current side is scaled by its month's factor against the previous period and against year ago.
    """
    status = period_status(delivery_counts(deliveries, period_keys))
    shares = lambda df: share_of_total(df, within, measures)
    return _compared(facts, stored, status, periods, period_factors(periods, associations, weekly_run), keys, period_keys, measures, shares, TIER_2)
