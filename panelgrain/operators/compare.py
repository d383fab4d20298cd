"""New and redelivered periods, shares, indexes, validation facts (FCT-3..9, JN-12)."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.functions.ratios import index, share
from panelgrain.functions.text import path_prefix
from panelgrain.operators.conform import conform
from panelgrain.operators.dedup import latest_per_key
from panelgrain.operators.lookup import not_logged
from panelgrain.spec import PeriodPolicy


def delivery_counts(deliveries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest run and number of distinct delivering runs per key."""
    runs = deliveries.select(*keys, "run_id").distinct()
    return runs.groupBy(*keys).agg(F.max("run_id").alias("run_id"), F.count("*").alias("deliveries"))


def period_status(counts: DataFrame, run_id: int | None = None) -> DataFrame:
    """new / redelivered flags. With a run id (tier 1) only its own latest deliveries are flagged."""
    mine = F.lit(True) if run_id is None else F.col("run_id") == run_id
    return counts.withColumns(
        {
            "is_new": F.when(mine & (F.col("deliveries") == 1), "Y").otherwise("N"),
            "is_redelivered": F.when(mine & (F.col("deliveries") > 1), "Y").otherwise("N"),
        }
    )


def comparison_set(
    delivered: DataFrame, status: DataFrame, stored: DataFrame, period_keys: Sequence[str], row_keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Delivered facts with the previously delivered values on redelivered periods, null on new ones.

    Left joins keep products without history and periods without a status, whose flags are null. New
    periods need no stored value, so the flag blanks it instead of a second branch and a union.
    """
    old = stored.select(*row_keys, *[F.col(m).alias(f"{m}_pd") for m in measures])
    flagged = delivered.join(status.select(*period_keys, "is_new", "is_redelivered"), list(period_keys), "left")
    joined = flagged.join(old, list(row_keys), "left")
    again = F.col("is_redelivered") == "Y"
    return joined.withColumns({f"{m}_pd": F.when(again, F.col(f"{m}_pd")) for m in measures})


def share_of_total(facts: DataFrame, within: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Tier 2 share: value / sum over all products of the same market and period * 100.

    Totals are aggregated map-side and joined back, so one market-period with a third of the rows
    does not end in one task as it would with a window. Rows with an unknown market or period stay,
    without a share.
    """
    totals = facts.groupBy(*within).agg(*[F.sum(m).alias(f"{m}_top") for m in measures])
    joined = facts.join(totals, list(within), "left")
    return joined.withColumns({f"{m}_share": share(F.col(m), F.col(f"{m}_top")) for m in measures})


def share_of_top(facts: DataFrame, within: Sequence[str], path: str, top_depth: Column | int, measures: Sequence[str]) -> DataFrame:
    """Tier 1 share: value / value of the top-level row of the same path, market and period * 100."""
    tops = facts.where(F.col("is_top") == "Y").select(*within, F.col(path).alias("_top"), *[F.col(m).alias(f"{m}_top") for m in measures])
    top_path = F.when(F.col("is_top") == "Y", F.col(path)).otherwise(path_prefix(F.col(path), top_depth))
    joined = facts.withColumn("_top", top_path).join(tops, [*within, "_top"], "left").drop("_top")
    return joined.withColumns({f"{m}_share": share(F.col(m), F.col(f"{m}_top")) for m in measures})


# A calendar is metadata: a century of days, weeks and months is below this.
MAX_PERIODS = 100_000


def _chains(links: dict[int, int | None]) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """An ordinal for each period such that what it points to has the ordinal before it.

    Periods are laid in chains along the pointers, with a free ordinal before each chain. Where a period
    is pointed to more than once (or pointers run in a circle) the second chain starts anew, and the period that its
    first one points to gets that free ordinal too: those come as the second result.
    """
    after: dict[int, list[int]] = {}
    for period, target in links.items():
        if target is not None:
            after.setdefault(target, []).append(period)
    place: dict[int, int] = {}
    again = []
    free = 0
    for period in sorted({*links, *after}):
        if period in place:
            continue
        seen = {period}
        while (back := links.get(period)) is not None and back not in place and back not in seen:
            seen.add(back)
            period = back
        free += 2
        if links.get(period) is not None:
            again.append((links[period], free - 1))
        while period is not None:
            place[period] = free
            free += 1
            period = next((c for c in after.get(period, ()) if c not in place), None)
    return place, again


def calendar_ordinals(periods: DataFrame) -> tuple[DataFrame, int | None, bool]:
    """The calendar as ordinals for RANGE frames, at most MAX_PERIODS periods.

    Returns period_id, `_slots` (ordinal along prev_id, ordinal along year_ago_id, whether the slot is the
    period's own), `_has_pp` and `_has_ya`; the number of periods to year ago where period ids are
    themselves such ordinals, else None; and whether any period has more slots than its own.
    """
    rows = periods.select(*[F.col(c).cast("long").alias(c) for c in ("period_id", "prev_id", "year_ago_id")]).where("period_id IS NOT NULL").distinct()
    found = sorted((tuple(r) for r in rows.limit(MAX_PERIODS + 1).collect()), key=repr)
    if len(found) > MAX_PERIODS:
        raise ValueError(f"over {MAX_PERIODS} periods in the calendar")
    calendar = {r[0]: r[1:] for r in found}
    years = {period - back for period, (_, back) in calendar.items() if back is not None}
    even = len(years) <= 1 and min(years, default=1) > 0 and all(prev is None or prev == period - 1 for period, (prev, _) in calendar.items())
    slots: dict[int, list] = {}
    if even:
        for period in calendar:
            slots[period] = [(period, period, True)]
    else:
        (prev, more), (year, again) = (_chains({p: sides[i] for p, sides in calendar.items()}) for i in (0, 1))
        for period in {*prev, *year}:
            slots[period] = [(prev.get(period), year.get(period), True)]
        for period, free in more:
            slots[period].append((free, None, False))
        for period, free in again:
            slots[period].append((None, free, False))
    none = (None, None)
    made = [(p, [dict(zip(("pp", "ya", "own"), s)) for s in own], calendar.get(p, none)[0] is not None, calendar.get(p, none)[1] is not None) for p, own in sorted(slots.items())]
    slot = pa.struct([("pp", pa.int64()), ("ya", pa.int64()), ("own", pa.bool_())])
    types = (pa.int64(), pa.list_(slot), pa.bool_(), pa.bool_())
    columns = [pa.array([r[i] for r in made], t) for i, t in enumerate(types)]
    table = pa.Table.from_arrays(columns, names=["_period", "_slots", "_has_pp", "_has_ya"])
    return periods.sparkSession.createDataFrame(table), (min(years, default=1) if even else None), any(len(s) > 1 for s in slots.values())


def period_sides(
    facts: DataFrame, periods: DataFrame, keys: Sequence[str], measures: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Each fact with the previous period's (`_pp`) and year-ago (`_ya`) measures.

    Facts are shuffled once, on the keys without the period, and sorted by the calendar's ordinal; the
    other sides are what a RANGE frame of one ordinal holds. Nothing is collected by key. The calendar must not point
    to two periods from one; its rows are few and come to the driver (`calendar_ordinals`).

    Every fact stays. Where the other side is repeated it is null, as no one fact is right; `repeated_facts` has
    those keys. A fact without a period, or with one that the calendar does not know, has no other sides; such
    facts are dealt by their values, so that a key may have any number of them. `carry` columns come from the
    current side only.
    """
    calendar, year, branched = calendar_ordinals(periods)
    plain = facts.select(*keys, "period_id", *measures, *carry).withColumn("_period", F.col("period_id").cast("long"))
    known = plain.join(calendar, "_period", "left")
    if year is not None:
        placed = known.withColumns({"_pp": F.col("_period"), "_own": F.lit(True)})
        order = {"pp": ("_pp", 1), "ya": ("_pp", year)}
    else:
        only = F.struct(F.lit(None).cast("long").alias("pp"), F.lit(None).cast("long").alias("ya"), F.lit(True).alias("own"))
        slot = F.explode(F.coalesce("_slots", F.array(only))) if branched else F.coalesce(F.col("_slots")[0], only)
        placed = known.withColumn("_slot", slot).withColumns({"_pp": F.col("_slot.pp"), "_ya": F.col("_slot.ya"), "_own": F.col("_slot.own")})
        order = {"pp": ("_pp", 1), "ya": ("_ya", 1)}
    loose = F.col("_period").isNull() | F.col("_pp").isNull() & F.col("_own")
    placed = placed.withColumn("_deal", F.when(loose, F.pmod(F.xxhash64(*measures, *carry, "_period"), F.lit(4096)) + 1).otherwise(0))
    sides = {}
    for name, (ordinal, back) in order.items():
        frame = Window.partitionBy(*keys, "_deal").orderBy(ordinal).rangeBetween(-back, -back)
        single = F.col(f"_has_{name}") & F.col(ordinal).isNotNull() & (F.count(F.lit(1)).over(frame) == 1)
        sides |= {f"{m}_{name}": F.when(single, F.max(m).over(frame)) for m in measures}
    lined = placed.withColumns(sides)
    return (lined.where("_own") if branched else lined).select(*keys, "period_id", *measures, *carry, *sides)


def repeated_facts(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and periods that have more than one fact, with their number; partial counts are combined before the shuffle."""
    return facts.where(F.col("period_id").isNotNull()).groupBy(*keys, "period_id").agg(F.count("*").alias("facts")).where(F.col("facts") > 1)


def indexes(facts: DataFrame, measures: Sequence[str], policy: PeriodPolicy = PeriodPolicy()) -> DataFrame:
    """Percent change of each measure against previous period, year ago and previous delivery.

    `time_factor` brings the current side to the base's length; `time_factor_pp`, when present,
    scales the previous side as well.
    """
    factor = F.col("time_factor") if "time_factor" in facts.columns else None
    base = F.col("time_factor_pp") if policy.scale_previous and "time_factor_pp" in facts.columns else None
    out = {}
    for m in measures:
        out[f"{m}_ipp"] = index(F.col(m), F.col(f"{m}_pp"), factor, base)
        out[f"{m}_iya"] = index(F.col(m), F.col(f"{m}_ya"), factor if policy.scale_year_ago else None)
        if f"{m}_pd" in facts.columns:
            out[f"{m}_ipd"] = index(F.col(m), F.col(f"{m}_pd"))
    return facts.withColumns(out)


def publishable(facts: DataFrame, target: T.StructType, zero: Sequence[str]) -> DataFrame:
    """Validation fact rows: missing inputs default to 0, target layout, positive contracts only."""
    have = set(facts.columns)
    filled = facts.withColumns({z: F.coalesce(F.col(z), F.lit(0)) if z in have else F.lit(0) for z in zero})
    return conform(filled, target).where(F.col("contract_id") > 0)


def validation_hierarchy(products: DataFrame) -> DataFrame:
    """Newest product per path with top-level path, parent path and parent key (itself if none).

    `level`, `parent_level` and `top_level` count codes after the structure number.
    """
    path = F.col("path")
    newest = latest_per_key(products, ["path"], "run_id", "product_key")
    pathed = newest.withColumns(
        {
            "top_path": F.when(F.col("is_top") == "N", path_prefix(path, F.col("top_level") + 1)).otherwise(path),
            "parent_path": path_prefix(path, F.col("parent_level") + 1),
        }
    )
    parents = newest.select(F.col("path").alias("parent_path"), F.col("product_key").alias("parent_key"))
    return pathed.join(parents, "parent_path", "left").withColumn("parent_key", F.coalesce("parent_key", "product_key"))


def snapshot_thresholds(thresholds: DataFrame, log: DataFrame, run_id: int, security_key: str) -> DataFrame:
    """Threshold rows of a run with absolute level ids, only if the run has none yet."""
    rows = thresholds.withColumns(
        {
            "level_id": F.abs("level_id"),
            "run_id": F.lit(run_id).cast("long"),
            "security_key": F.lit(security_key),
        }
    )
    return not_logged(rows, log, ["run_id"])
