"""``lag(c, 1) OVER (PARTITION BY p ORDER BY k)`` that survives a hot ``p``.

A plain window puts every row of one partition value into one task, so an
account holding a third of all rows would be sorted by a single core.  So hot
values are counted first (``hot_keys``): rows per hash slot of the key, combined map-side, and
then rows per key in the few slots that hold enough of them.  Most tables
have none, and the plain window with its one shuffle is the plan.

Where there are some, each hot value's ordering keys are cut at quantiles into at most
``RANGES`` ranges of about ``bucket_width`` rows; all other values are one range.  The window
runs per (p, range), and the first row of each range of a hot value takes the last row of the
nearest earlier non-empty range: a summary of one row per hot range, which a
second window links.  The cuts and the summary are as many rows as there are hot
ranges, whatever the number of values; they are broadcast up to ``BROADCAST_ROWS``
and joined by shuffle beyond.

The result equals the single window exactly (ties in ``k`` aside, where SQL
itself is non-deterministic).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 1 << 20               # hash slots of the first count
COARSE = 32                   # a range is found by two counts of at most so many cuts
RANGES = COARSE * COARSE
BROADCAST_ROWS = 20_000       # hot values (with their cuts, 8 KB each at most: 160 MB) or their last rows

_B = "_lag_range"
_CUTS = "_lag_cuts"
_PREV = "_lag_prev_key"
_LAST = "_lag_last"
_PLAST = "_lag_prev_last"


@dataclass(frozen=True)
class HotKeys:
    """Partition values with more than ``width`` rows: ``cuts`` is a table of the
    values and their cut points, ``n`` the number of its rows, ``ranges`` the most
    ranges of one value."""

    columns: tuple[str, ...]
    cuts: DataFrame | None
    n: int = 0
    ranges: int = 1


def hot_keys(df: DataFrame, partition: str | list[str], order: str, width: int) -> HotKeys:
    """The hot values of ``df``.  Two counts at most; the second only where a slot
    holds more than ``width`` rows."""
    parts = [partition] if isinstance(partition, str) else list(partition)
    slot = F.pmod(F.xxhash64(*parts), F.lit(SLOTS))
    full = df.select(slot.alias("_slot")).groupBy("_slot").count().where(F.col("count") > width).select("_slot")
    if full.isEmpty():
        return HotKeys(tuple(parts), None)
    rows = df.select(*parts, F.col(order).cast("long").alias("_k")).withColumn("_slot", slot).join(full, "_slot", "left_semi")
    counted = rows.groupBy(*parts).agg(F.count("*").alias("_n")).where(F.col("_n") > width)
    size = counted.agg(F.count("*").alias("n"), F.max("_n").alias("most")).first()
    if not size["n"]:
        return HotKeys(tuple(parts), None)
    ranges = min(RANGES, -(-size["most"] // max(1, width)))
    points = F.percentile_approx("_k", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges)
    cuts = rows.groupBy(*parts).agg(F.count("*").alias("_n"), F.array_sort(points).alias(_CUTS)).where(F.col("_n") > width)
    return HotKeys(tuple(parts), cuts.drop("_n"), size["n"], ranges)


def _range_of(key: Column, cuts: Column) -> Column:
    """Number of cuts at or below the key: counted among every ``COARSE``-th, then in between."""
    below = lambda c: F.size(F.filter(c, lambda x: x <= key))
    coarse = F.filter(cuts, lambda x, i: (i + 1) % COARSE == 0)
    full = below(coarse) * COARSE
    return full + below(F.slice(cuts, full + 1, F.lit(COARSE - 1)))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _joined(df: DataFrame, other: DataFrame, on: dict[str, str], rows: int) -> DataFrame:
    """Left join, null-safe on the given columns of both sides."""
    cond = F.lit(True)
    for own, its in on.items():
        cond = cond & F.col(own).eqNullSafe(F.col(its))
    return df.join(_small(other, rows), cond, "left").drop(*on.values())


def prior_row(df: DataFrame, partition: str | list[str], order: str, cols: list[str],
              bucket_width: int = 1 << 20, prefix: str = "prior_", hot: HotKeys | None = None) -> DataFrame:
    """Add ``{prefix}{c}`` = value of ``c`` on the previous row (by ``order``)
    within ``partition``, for every ``c`` in ``cols``; NULL on the first row.  ``hot`` may be
    that of a table that holds all of ``df``'s rows, by some of the partition columns."""
    parts = [partition] if isinstance(partition, str) else list(partition)
    hot = hot if hot is not None else hot_keys(df, parts, order, bucket_width)
    if hot.cuts is None:
        w = Window.partitionBy(*parts).orderBy(order)
        return df.select("*", *[F.lag(c).over(w).alias(f"{prefix}{c}") for c in cols])

    key = F.col(order).cast("long")
    cuts = hot.cuts.select(*[F.col(c).alias(f"_lag_h_{c}") for c in hot.columns], _CUTS)
    ranged = _joined(df, cuts, {c: f"_lag_h_{c}" for c in hot.columns}, hot.n)
    ranged = ranged.withColumn(_B, F.when(F.col(_CUTS).isNotNull(), _range_of(key, F.col(_CUTS)))).drop(_CUTS)

    w_in = Window.partitionBy(*parts, _B).orderBy(order)
    local = ranged.select("*", F.lag(order).over(w_in).alias(_PREV),
                          *[F.lag(c).over(w_in).alias(f"{prefix}{c}") for c in cols])
    # the last row of each range of a hot value, found by a fold, summarises it
    last = (ranged.where(F.col(_B).isNotNull()).groupBy(*parts, _B)
            .agg(F.max_by(F.struct(*cols), order).alias(_LAST)))
    w_ranges = Window.partitionBy(*parts).orderBy(_B)
    carry = last.select(*[F.col(p).alias(f"_lag_p_{p}") for p in parts], F.col(_B).alias("_lag_b"),
                        F.lag(_LAST).over(w_ranges).alias(_PLAST))
    out = _joined(local, carry, {p: f"_lag_p_{p}" for p in parts} | {_B: "_lag_b"}, hot.n * hot.ranges)
    return out.select(*df.columns, *[
        F.when(F.col(_PREV).isNull(), F.col(f"{_PLAST}.{c}")).otherwise(F.col(f"{prefix}{c}")).alias(f"{prefix}{c}")
        for c in cols])
