"""Subquery predicates and set operations as join plans that scale.

* ``not_in`` — SQL ``x NOT IN (SELECT k ...)`` with its three-valued logic,
  as a hash/sort-merge ``left_anti`` join plus two scalar subqueries.  Spark's
  own null-aware anti join is only efficient while the list is
  broadcastable; above that it degrades to a nested loop.  This form keeps
  an ordinary equi-join at any size and lets AQE choose broadcast vs shuffle
  from runtime statistics.  The list is not de-duplicated (neither join needs
  it): an aggregate between its shuffle and the join would keep AQE from
  splitting a hot key.
* ``is_in`` — ``x IN (SELECT k ...)`` as a ``left_semi`` join.
* ``calendar_covers`` — the range join to the date dimension as a test on the row
  against a literal, the days from each day of the calendar's span to its next date;
  an equi-join with a per-day table only where the span is beyond ``LITERAL_DAYS``.
* ``rows_at_min`` / ``rows_at_max`` — rows holding a group's extreme value,
  ties kept, as aggregate + equi-join back (partial aggregation makes it
  skew-safe; no per-group sort).
* ``at_group_min`` — on folded rows, those whose own minimum is their group's:
  no join back.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_K = "_in_key"
LITERAL_DAYS = 50_000             # span of a calendar (137 years) that enters the plans as a literal


def _keys(lst: DataFrame, col: str) -> DataFrame:
    return lst.select(F.col(col).alias(_K)).where(F.col(_K).isNotNull())


@dataclass(frozen=True)
class ListFacts:
    """What ``NOT IN (list)`` needs to know about the whole list: whether it
    has a row and whether it holds a NULL.  One-row aggregate, read once per
    run; with it the predicate becomes a plain anti join with literal guards
    (no per-use subquery)."""

    nonempty: bool
    has_null: bool

    @classmethod
    def of(cls, lst: DataFrame, col: str) -> "ListFacts":
        return cls.many({"_": (lst, col)})["_"]

    @classmethod
    def many(cls, lists: dict[str, tuple[DataFrame, str]]) -> dict[str, "ListFacts"]:
        """Facts of several lists with one small job (tagged union, one
        aggregate row per list)."""
        tagged = [lst.select(F.lit(name).alias("_list"), F.col(col).isNull().alias("_null"))
                  for name, (lst, col) in lists.items()]
        rows = reduce(DataFrame.unionByName, tagged).groupBy("_list").agg(
            F.max("_null").alias("z")).collect()
        seen = {r["_list"]: bool(r["z"]) for r in rows}
        return {name: cls(name in seen, seen.get(name, False)) for name in lists}


def not_in(df: DataFrame, col: str, lst: DataFrame, lst_col: str | None = None,
           facts: ListFacts | None = None) -> DataFrame:
    """Rows of ``df`` where ``df[col] NOT IN (SELECT lst_col FROM lst)`` is TRUE.

    Three-valued logic: an empty list keeps every row (NULL keys too); a
    non-empty list drops NULL keys; a NULL anywhere in the list drops all.
    Without ``facts`` the two list-level tests are scalar subqueries.
    """
    lst_col = lst_col or col
    if facts is not None:
        if not facts.nonempty:
            return df
        if facts.has_null:
            return df.where(F.lit(False))
        # NULL keys can never be kept here: drop them before the join, so a
        # NULL-heavy key never becomes one skewed join partition
        return df.where(F.col(col).isNotNull()).join(
            _keys(lst, lst_col), F.col(col) == F.col(_K), "left_anti")
    nonempty = lst.exists()
    has_null = lst.where(F.col(lst_col).isNull()).exists()
    kept = df.join(_keys(lst, lst_col), F.col(col) == F.col(_K), "left_anti")
    return kept.where(~nonempty | (~has_null & F.col(col).isNotNull()))


def not_in_values(col: str, values) -> Column:
    """SQL ``col NOT IN (literal, ...)``: NULL ``col`` is dropped."""
    return ~F.col(col).isin(*values)


def is_in(df: DataFrame, col: str, lst: DataFrame, lst_col: str | None = None) -> DataFrame:
    """Rows of ``df`` where ``df[col] IN (SELECT lst_col FROM lst)``."""
    lst_col = lst_col or col
    return df.join(_keys(lst, lst_col), F.col(col) == F.col(_K), "left_semi")


@dataclass(frozen=True)
class CalendarFacts:
    """The date dimension, read once per run: its first and last date, whether it holds
    the report date, and its dates (in order) while their span is within ``LITERAL_DAYS``."""

    first: dt.date | None
    last: dt.date | None
    holds: bool
    dates: tuple[dt.date, ...] | None

    @classmethod
    def of(cls, cal: DataFrame, day: dt.date | None = None) -> "CalendarFacts":
        c = F.to_date("date_dt")
        has = F.max(c == F.lit(day)) if day is not None else F.lit(False)
        near = F.datediff(F.max(c), F.min(c)) <= LITERAL_DAYS
        row = cal.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), has.alias("has"),
                      F.when(near, F.array_sort(F.collect_set(c))).alias("dates")).first()
        return cls(row["lo"], row["hi"], bool(row["has"]), None if row["dates"] is None else tuple(row["dates"]))

    def days_to_next(self) -> Column:
        """For every day of the span, days until the next calendar date: one array literal
        (a text that the optimizer folds)."""
        waits, ahead = [], list(reversed(self.dates))
        for i in range((self.last - self.first).days + 1):
            day = self.first + dt.timedelta(days=i)
            while ahead[-1] < day:
                ahead.pop()
            waits.append((ahead[-1] - day).days)
        return F.split(F.lit(",".join(map(str, waits))), ",").cast("array<int>")


def next_calendar_day(cal: DataFrame) -> DataFrame:
    """``(_day, _next_cal)`` for every day after the calendar's first date up to its last: the
    earliest calendar date on or after ``_day``; and the first date itself.  Each date serves
    the days since the one before it, also across months without any date."""
    dates = cal.agg(F.array_sort(F.collect_set(F.to_date("date_dt"))).alias("dates"))
    ends = dates.select("dates", F.posexplode("dates").alias("i", "_next_cal"))
    since = F.when(F.col("i") == 0, F.col("_next_cal")).otherwise(F.date_add(F.get("dates", F.col("i") - 1), 1))
    return ends.select(F.explode(F.sequence(since, F.col("_next_cal"))).alias("_day"), "_next_cal")


def calendar_cover_flag(df: DataFrame, cal: DataFrame, start_day: str, end_day: str,
                        name: str = "_on_calendar", facts: CalendarFacts | None = None) -> DataFrame:
    """Add boolean ``name``: ``[start_day, end_day]`` holds a calendar date
    (``S JOIN dim_date ON date_dt BETWEEN start AND end`` as a row flag).

    A start before the calendar's first date is covered iff the first date
    is <= end; a start after its last date never is; otherwise the next
    calendar date on or after the start must be <= end.
    """
    facts = facts if facts is not None else CalendarFacts.of(cal)
    if facts.first is None:                 # empty calendar: nothing is covered
        return df.withColumn(name, F.lit(False))
    start, end = F.col(start_day), F.col(end_day)
    before = start < F.lit(facts.first)
    if facts.dates is not None:
        wait = F.get(facts.days_to_next(), F.datediff(start, F.lit(facts.first)))
        later = F.coalesce(F.date_add(start, wait) <= end, F.lit(False))
        return df.withColumn(name, F.when(before, F.lit(facts.first) <= end).otherwise(later))
    joined = df.join(next_calendar_day(cal), start == F.col("_day"), "left")
    later = F.coalesce(F.col("_next_cal") <= end, F.lit(False))
    return joined.withColumn(name, F.when(before, F.lit(facts.first) <= end).otherwise(later)).drop("_day", "_next_cal")


def calendar_covers(df: DataFrame, cal: DataFrame, start_day: str, end_day: str,
                    facts: CalendarFacts | None = None) -> DataFrame:
    """Rows whose ``[start_day, end_day]`` holds at least one calendar date."""
    flagged = calendar_cover_flag(df, cal, start_day, end_day, "_on_calendar", facts)
    return flagged.where("_on_calendar").drop("_on_calendar")


def _rows_at(df: DataFrame, keys: list[str], value: str, agg) -> DataFrame:
    ext = df.groupBy(*keys).agg(agg(value).alias("_ext")) \
            .select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_ext")
    cond = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys] + [F.col(value) == F.col("_ext")]
    return df.join(ext, cond, "left_semi")


def rows_at_min(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows whose ``value`` equals the group minimum (ties kept)."""
    return _rows_at(df, keys, value, F.min)


def rows_at_max(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows whose ``value`` equals the group maximum (ties kept)."""
    return _rows_at(df, keys, value, F.max)


def at_group_min(folded: DataFrame, key: str, value: str, own: str) -> DataFrame:
    """Rows of an already folded table whose ``own`` equals the least ``value`` of
    their ``key``.  The window has no order, so a key's rows are not sorted
    by anything but the key."""
    least = F.min(value).over(Window.partitionBy(key))
    return folded.withColumn("_least", least).where(F.col(own) == F.col("_least")).drop("_least")
