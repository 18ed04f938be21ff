"""Connected components of an edge table by alternating large and small stars.

Every step is a keyed minimum (combined map-side) and a join back to the edges.
The minima are checkpointed before the join, so the adaptive planner may split
a hub's edges over tasks; no vertex's neighbours are gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import checkpointed


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a > b); returns such edges again."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    lowest = checkpointed(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
    joined = both.join(lowest, F.col("a") == F.col("u"))
    if large:        # v > u is linked to the lowest of u's neighbourhood
        out = (joined.filter(F.col("b") > F.col("a"))
               .select(F.col("b").alias("a"), F.least("m", "u").alias("b")))
    else:            # u's lower neighbours and u itself are linked to the lowest of them
        out = (joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links -> (vertex, root): the smallest vertex of each component,
    one row for every vertex that is not itself a root.  Self links and
    repeated links are ignored; an empty table gives an empty result."""
    e = checkpointed(edges.filter("a <> b")
                     .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _signature(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = checkpointed(_star(_star(e, large=True), large=False))
        now = _signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
